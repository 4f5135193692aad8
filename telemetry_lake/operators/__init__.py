"""DataFrame-to-DataFrame operators, and the batch sinks."""
