"""Extra columns named like those the operators make inside change no result."""

import pytest
from pyspark.sql import functions as F

from telemetry_lake.llm import byte_bpe, fingerprints, lm_scoring

NAMES = [
    "row", "data", "word", "words", "key", "part", "edge", "fp", "n", "c", "rare", "times", "ids", "held_out",
    "n_tokens", "score", "fingerprint", "edited_fp", "n_known", "known_here", "log_counts", "x", "id", "value", "DATA2",
]


@pytest.mark.parametrize("apply", [byte_bpe.encode_table, fingerprints.with_next, lm_scoring.score])
def test_results_stay(documents, apply):
    rows = [(i, f"Some words {i} and {i % 3} more") for i in range(12)]
    rows += [(None, "no id"), (20, None), (21, ""), (22, "a long text " * 20_000), (3, rows[3][1])]
    docs = documents(rows)
    clashing = docs.select("*", *[F.lit(f"{n}!").alias(n) for n in NAMES])
    kept = apply(docs)
    wanted = sorted(map(repr, kept.collect()))
    assert len(wanted) == len(rows)
    got = apply(clashing)
    assert got.columns == kept.columns
    assert sorted(map(repr, got.collect())) == wanted
