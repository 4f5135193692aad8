"""Typed metrics from job log lines, batch or stream.

A line looks like ``[dd/mm/yy HH:MM:SS][pid][LEVEL][file:line] message``. Patterns are
tried in order and the first match decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The log line patterns, with the public grok names spelled out.
MONTH = r"(?:0?[1-9]|1[0-2])"
DAY = r"(?:0[1-9]|[12][0-9]|3[01]|[1-9])"
YEAR = r"(?:\d\d){1,2}"
CLOCK = r"(?:2[0-3]|[01]?[0-9]):[0-5][0-9]:(?:[0-5]?[0-9]|60)(?:[:.,][0-9]+)?"
STAMP = rf"(?:{MONTH}[/-]{DAY}[/-]{YEAR}|{DAY}[./-]{MONTH}[./-]{YEAR})[- ]{CLOCK}"
INTEGER = r"[+-]?[0-9]+"
LEVEL = (
    r"(?i:alert|trace|debug|notice|info|warn(?:ing)?|err(?:or)?|crit(?:ical)?"
    r"|fatal|severe|emerg(?:ency)?)"
)
NUMBER = r"[+-]?(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+)"
PREFIX = rf"\A\[({STAMP})\]\[({INTEGER})\]\[({LEVEL})\]\[(.*?)\]"
PAGE_END = rf"{PREFIX} PAGE_END: .*? ,done_files_numb=({INTEGER})"
CYCLE_END = (
    rf"{PREFIX} END1: found_files_numb=({INTEGER}) ,file_chunks=({INTEGER})"
    rf" ,done_files_numb=({INTEGER}) ,bad_files_numb=({INTEGER})"
    rf" process_time=({NUMBER})"
)
GENERIC = rf"{PREFIX}(.*)"
TIME_FORMAT = "dd/MM/yy HH:mm:ss"

PREFIX_FIELDS = ["my_event_time", "thid", "log_level", "src_file"]
# Name, text any matching line contains, pattern, fields.
PATTERNS = [
    ("PAGE_END", "] PAGE_END: ", PAGE_END, [*PREFIX_FIELDS, "done_files_numb_p"]),
    (
        "END1",
        "] END1: found_files_numb=",
        CYCLE_END,
        [
            *PREFIX_FIELDS,
            "found_files_numb_e",
            "file_chunks_e",
            "done_files_numb_e",
            "bad_files_numb_e",
            "process_time_e",
        ],
    ),
    ("generic", "]", GENERIC, [*PREFIX_FIELDS, "message"]),
]
FIELD_TYPES = {
    "my_event_time": "string",
    "thid": "int",
    "log_level": "string",
    "src_file": "string",
    "done_files_numb_p": "int",
    "found_files_numb_e": "int",
    "file_chunks_e": "int",
    "done_files_numb_e": "int",
    "bad_files_numb_e": "int",
    "process_time_e": "double",
    "message": "string",
}


# Between the captured groups while a line is being taken apart.
MARK = "\x01"


def _groups(text: Column, pattern: str, count: int) -> Column:
    """All groups of a matching line from a single regex run."""
    template = MARK.join(f"${i}" for i in range(1, count + 1))
    return F.split(F.regexp_replace(text, rf"{pattern}(?s:.*)", template), MARK, count)


def parse_job_log(df: DataFrame, line: str = "value") -> DataFrame:
    """Replace ``line`` by the matched pattern's name (``kind``) and its typed fields.

    ``event_time`` is the parsed ``my_event_time``; a line no pattern fits becomes a
    ``raw`` row whose message is the whole line.
    """
    text = F.col(line)
    kept = [c for c in df.columns if c != line]
    kind, parts = F, F
    for name, sign, pattern, fields in PATTERNS:
        kind = kind.when(text.contains(sign) & text.rlike(pattern), name)
        parts = parts.when(F.col("kind") == name, _groups(text, pattern, len(fields)))
    split_lines = df.withColumn("kind", kind.otherwise("raw")).select(
        *kept, "kind", parts.otherwise(F.array(text)).alias("parts")
    )

    def field(name: str) -> Column:
        value = F.lit(None)
        for kind_name, _, _, fields in [*PATTERNS, ("raw", "", "", ["message"])]:
            if name in fields:
                part = F.get("parts", F.lit(fields.index(name)))
                value = F.when(F.col("kind") == kind_name, part).otherwise(value)
        return value.try_cast(FIELD_TYPES[name]).alias(name)

    return split_lines.select(*kept, "kind", *[field(name) for name in FIELD_TYPES]).withColumn(
        "event_time", F.try_to_timestamp("my_event_time", F.lit(TIME_FORMAT))
    )
