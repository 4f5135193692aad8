import json
import re

import pytest
from pyspark.sql import functions as F

from telemetry_lake.functions import routing

NAMES = ["t_1_2.json", "t_1_2_3.json", "a9_1_2.json", "nomatch.json", "x_1_2.json.gz", "_1_2.json"]
LINES = [
    '{"report_table":"a","x":1}',
    '  {"report_table":"a"}  ',
    '{"report_table":"a"} trailing',
    '{"report_table":"a"}{"report_table":"b"}',
    '{"report_table":"a"},{"report_table":"b"}',
    "{'report_table':'a'}",
    '{"report_table":"a"',
    '{"report_table":"a","x":}',
    '{"report_table":"a","x":NaN}',
    '{"report_table":"a","report_table":"b"}',
    '{"other":1}',
    '{"outer":{"report_table":"a"}}',
    '[{"report_table":"a"}]',
    '"text"',
    "",
    "null",
    "not json",
]


def python_table(line):
    try:
        found = json.loads(line)["report_table"]
    except Exception:
        return None
    return found


@pytest.mark.parametrize(
    "spark_pattern,python_pattern",
    [
        (routing.NAME_PATTERN, r"(.+)_\d+_\d+\.json"),
        (routing.NAME_PATTERN_NO_DIGITS, r"(\D+)_\d+_\d+\.json"),
    ],
)
def test_names_route_like_an_anchored_match(spark, spark_pattern, python_pattern):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    got = df.select("name", routing.table_of_name(F.col("name"), spark_pattern).alias("t")).collect()
    for row in got:
        match = re.match(python_pattern, row.name)
        assert row.t == (match.group(1) if match else None), row.name


def test_lines_read_like_a_strict_json_parser(spark):
    df = spark.createDataFrame([(line,) for line in LINES], "value string")
    line = F.col("value")
    got = df.select(
        "value",
        routing.table_field(line, "report_table").alias("table"),
        routing.table_or_line(line, "report_table").alias("or_line"),
        routing.table_key(line, "report_table").alias("key"),
        routing.is_line_of(line, "report_table", "a").alias("is_a"),
    ).collect()
    for row in got:
        expected = python_table(row.value)
        assert row.table == expected, row.value
        assert row.or_line == (expected if expected is not None else row.value)
        assert row.key == (expected if expected is not None else routing.NO_TABLE)
        assert row.is_a == (expected == "a")


def test_encoded_names_are_decoded(spark):
    df = spark.createDataFrame([("a%20b%25c+d_1_0.json",)], "n string")
    assert df.select(routing.decoded_name(F.col("n"))).first()[0] == "a b%c+d_1_0.json"
