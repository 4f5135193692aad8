import os
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, LongType, StringType, StructType

from telemetry_lake.functions import joblog, text
from telemetry_lake.operators import quality, sinks
from telemetry_lake.plans import schemas
from telemetry_lake.plans.lake import Lake
from telemetry_lake.session import work_dir
from telemetry_lake.sources import scans
from telemetry_lake.sources.disagreeing import agreeing_parts, read_disagreeing
from telemetry_lake.sources.workspace import Workspace, Workspaces, folder_tables
from telemetry_lake.streaming import lines


def test_word_count_splits_on_single_spaces_like_python(spark):
    texts = ["a b  a", "", " lead", "trail ", "a.b c|d"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    expected = {}
    for t in texts:
        for word in t.split(" "):
            expected[word] = expected.get(word, 0) + 1
    assert {r.word: r["count"] for r in text.word_count(df, "t").collect()} == expected


def test_json_array_explodes_to_columns_or_values(spark):
    df = spark.createDataFrame([("f", '[{"k":1,"s":"x"},{"k":2}]'), ("g", "[]"), ("h", "bad")], "path string, t string")
    got = text.explode_json_array(df, "t", "struct<k:int,s:string>").collect()
    assert sorted(map(tuple, got)) == [("f", 1, "x"), ("f", 2, None)]
    numbers = spark.createDataFrame([("[1,2]",)], "t string")
    assert [r.element for r in text.explode_json_array(numbers, "t", "int").collect()] == [1, 2]


def test_arrays_of_any_shape_give_a_row_an_element(spark):
    rows = [
        (1, '[{"k":1},"x",2.5,null,[1,2],{"k":1.5},{"k":"y"},{"k":9007199254740993}]'),
        (2, '{"k":1}'), (3, "[1,"), (4, None), (5, "[]"), (6, "7"), (7, ""),
    ]
    df = spark.createDataFrame(rows, "`a.b` int, text string")
    items = text.with_fields(text.explode_any_array(df, "text"), "element", {"k": "bigint", "o'x": "string"})
    got = items.select("`a.b`", "position", F.to_json("element"), "k").orderBy("position").collect()
    assert [tuple(r) for r in got] == [
        (1, 0, '{"k":1}', 1), (1, 1, '"x"', None), (1, 2, "2.5", None), (1, 3, "null", None),
        (1, 4, "[1,2]", None), (1, 5, '{"k":1.5}', None), (1, 6, '{"k":"y"}', None),
        (1, 7, '{"k":9007199254740993}', 9007199254740993),
    ]


def test_json_rows_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a bigint, b string")
    text.to_json_rows(df).write.text(str(tmp_path / "j"))
    got = scans.scan_json(spark, str(tmp_path / "j"))
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, "x"), (2, None)]


PREFIX = "[05/12/26 10:11:12][42][INFO][feed.py:88]"
LOG = {
    f"{PREFIX} END1: found_files_numb=5 ,file_chunks=1 ,done_files_numb=4 ,bad_files_numb=1 process_time=0.25":
        ("END1", 42, "INFO", "feed.py:88", None, 5, 1, 4, 1, 0.25, None),
    f"{PREFIX} PAGE_END: found_files_numb=5 ,file_chunks=1 ,done_files_numb=4 ,bad_files_numb=1":
        ("PAGE_END", 42, "INFO", "feed.py:88", 4, None, None, None, None, None, None),
    f"{PREFIX} END1: found_files_numb=none": ("generic", 42, "INFO", "feed.py:88", None, None, None, None, None, None, " END1: found_files_numb=none"),
    f"{PREFIX}": ("generic", 42, "INFO", "feed.py:88", None, None, None, None, None, None, ""),
    "[45/12/26 10:11:12][42][INFO][f] x": ("raw",) + (None,) * 9 + ("[45/12/26 10:11:12][42][INFO][f] x",),
    "Traceback": ("raw",) + (None,) * 9 + ("Traceback",),
    "": ("raw",) + (None,) * 9 + ("",),
    f"{PREFIX} END1: found_files_numb=99999999999 ,file_chunks=1 ,done_files_numb=4 ,bad_files_numb=1 process_time=.5":
        ("END1", 42, "INFO", "feed.py:88", None, None, 1, 4, 1, 0.5, None),
}


def test_log_lines_take_the_first_pattern_that_fits(spark):
    df = spark.createDataFrame([(k,) for k in LOG], "value string")
    kept = df.withColumn("source", F.col("value"))
    for row in joblog.parse_job_log(kept).collect():
        values = row.asDict()
        line, stamp, event_time = values.pop("source"), values.pop("my_event_time"), values.pop("event_time")
        assert tuple(values.values()) == LOG[line], line
        if row.kind != "raw":
            assert stamp == "05/12/26 10:11:12" and event_time == datetime(2026, 12, 5, 10, 11, 12)


def test_log_lines_parse_as_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("\n".join(k for k in LOG if k) + "\n")
    parsed = joblog.parse_job_log(lines.line_stream(spark, str(tmp_path / "in")))
    query = (
        parsed.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "c"))
        .option("path", str(tmp_path / "out"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    kinds = spark.read.parquet(str(tmp_path / "out")).groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in kinds} == {"END1": 2, "PAGE_END": 1, "generic": 2, "raw": 2}


def test_line_counts_are_per_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.json").write_text('{"report_table":"a"}\n{"report_table":"b"}\nbad\n')
    source = lines.line_stream(spark, str(tmp_path / "in"), page_files=1)
    out = str(tmp_path / "out")
    lines.start_line_counts(source, "report_table", out, str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(out).groupBy("_batch_id", "table_name").agg(F.sum("lines").alias("n")).collect()
    assert len(got) == 9 and all(r.n == 1 for r in got)
    assert {r.table_name for r in got} == {"a", "b", "bad"}


def test_late_lines_are_counted_once_without_the_stream(spark, tmp_path, monkeypatch):
    landing, out, files = (str(tmp_path / n) for n in ("in", "out", "files"))
    os.mkdir(landing)

    def put(name, seconds):
        (tmp_path / "in" / name).write_text('{"report_table":"a"}\nbad\n')
        os.utime(f"{landing}/{name}", (seconds, seconds))

    def run():
        source = lines.line_stream(spark, landing, max_age_ms=60_000)
        query = lines.start_line_counts(source, "report_table", out, str(tmp_path / "c"), files=files)
        query.awaitTermination()

    def late():
        return lines.count_late_lines(spark, landing, "report_table", out, files, page_files=1)

    def counted():
        rows = spark.read.parquet(out).groupBy("table_name").agg(F.sum("lines").alias("n")).collect()
        return {r.table_name: r.n for r in rows}

    put("new 1.json", 1_700_000_000)
    run()
    for name in ("old [1].json", "old 2.json"):
        put(name, 1_600_000_000)
    (tmp_path / "in" / "empty.json").write_text("")
    run()
    # The stream skips them.
    assert counted() == {"a": 1, "bad": 1}

    def failing(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(lines, "count_lines", failing)
        with pytest.raises(RuntimeError):
            late()
    assert late() == 2 and counted() == {"a": 3, "bad": 3}
    run()
    assert late() == 0 and counted() == {"a": 3, "bad": 3}


def test_registry_merge_marks_every_case(spark):
    ddl = quality.REGISTRY_SCHEMA
    old = spark.createDataFrame([("t", "a", "bigint"), ("t", "b", "bigint"), ("t", "c", "string")], ddl)
    new = spark.createDataFrame([("t", "a", "bigint"), ("t", "b", "string"), ("t", "d", "double"), ("u", "a", "int")], ddl)
    merged = quality.merge_schema(old, new)
    got = {(r.table_name, r.column_name): (r.status, r.data_type) for r in merged.collect()}
    assert got == {
        ("t", "a"): ("same", "bigint"),
        ("t", "b"): ("conflict", "bigint"),
        ("t", "c"): ("kept", "string"),
        ("t", "d"): ("added", "double"),
        ("u", "a"): ("added", "int"),
    }
    assert [tuple(r) for r in quality.drift(merged).collect()] == [("t", "b", "bigint", "string")]


def test_stored_schema_files_keep_their_four_types(spark):
    stored = '{"a": "LongType", "b": "DateType", "c": "int", "d": "timestamp", "e": "DoubleType", "f": "StringType"}'
    df = spark.createDataFrame([("t", stored)], "t string, s string")
    got = {r.column_name: r.data_type for r in quality.registry_from_json(df, "t", "s").collect()}
    assert got == {"a": "bigint", "b": "date", "c": "int", "d": "timestamp", "e": "string", "f": "string"}


def test_types_from_names(spark):
    assert quality.type_from_name("LongType") == LongType()
    assert quality.type_from_name("DateType") == DateType()
    assert quality.type_from_name("double") == DoubleType()
    assert quality.type_from_name("array<int>").simpleString() == "array<int>"
    assert quality.type_from_name("FancyType<") == StringType()
    odd = StructType().add("a-b", ArrayType(StructType().add("x y", LongType())))
    assert quality.type_from_name(quality.type_text(odd)) == odd


def test_repair_gives_null_for_what_does_not_fit(spark):
    df = spark.createDataFrame([("1",), ("n/a",), (None,)], "`a.b` string")
    got = quality.repair_types(df, {"a.b": "bigint"})
    assert [r[0] for r in got.collect()] == [1, None, None]


def test_stats_mark_unreadable_tables(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "a"))
    (tmp_path / "garbage").mkdir()
    (tmp_path / "garbage" / "part-0.parquet").write_bytes(b"not a table at all")
    spark.range(5).write.parquet(str(tmp_path / "mixed"))
    (tmp_path / "mixed" / "part-9.parquet").write_bytes(b"PAR1 broken PAR1")
    paths = {n: str(tmp_path / n) for n in ("a", "none", "garbage", "mixed")}
    reasons = {r.table_name: r.reason for r in quality.table_stats(spark, paths).collect()}
    assert reasons["a"] is None and all(reasons[n] for n in ("none", "garbage", "mixed"))
    del paths["garbage"], paths["mixed"]
    got = {r.table_name: (r["count"], r["columns"]) for r in quality.table_stats(spark, paths).collect()}
    assert got == {"a": (5, ["id"]), "none": (-1, [])}
    assert quality.table_stats(spark, {}).collect() == []


def test_tables_of_a_folder_are_checked_against_the_registry(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    spark.range(3).withColumn("level", F.lit(1)).write.parquet(str(tmp_path / "data" / "a.parquet"))
    spark.range(4).write.parquet(str(tmp_path / "data" / "b.parquet"))
    paths = folder_tables(spark, str(tmp_path / "data"))
    assert list(paths) == ["a", "b"]
    tables = {name: scans.scan_parquet(spark, path) for name, path in paths.items()}
    for _ in range(2):
        rows = schemas.check_tables(spark, lake, "check-1", tables)
        assert {(r.table_name, r.column_name, r.status) for r in rows} == {
            ("a", "id", "added"), ("a", "level", "added"), ("b", "id", "added"),
        }
    changed = {"a": tables["a"].withColumn("level", F.lit("x")).drop("id")}
    rows = schemas.check_tables(spark, lake, "check-2", changed)
    assert {(r.column_name, r.status, r.data_type) for r in rows} == {
        ("id", "kept", "bigint"), ("level", "conflict", "int"),
    }
    assert [(r.table_name, r.column_name) for r in lake.drift(spark).collect()] == [("a", "level")]


def test_string_schema_and_delimiters(spark, tmp_path):
    assert scans.string_schema("attributes keyname tag text").names == ["attributes", "keyname", "tag", "text"]
    (tmp_path / "x.tbl").write_text("1|a\n2|b\n")
    got = scans.load(spark, str(tmp_path / "x.tbl"), "psv").collect()
    assert [tuple(r) for r in got] == [("1", "a"), ("2", "b")]


def test_workspaces_resolve_write_and_query(spark, tmp_path):
    spaces = Workspaces(
        spark,
        {
            "root": Workspace(str(tmp_path / "root")),
            "tmp": Workspace(str(tmp_path / "tmp"), "csv"),
            "fixed": Workspace(str(tmp_path / "root"), writable=False),
        },
        header=True,
    )
    spaces.write(spark.range(3), "root.numbers.parquet")
    assert spaces.resolve("tmp.x")[1] == "csv" and spaces.resolve("tmp.x.tbl")[1] == "psv"
    got = spaces.query(["root.numbers.parquet"], "select sum(id) as s from numbers")
    assert got.first().s == 3
    empty = spaces.query_registered("select * from numbers where id > 10")
    assert empty.columns == ["id"] and empty.collect() == []
    spaces.create_table_as("tmp.copy", "select * from numbers")
    assert sorted(r.id for r in spaces.read("tmp.copy", "id bigint").collect()) == [0, 1, 2]
    with pytest.raises(PermissionError):
        spaces.write(spark.range(1), "fixed.other")


def test_cached_view_is_pruned_before_it_is_cached(spark, tmp_path):
    spaces = Workspaces(spark, {"root": Workspace(str(tmp_path))})
    rows = spark.createDataFrame([(1, "x", "2024-01-01"), (2, "y", "2024-01-02")], "id int, v string, report_date string")
    sinks.append_by_date(rows, str(tmp_path / "t.parquet"), "report_date")
    views = spaces.register(
        ["root.t.parquet"], ["id"], F.col("report_date") >= F.lit("2024-01-02").cast("date"), cache=True
    )
    plan = views["t"]._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryRelation" in plan and "PartitionFilters: [isnotnull(report_date" in plan
    assert [r.id for r in spaces.query_registered("select * from t").collect()] == [2]
    spaces.release()
    assert not views["t"].is_cached


def test_plain_and_partitioned_rows_are_never_mixed(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append_by_date(spark.createDataFrame([(1, "2024-01-01")], "a int, report_date string"), path, "report_date")
    sinks.append_by_date(spark.createDataFrame([(2,)], "a int"), path, "report_date")
    df = scans.scan_parquet(spark, path)
    assert sorted((r.a, str(r.report_date)) for r in df.collect()) == [(1, "2024-01-01"), (2, "None")]


def test_bad_date_text_is_refused_and_can_be_split_off(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [(1, "2024-01-01"), (2, "oops"), (3, ""), (4, None)], "a int, report_date string"
    )
    with pytest.raises(Exception, match="report_date is not a date: oops"):
        sinks.append_by_date(df, path, "report_date")
    good, bad = sinks.split_bad_dates(df, "report_date")
    sinks.append_by_date(good, path, "report_date")
    got = {r.a: str(r.report_date) for r in scans.scan_parquet(spark, path).collect()}
    assert got == {1: "2024-01-01", 3: "None", 4: "None"}
    assert [r.a for r in bad.collect()] == [2]
    good, bad = sinks.split_bad_dates(scans.scan_parquet(spark, path), "report_date")
    assert good.count() == 3 and bad.count() == 0


def test_work_dir_follows_the_session(spark, monkeypatch):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    if shared:
        assert first.startswith(shared.rstrip("/"))


def test_a_cluster_session_must_name_the_shared_folder():
    settings = SimpleNamespace(get=lambda key, default: default)
    cluster = SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(cluster, "x")


def write_part(spark, path, ddl, *rows):
    spark.createDataFrame(list(rows), ddl).coalesce(1).write.mode("append").parquet(str(path))


def test_files_that_disagree_read_as_one_table(spark, tmp_path):
    root = tmp_path / "t"
    for i in range(8):
        ddl, value = ("v string, n int", str(i)) if i % 3 == 1 else ("v bigint, n int", i)
        write_part(spark, root / f"day=2024-01-0{i + 1}", ddl, (value, i))
    write_part(spark, root / "day=2024-01-09", "v string, extra double", ("n/a", 1.5), ("9007199254740993", None))
    write_part(spark, root / "day=2024-01-09", "v double, n string", (2.5, "7"), (3.0, "x"))
    write_part(spark, root / "day=2024-01-09", "v array<int>", ([1, 2],), (None,))
    assert len(agreeing_parts(spark, str(root))) == 4
    got = read_disagreeing(spark, str(root), "t")
    assert dict(got.rows.dtypes) == {"v": "bigint", "n": "int", "day": "date", "extra": "double"}
    rows = sorted((str(r.day)[-1], r.v, r.n, r.extra) for r in got.rows.where("day < '2024-01-09'").collect())
    assert rows == [(str(i + 1), i, i, None) for i in range(8)]
    last = sorted((tuple(r) for r in got.rows.where("day = '2024-01-09'").select("v", "n", "extra").collect()), key=repr)
    assert last == sorted(
        [(None, None, 1.5), (9007199254740993, None, None), (None, 7, None), (3, None, None), (None, None, None), (None, None, None)],
        key=repr,
    )
    assert sorted(map(tuple, got.lost.collect())) == [
        ("n", "string", "x"), ("v", "array<int>", '{"v":[1,2]}'), ("v", "double", "2.5"), ("v", "string", "n/a"),
    ]
    assert {(r.column_name, r.old_type, r.new_type) for r in got.drift.collect()} == {
        ("v", "bigint", "string"), ("v", "bigint", "double"), ("v", "bigint", "array<int>"), ("n", "int", "string"),
    }
    text = read_disagreeing(spark, str(root), "t", StructType.fromDDL("v string"))
    assert text.rows.schema["v"].dataType == StringType() and text.rows.columns[0] == "v"
    assert {r.v for r in text.rows.where("day < '2024-01-09'").collect()} == {str(i) for i in range(8)}


def test_files_that_agree_are_one_scan(spark, tmp_path):
    for i in range(4):
        write_part(spark, tmp_path / "t", "a int" if i % 2 else "a int, b string", (i,) if i % 2 else (i, "x"))
    got = read_disagreeing(spark, str(tmp_path / "t"), "t")
    assert got.rows.count() == 4 and got.lost.isEmpty() and got.drift.isEmpty()
    assert got.rows._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
