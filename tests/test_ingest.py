import json
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from telemetry_lake.operators import compact
from telemetry_lake.plans import schemas
from telemetry_lake.plans.lake import BATCH, FOLDED, Lake
from telemetry_lake.streaming import ingest


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def put(folder, name, *lines, end="\n"):
    """A landing file, newer than the files before it."""
    path = folder / name
    text = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines)
    path.write_text(text + (end if lines else ""))
    return path


def run(spark, landing, lake, checkpoint="checkpoint", **options):
    query = ingest.start_ingest(spark, str(landing), lake, lake.path(checkpoint), **options)
    query.awaitTermination()
    return query


def rows(spark, lake, table, *columns):
    df = lake.open(spark).read(table)
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def quarantined(spark, lake):
    df = lake.quarantine(spark).select("table_name", "file_name", "reason", "record")
    return sorted((tuple(r) for r in df.collect()), key=repr)


def audited(spark, lake):
    df = lake.audit(spark).select("file_name", "status", "rows_done", "rows_bad")
    return {r.file_name: (r.status, r.rows_done, r.rows_bad) for r in df.collect()}


def test_missing_final_newline_keeps_both_records(spark, landing, lake):
    put(landing, "t_1_0.json", {"a": 1}, end="")
    put(landing, "t_2_0.json", {"a": 2}, end="")
    run(spark, landing, lake)
    assert rows(spark, lake, "t", "a") == [(1,), (2,)]


def test_glued_records_are_set_aside_not_dropped(spark, landing, lake):
    put(landing, "t_1_0.json", '{"a":1}{"a":2}', {"a": 3})
    run(spark, landing, lake)
    assert rows(spark, lake, "t", "a") == [(3,)]
    assert quarantined(spark, lake) == [("t", "t_1_0.json", "malformed_json", '{"a":1}{"a":2}')]


def test_records_joined_by_a_comma_are_set_aside(spark, landing, lake):
    put(landing, "t_1_0.json", '{"a":1},{"b":2}', {"a": 3})
    run(spark, landing, lake)
    assert rows(spark, lake, "t", "a") == [(3,)]
    assert quarantined(spark, lake) == [("t", "t_1_0.json", "malformed_json", '{"a":1},{"b":2}')]


def test_reserved_name_sets_aside_its_line_only(spark, landing, lake):
    put(landing, "t_1_0.json", {"a": 1}, '{"a":2,"_batch_id":9}')
    put(landing, "t_2_0.json", {"a": 3})
    run(spark, landing, lake)
    assert rows(spark, lake, "t", "a") == [(1,), (3,)]
    assert quarantined(spark, lake) == [("t", "t_1_0.json", "unreadable_schema", '{"a":2,"_batch_id":9}')]


def test_array_line_gives_its_records(spark, landing, lake):
    put(landing, "t_1_0.json", '[{"a":1},{"a":2}]', "", {"a": 3})
    run(spark, landing, lake)
    assert rows(spark, lake, "t", "a") == [(1,), (2,), (3,)]


def test_undated_rows_read_back_with_dated_ones(spark, landing, lake):
    put(landing, "t_1_0.json", {"a": 1, "report_date": "2024-01-01"}, {"a": 2, "report_date": None})
    run(spark, landing, lake)
    put(landing, "t_2_0.json", {"a": 3})
    run(spark, landing, lake)
    df = lake.open(spark).read("t")
    assert dict(df.dtypes)["report_date"] == "date"
    got = {r.a: str(r.report_date) for r in df.collect()}
    assert got == {1: "2024-01-01", 2: "None", 3: "None"}


def test_bad_date_is_set_aside_and_the_column_stays_a_date(spark, landing, lake):
    days = ["2017-06-14", "oops", "", "2017-02-30", "2017-6-1", "20170614", "2017-06-14 10:00:00", None]
    put(landing, "t_1_0.json", *[{"a": i, "report_date": day} for i, day in enumerate(days)])
    run(spark, landing, lake)
    got = {r.a: str(r.report_date) for r in lake.open(spark).read("t").collect()}
    assert got == {0: "2017-06-14", 2: "None", 7: "None"}
    assert [q[2] for q in quarantined(spark, lake)] == ["bad_date"] * 5


def test_faulty_files_leave_other_tables_alone(spark, landing, lake):
    put(landing, "good_1_0.json", {"a": 1}, '{"a":')
    put(landing, "bad_1_0.json", '{"a"', "nonsense")
    put(landing, "empty_1_0.json")
    put(landing, "clash_1_0.json", '{"a":1,"A":2}')
    put(landing, "reserved_1_0.json", '{"_batch_id":1}')
    put(landing, "onlydate_1_0.json", '{"report_date":"2024-01-01"}')
    put(landing, "nomatch.json", {"a": 5})
    put(landing, "skip_1_0.txt", {"a": 6})
    run(spark, landing, lake)
    assert rows(spark, lake, "good", "a") == [(1,)]
    assert [str(r[0]) for r in rows(spark, lake, "onlydate")] == ["2024-01-01"]
    assert quarantined(spark, lake) == [
        ("bad", "bad_1_0.json", "malformed_json", "nonsense"),
        ("bad", "bad_1_0.json", "malformed_json", '{"a"'),
        ("clash", "clash_1_0.json", "unreadable_schema", '{"a":1,"A":2}'),
        ("good", "good_1_0.json", "malformed_json", '{"a":'),
        ("reserved", "reserved_1_0.json", "unreadable_schema", '{"_batch_id":1}'),
        (None, "nomatch.json", "unroutable_name", '{"a": 5}'),
    ]
    assert audited(spark, lake) == {
        "good_1_0.json": ("done", 1, 1),
        "bad_1_0.json": ("bad", 0, 2),
        "clash_1_0.json": ("bad", 0, 1),
        "reserved_1_0.json": ("bad", 0, 1),
        "onlydate_1_0.json": ("done", 1, 0),
        "nomatch.json": ("bad", 0, 1),
    }


def test_page_of_empty_files_is_skipped(spark, landing, lake):
    put(landing, "empty_1_0.json")
    run(spark, landing, lake)
    put(landing, "blank_1_0.json", "", "  ")
    put(landing, "t_1_0.json", {"a": 1})
    run(spark, landing, lake)
    assert rows(spark, lake, "t", "a") == [(1,)] and quarantined(spark, lake) == []
    assert audited(spark, lake) == {"blank_1_0.json": ("done", 0, 0), "t_1_0.json": ("done", 1, 0)}


def test_type_conflict_keeps_the_old_type(spark, landing, lake):
    put(landing, "t_1_0.json", {"level": 7, "gone": True})
    run(spark, landing, lake)
    put(landing, "t_2_0.json", {"level": "8", "new": 1.5}, {"level": "high"}, {"level": None})
    run(spark, landing, lake)
    assert rows(spark, lake, "t", "level", "gone", "new") == [
        (7, True, None),
        (8, None, 1.5),
        (None, None, None),
    ]
    drift = [tuple(r) for r in lake.drift(spark).drop(BATCH).collect()]
    assert drift == [("t", "level", "bigint", "string")]
    assert quarantined(spark, lake) == [("t", "t_2_0.json", "type_conflict:level", '{"level": "high"}')]


def test_numbers_are_never_cut_to_fit(spark, landing, lake):
    put(landing, "t_1_0.json", {"n": 1, "f": 1.5})
    run(spark, landing, lake)
    put(landing, "t_2_0.json", {"n": 2.0, "f": 2}, {"n": 2.5, "f": 3})
    run(spark, landing, lake)
    put(landing, "t_3_0.json", {"f": 9007199254740993})
    run(spark, landing, lake)
    assert rows(spark, lake, "t", "n", "f") == [(1, 1.5), (2, 2.0)]
    assert sorted(q[2] for q in quarantined(spark, lake)) == ["type_conflict:f", "type_conflict:n"]


def test_nested_fields_are_added_like_columns(spark, landing, lake):
    put(landing, "t_1_0.json", {"a": 1, "s": {"x": 1, "l": [{"p": 1}]}})
    run(spark, landing, lake)
    put(landing, "t_2_0.json", {"a": 2, "s": {"x": 2, "y": "new", "l": [{"p": 2, "q": 3}]}})
    run(spark, landing, lake)
    put(landing, "t_3_0.json", {"a": 3, "s": {"y": "only"}}, {"a": 4, "s": None})
    run(spark, landing, lake)
    got = {r.a: r.s.asDict(recursive=True) if r.s else None for r in lake.open(spark).read("t").collect()}
    assert got == {
        1: {"x": 1, "y": None, "l": [{"p": 1, "q": None}]},
        2: {"x": 2, "y": "new", "l": [{"p": 2, "q": 3}]},
        3: {"x": None, "y": "only", "l": None},
        4: None,
    }
    assert lake.drift(spark).count() == 0 and quarantined(spark, lake) == []


def test_nested_numbers_are_never_rounded(spark, tmp_path):
    lines = [
        ['{"s":{"x":1.5,"l":[0.5],"r":[{"y":2.5}]}}'],
        ['{"s":{"x":9007199254740993,"z":1}}', '{"s":{"x":9007199254740992}}', '{"s":{"x":0.1}}'],
        ['{"s":{"l":[1,null,9007199254740993]}}', '{"s":{"l":[1,null,2]}}', '{"s":{"l":null}}'],
        ['{"s":{"r":[{"y":1},{"y":9007199254740993}]}}', '{"s":{"r":[{"y":1},{"y":1e300}]}}'],
        ['{"s":{"x":123456789012345678901}}', '{"s":{}}', '{"s":{"x":"NaN"}}', '{"s":{"x":3,"n":7}}'],
    ]
    results = []
    for size in (1, 100):
        landing, own = tmp_path / f"landing-{size}", Lake(str(tmp_path / f"lake-{size}"))
        landing.mkdir()
        for i, texts in enumerate(lines):
            path = put(landing, f"t_{i}_0.json", *texts)
            os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
        run(spark, landing, own, page_files=size)
        stored = sorted(r.j for r in own.open(spark).read("t").where("s is not null").select(F.to_json("s").alias("j")).collect())
        results.append((stored, {record for *_, record in quarantined(spark, own)}))
    assert results[0] == results[1]
    stored, aside = results[0]
    assert aside == {lines[1][0], lines[2][0], lines[3][0], lines[4][0], lines[4][2]}
    assert stored == sorted([
        '{"l":[0.5],"r":[{"y":2.5}],"x":1.5}', '{"x":9.007199254740992E15}', '{"x":0.1}', '{"l":[1.0,null,2.0]}',
        '{"r":[{"y":1.0},{"y":1.0E300}]}', '{"x":3.0,"n":7}',
    ])


def test_nested_types_without_a_cast_are_set_aside(spark, landing, lake):
    put(landing, "t_1_0.json", {"a": 1, "s": {"x": 1}})
    run(spark, landing, lake)
    put(landing, "t_2_0.json", {"a": 2, "s": {"x": [1], "y": 2}}, {"a": 3}, {"a": 4, "s": {"y": 2}})
    run(spark, landing, lake)
    assert rows(spark, lake, "t", "a") == [(1,), (3,), (4,)]
    assert [q[2] for q in quarantined(spark, lake)] == ["type_conflict:s"]
    assert [r.column_name for r in lake.drift(spark).collect()] == ["s"]


def test_unusual_column_names(spark, landing, lake):
    record = {"a.b": 1, "c d": 2, "value": 3, "line": 4, "file": 5, "reason": 6, "row": 7}
    record["deep"] = {"e-f": 1, "g.h": [{"i j": 2}]}
    put(landing, "t_1_0.json", record)
    run(spark, landing, lake)
    put(landing, "t_2_0.json", record)
    run(spark, landing, lake)
    df = lake.open(spark).read("t")
    got = [r.asDict(recursive=True) for r in df.drop("report_date").collect()]
    assert got == [record, record]
    assert lake.drift(spark).count() == 0


def test_column_spelling_follows_the_registry(spark, landing, lake):
    put(landing, "t_1_0.json", {"Mac": "x"})
    run(spark, landing, lake)
    put(landing, "t_2_0.json", {"mac": "y"})
    run(spark, landing, lake)
    assert rows(spark, lake, "t", "Mac") == [("x",), ("y",)]


def test_unusual_file_names(spark, landing, lake):
    put(landing, "t a_1_0.json", {"a": 1})
    put(landing, "t[1]_1_0.json", {"a": 2})
    put(landing, "t%20+_1_0.json", {"a": 3})
    put(landing, "u_1_0.json", {"a": 4})
    run(spark, landing, lake)
    got = {name: rows(spark, lake, name, "a") for name in lake.open(spark).tables}
    assert got == {"t a": [(1,)], "t[1]": [(2,)], "t%20+": [(3,)], "u": [(4,)]}
    assert all(status == ("done", 1, 0) for status in audited(spark, lake).values())


def test_pages_hold_at_most_the_given_files(spark, landing, lake):
    for i in range(7):
        put(landing, f"t_{i}_0.json", {"a": i})
    run(spark, landing, lake, page_files=3)
    pages = ingest.audit_summary(spark, lake, BATCH).collect()
    assert sorted(p.found_files for p in pages) == [1, 3, 3]
    assert rows(spark, lake, "t", "a") == [(i,) for i in range(7)]

    cycle = ingest.audit_summary(spark, lake).first()
    assert (cycle.found_files, cycle.done_files, cycle.bad_files, cycle.rows_done) == (7, 7, 0, 7)


def test_result_does_not_depend_on_paging(spark, tmp_path):
    """Rows, types, quarantine and drift of the same files, one a page, two a page, and all in one."""
    files = {
        "a_1_0.json": ['{"v":1.5,"n":null,"s":{}}', '{"v":null}'],
        "a_2_0.json": ['{"v":9007199254740993,"n":1,"s":{"x":1}}', '{"v":9007199254740992}', '{"N":7}'],
        "a_3_0.json": ['{"v":2,"n":2.5,"s":{"x":"no","y":2}}', '{"v":0.1,"s":{"x":2,"z":"new"}}', '{"v":1e300}', '{"v":"NaN"}'],
        "b_4_0.json": ['{"v":1}'],
        "b_5_0.json": ['{"v":2.5}', '{"v":2.0}', '{"v":123456789012345678901234567890}'],
        "b_6_0.json": ['{"v":9007199254740993}', '{"v":true}', '{"v":"4"}', "{'v':5}", '{"v":6,"w":1,"w":2}', "[]", "7", '[{"v":8},{"v":9}]'],
        "c_7_0.json": ["{}", '{"q":null}'],
        "c_8_0.json": ['{"q":12345678901234567890123}'],
        "c_9_0.json": ['{"q":12345678901234567890124}', '{"q":1}', '{"q":0.5}', '{"q":true}'],
    }
    results = []
    for size in (1, 2, 100):
        landing, own = tmp_path / f"landing-{size}", Lake(str(tmp_path / f"lake-{size}"))
        landing.mkdir()
        for i, (name, texts) in enumerate(files.items()):
            path = put(landing, name, *texts)
            os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
        run(spark, landing, own, page_files=size)
        opened = own.open(spark)
        drift = {(r.table_name, r.column_name) for r in own.drift(spark).collect()}
        results.append(
            (
                {t: (opened.columns(t).simpleString(), rows(spark, own, t)) for t in opened.tables},
                quarantined(spark, own),
                drift,
                audited(spark, own),
            )
        )
    for other in results[1:]:
        for one, two in zip(results[0], other, strict=True):
            assert one == two
    tables, aside, drift, _ = results[0]
    assert tables["a"][0] == "struct<N:bigint,s:struct<x:bigint,z:string>,v:double,report_date:date>"
    assert tables["b"] == ("struct<v:bigint,report_date:date>", sorted([(1, None), (2, None), (4, None), (8, None), (9, None), (9007199254740993, None)], key=repr))
    assert tables["c"][0] == "struct<q:decimal(38,0),report_date:date>" and len(tables["c"][1]) == 5
    reasons = {(t, record): reason for t, _, reason, record in aside}
    assert reasons == {
        ("a", files["a_2_0.json"][0]): "type_conflict:v",
        ("a", files["a_3_0.json"][0]): "type_conflict:N",
        ("a", '{"v":"NaN"}'): "type_conflict:v",
        ("b", files["b_5_0.json"][0]): "type_conflict:v",
        ("b", files["b_5_0.json"][2]): "type_conflict:v",
        ("b", files["b_6_0.json"][1]): "type_conflict:v",
        ("b", "{'v':5}"): "malformed_json",
        ("b", '{"v":6,"w":1,"w":2}'): "malformed_json",
        ("b", "[]"): "malformed_json",
        ("b", "7"): "malformed_json",
        ("c", '{"q":0.5}'): "type_conflict:q",
        ("c", '{"q":true}'): "type_conflict:q",
    }
    assert ("a", "N") in drift and ("b", "v") in drift


def test_cycles_add_up_their_pages(spark, landing, lake):
    for i in range(5):
        put(landing, f"t_{i}_0.json", {"a": i}, *(["broken"] if i == 3 else []))
    run(spark, landing, lake, page_files=2)
    put(landing, "t_9_0.json", "bad")
    run(spark, landing, lake, page_files=2)
    run(spark, landing, lake, page_files=2)
    got = ingest.cycle_summary(spark, lake).collect()
    numbers = sorted((r.file_chunks, r.found_files, r.done_files, r.bad_files, r.rows_done, r.rows_bad) for r in got)
    assert numbers == [(1, 1, 0, 1, 0, 1), (3, 5, 5, 0, 5, 1)]
    pages = ingest.audit_summary(spark, lake, BATCH).collect()
    assert sum(r.process_seconds for r in got) == pytest.approx(sum(p.longest_page_seconds for p in pages))


def test_page_reads_its_files_once(spark, landing, lake, monkeypatch):
    for t in "abc":
        put(landing, f"{t}_1_0.json", {"x": 1})
    reads = []
    plain = ingest.read_lines
    monkeypatch.setattr(ingest, "read_lines", lambda spark, files: reads.append(len(files)) or plain(spark, files))
    run(spark, landing, lake)
    assert reads == [3]


def test_restart_takes_only_new_files(spark, landing, lake):
    put(landing, "t_1_0.json", {"a": 1})
    run(spark, landing, lake)
    run(spark, landing, lake)
    put(landing, "t_2_0.json", {"a": 2})
    run(spark, landing, lake)
    assert rows(spark, lake, "t", "a") == [(1,), (2,)]


def test_new_checkpoint_never_overwrites_older_batches(spark, landing, lake, tmp_path):
    put(landing, "t_1_0.json", {"a": 1})
    run(spark, landing, lake, "first")
    other = tmp_path / "other"
    other.mkdir()
    put(other, "t_1_0.json", {"a": 2})
    run(spark, other, lake, "second")
    assert rows(spark, lake, "t", "a") == [(1,), (2,)]


def test_replayed_page_changes_nothing(spark, landing, lake):
    path = put(landing, "t_1_0.json", {"a": 1, "report_date": "2024-01-01"}, {"a": 2}, "{")
    file = ingest.LandingFile(str(path), path.name, path.stat().st_size, "t")
    for _ in range(2):
        ingest.ingest_page(spark, lake, "run-0000000001", [file])
        assert rows(spark, lake, "t", "a") == [(1,), (2,)]
        assert len(quarantined(spark, lake)) == 1
        assert lake.registry(spark).count() == 1 and lake.audit(spark).count() == 1


MIXED = [
    {"Mac": 1},
    {"mac": 2},
    {"mac": 3, "report_date": "2024-01-02"},
    '{"Mac":4,"mac":5}',
    '{"Mac":6},{"b":7}',
    '{"Mac":8,"_batch_id":9}',
    {"report_date": "2024-01-01"},
    {"s": {"x": 1}},
    {"s": "oops"},
    {"s": {"x": "no", "y": 1}},
    {"s": {"y": 2, "l": [{"p": 1}]}},
    {"s": {"X": 3}},
    {"s": {"x": 4, "l": [{"P": 1}]}},
    {"n": 9007199254740993},
    {"n": 2.5},
    {"n": 3.0},
    {"n": "4"},
    {"t": 1.50},
    {"t": {"deep": [1, 2]}},
    {},
]


@pytest.mark.parametrize("page_files", [1, 100])
def test_lines_are_judged_one_by_one_at_every_page_size(spark, landing, lake, page_files):
    put(landing, "t_0_0.json", {"Mac": 0, "s": {"x": 0, "l": [{"p": 0}]}, "n": 0, "t": "a"})
    run(spark, landing, lake)
    for i, record in enumerate(MIXED, 1):
        put(landing, f"t_{i}_0.json", record)
    run(spark, landing, lake, page_files=page_files)
    assert {q[3].replace(" ", ""): q[2] for q in quarantined(spark, lake)} == {
        '{"Mac":4,"mac":5}': "unreadable_schema",
        '{"Mac":6},{"b":7}': "malformed_json",
        '{"Mac":8,"_batch_id":9}': "unreadable_schema",
        '{"s":"oops"}': "type_conflict:s",
        '{"s":{"x":"no","y":1}}': "type_conflict:s",
        '{"s":{"X":3}}': "type_conflict:s",
        '{"s":{"x":4,"l":[{"P":1}]}}': "type_conflict:s",
        '{"n":2.5}': "type_conflict:n",
    }
    table = lake.open(spark).read("t")
    got = [{k: v for k, v in r.asDict(True).items() if v is not None} for r in table.collect()]
    plain = [{k: str(v) if k == "report_date" else v for k, v in row.items()} for row in got]

    def without_nulls(value):
        return {k: v for k, v in value.items() if v is not None} if isinstance(value, dict) else value

    plain = [{k: without_nulls(v) for k, v in row.items()} for row in plain]
    expected = [
        {"Mac": 0, "s": {"x": 0, "l": [{"p": 0}]}, "n": 0, "t": "a"},
        {"Mac": 1},
        {"Mac": 2},
        {"Mac": 3, "report_date": "2024-01-02"},
        {"report_date": "2024-01-01"},
        {"s": {"x": 1}},
        {"s": {"y": 2, "l": [{"p": 1}]}},
        {"n": 9007199254740993},
        {"n": 3},
        {"n": 4},
        {"t": "1.5"},
        {"t": '{"deep":[1,2]}'},
        {},
    ]

    def ordered(rows):
        return sorted(json.dumps(row, sort_keys=True) for row in rows)

    assert ordered(plain) == ordered(expected)


def test_new_checkpoint_takes_no_finished_file_again(spark, landing, lake):
    put(landing, "t_1_0.json", {"a": 1})
    run(spark, landing, lake, "first")
    put(landing, "t_2_0.json", {"a": 2})
    run(spark, landing, lake, "second")
    assert rows(spark, lake, "t", "a") == [(1,), (2,)]
    assert len(audited(spark, lake)) == 2


def test_name_used_again_is_ingested_again(spark, landing, lake):
    put(landing, "t_1_0.json", {"a": 1})
    put(landing, "t_2_0.json", {"a": 2})
    run(spark, landing, lake)
    assert ingest.ingest_again(spark, str(landing), lake) == 0
    (landing / "t_1_0.json").unlink()
    put(landing, "t_1_0.json", {"a": 3}, {"a": 4})
    run(spark, landing, lake)
    assert rows(spark, lake, "t", "a") == [(1,), (2,)]
    assert ingest.ingest_again(spark, str(landing), lake) == 1
    assert ingest.ingest_again(spark, str(landing), lake) == 0
    assert rows(spark, lake, "t", "a") == [(1,), (2,), (3,), (4,)]
    assert lake.audit(spark).count() == 3


def test_page_cut_off_is_done_again_under_its_key(spark, landing, lake, monkeypatch):
    put(landing, "t_1_0.json", {"a": 1})
    put(landing, "t_2_0.json", {"a": 2})
    real = Lake.write_log
    with monkeypatch.context() as patch:
        patch.setattr(
            Lake, "write_log",
            lambda self, s, kind, *rest, **more: 1 / 0 if kind == "audit" else real(self, s, kind, *rest, **more),
        )
        with pytest.raises(ZeroDivisionError):
            ingest.ingest_again(spark, str(landing), lake)
    assert ingest.ingest_again(spark, str(landing), lake, page_files=1) == 1
    assert rows(spark, lake, "t", "a") == [(1,), (2,)]


def test_replay_without_a_file_leaves_none_of_its_rows(spark, landing, lake):
    one = put(landing, "t_1_0.json", {"a": 1, "report_date": "2024-01-01"}, "{")
    two = put(landing, "t_2_0.json", {"a": 2, "report_date": "2024-01-02"})
    files = [ingest.LandingFile(str(p), p.name, p.stat().st_size, "t") for p in (one, two)]
    ingest.ingest_page(spark, lake, "run-0000000001", files)
    one.unlink()
    ingest.ingest_page(spark, lake, "run-0000000001", files[1:])
    assert rows(spark, lake, "t", "a") == [(2,)] and quarantined(spark, lake) == []
    assert audited(spark, lake) == {"t_1_0.json": ("missing", 0, 0), "t_2_0.json": ("done", 1, 0)}


def test_first_type_of_a_column_stays(spark, lake):
    for batch, n, s in [("z", "bigint", "struct<x:bigint>"), ("a", "decimal(30,10)", "struct<y:string>"), ("m", "int", "struct<x:double,z:int>")]:
        schemas.record_schemas(spark, lake, batch, [("t", "n", n), ("t", "s", s)], known=[])
    assert {r.column_name: r.data_type for r in lake.registry(spark).collect()} == {
        "n": "bigint",
        "s": "struct<x:bigint,y:string,z:int>",
    }


def test_failed_cycle_is_started_again(spark, landing, lake, monkeypatch):
    put(landing, "t_1_0.json", {"a": 1})
    real, calls = Lake.write_log, []

    def failing(self, session, kind, *rest, **more):
        calls.append(kind)
        if kind == "audit" and calls.count("audit") == 1:
            raise RuntimeError("executor lost")
        real(self, session, kind, *rest, **more)

    monkeypatch.setattr(Lake, "write_log", failing)
    ingest.keep_ingesting(
        lambda: ingest.start_ingest(spark, str(landing), lake, lake.path("checkpoint")), 0.1, 1
    )
    assert calls.count("audit") == 2
    assert rows(spark, lake, "t", "a") == [(1,)]


def test_failures_are_raised_after_the_limit(spark, landing, lake, monkeypatch):
    put(landing, "t_1_0.json", {"a": 1})
    monkeypatch.setattr(ingest, "ingest_page", lambda *a: 1 / 0)
    with pytest.raises(StreamingQueryException):
        ingest.keep_ingesting(
            lambda: ingest.start_ingest(spark, str(landing), lake, lake.path("checkpoint")), 0.1, 1
        )


def test_file_taken_away_does_not_block_its_page(spark, landing, lake, monkeypatch):
    gone = put(landing, "t_1_0.json", {"a": 1})
    put(landing, "t_2_0.json", {"a": 2})
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "ingest_page", lambda *a: 1 / 0)
        with pytest.raises(StreamingQueryException):
            run(spark, landing, lake)
    gone.unlink()
    run(spark, landing, lake)
    assert rows(spark, lake, "t", "a") == [(2,)]


def test_archive_moves_files_of_committed_pages(spark, landing, lake):
    for i in range(5):
        put(landing, f"t_{i}_0.json", {"a": i})
    archive = lake.path("archive")
    run(spark, landing, lake, page_files=1, archive=archive)
    deadline = time.monotonic() + 10
    while time.monotonic() < deadline and len(os.listdir(landing)) > 1:
        time.sleep(0.2)
    moved = ingest.discover_landing(spark, archive, recursive=True)
    assert moved.where("table_name = 't'").count() >= 1
    assert moved.count() + len([n for n in os.listdir(landing) if n.endswith(".json")]) == 5
    assert rows(spark, lake, "t", "a") == [(i,) for i in range(5)]


def test_running_ingest_picks_up_later_files(spark, landing, lake):
    put(landing, "t_1_0.json", {"a": 1})
    query = ingest.start_ingest(
        spark, str(landing), lake, lake.path("checkpoint"), interval="1 second"
    )
    try:
        query.processAllAvailable()
        put(landing, "t_2_0.json", {"a": 2})
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(spark, lake, "t", "a") == [(1,), (2,)]


def test_intake_does_not_read_content(spark, landing):
    put(landing, "t_1_0.json", {"a": 1})
    plan = ingest.discover_landing(spark, str(landing))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan


@pytest.fixture
def small_partitions(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    yield
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_hot_date_is_written_by_several_tasks(spark, landing, lake, small_partitions):
    """A third of the rows on one date must not end in one task or one file."""
    n = 120_000
    day = F.when(F.col("id") % 3 == 0, "2024-01-01").otherwise(
        F.date_add(F.lit("2024-02-01").cast("date"), (F.col("id") % 40).cast("int")).cast("string")
    )
    record = F.struct("id", F.sha2(F.col("id").cast("string"), 256).alias("h"), day.alias("report_date"))
    (
        spark.range(0, n, 1, 8)
        .select(F.to_json(record).alias("value"))
        .write.mode("append")
        .option("mapreduce.output.basename", "t_1_0.json")
        .text(str(landing))
    )
    run(spark, landing, lake, glob="*.json*")
    table = lake.open(spark).read("t")
    assert table.count() == n and table.agg(F.count_distinct("id")).first()[0] == n
    hot = table.where("report_date = '2024-01-01'")
    per_file = [r["count"] for r in hot.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == n // 3 and max(per_file) < n // 9


def test_late_file_with_an_old_time_stamp_is_taken(spark, landing, lake):
    put(landing, "t_1_0.json", {"a": 1})
    run(spark, landing, lake)
    old = put(landing, "t_2_0.json", {"a": 2})
    os.utime(old, (1_000_000_000, 1_000_000_000))
    archive = lake.path("archive")
    checkpoint = lake.path("checkpoint")
    assert ingest.ingest_all(spark, str(landing), lake, checkpoint, archive=archive) == 2
    assert rows(spark, lake, "t", "a") == [(1,), (2,)]
    # Nothing is left in the landing folder, and nothing is taken twice.
    assert [n for n in os.listdir(landing) if n.endswith(".json")] == []
    moved = ingest.discover_landing(spark, archive, recursive=True)
    assert sorted(r.name for r in moved.collect()) == ["t_1_0.json", "t_2_0.json"]
    put(landing, "t_3_0.json", {"a": 3})
    put(landing, "t_4_0.json", end="")
    assert ingest.ingest_all(spark, str(landing), lake, checkpoint, archive=archive) == 1
    assert rows(spark, lake, "t", "a") == [(1,), (2,), (3,)]


def test_stream_forgets_old_paths_and_running_ingest_takes_late_files(spark, landing, lake):
    def at(name, value, seconds):
        path = put(landing, name, {"a": value})
        os.utime(path, (seconds, seconds))

    at("t_1_0.json", 1, 1_700_000_000)
    query = ingest.start_ingest(
        spark, str(landing), lake, lake.path("checkpoint"), interval="1 second",
        page_files=1, max_age_ms=60_000, late_every=2,
    )
    try:
        query.processAllAvailable()
        at("t_2_0.json", 2, 1_600_000_000)
        at("t_3_0.json", 3, 1_700_000_500)
        at("t_4_0.json", 4, 1_700_000_600)
        query.processAllAvailable()
        taken = rows(spark, lake, "t", "a")
    finally:
        query.stop()
    assert taken == [(1,), (2,), (3,), (4,)]
    batches = {r.file_name: r[BATCH] for r in lake.audit(spark).collect()}
    assert [n for n, b in batches.items() if b.startswith(ingest.AGAIN)] == ["t_2_0.json"]


def count_files(path):
    return sum(n.endswith(".parquet") for _, _, names in os.walk(path) for n in names)


def test_compaction_leaves_few_files_and_all_rows(spark, landing, lake):
    for i in range(6):
        put(landing, f"t_{i}_0.json", *[{"a": i * 10 + j, "report_date": f"2024-01-0{j + 1}"} for j in range(4)])
    put(landing, "u_1_0.json", {"a": 1})
    run(spark, landing, lake, page_files=1)
    before = rows(spark, lake, "t")
    location = compact.compact_table(spark, lake, "t")
    assert count_files(lake.table_path("t")) == 24 and count_files(location) == 4
    assert rows(spark, lake, "t") == before

    put(landing, "t_7_0.json", {"a": 99, "b": "new"})
    run(spark, landing, lake)
    assert len(rows(spark, lake, "t")) == len(before) + 1
    assert compact.compact_all(spark, lake) == (["t", "u"], [])
    opened = lake.open(spark)
    assert opened.published("t").version == 2 and opened.published("t").rows == 25
    assert (99, "new", None) in rows(spark, lake, "t", "a", "b", "report_date")
    assert opened.register() == ["t", "u"]
    assert spark.sql("select count(*) from t").first()[0] == 25


def test_superseded_folders_can_be_dropped(spark, landing, lake):
    for i in range(3):
        put(landing, f"t_{i}_0.json", {"a": i, "report_date": "2024-01-01"})
        run(spark, landing, lake)
        if i < 2:
            compact.compact_table(spark, lake, "t")
    assert compact.drop_superseded(spark, lake, "t") == 3
    assert count_files(lake.table_path("t")) == 1
    assert count_files(lake.path("snapshots", "t")) == 1
    assert rows(spark, lake, "t", "a") == [(0,), (1,), (2,)]
    assert compact.drop_superseded(spark, lake, "t") == 0
    compact.compact_table(spark, lake, "t")
    compact.drop_superseded(spark, lake, "t")
    assert rows(spark, lake, "t", "a") == [(0,), (1,), (2,)]


def test_crashed_compaction_is_tried_again(spark, landing, lake, monkeypatch):
    put(landing, "t_1_0.json", {"a": 1})
    run(spark, landing, lake)
    with monkeypatch.context() as patch:
        patch.setattr(Lake, "write_log", lambda *a: 1 / 0)
        good, bad = compact.compact_all(spark, lake)
    assert good == [] and bad[0][0] == "t"
    assert rows(spark, lake, "t", "a") == [(1,)]
    assert compact.compact_all(spark, lake) == (["t"], [])
    assert compact.drop_superseded(spark, lake, "t") == 2
    assert rows(spark, lake, "t", "a") == [(1,)]


def snapshot_files(df):
    return {f for f in df.inputFiles() if "/snapshots/" in f}


def test_untouched_dates_keep_their_files(spark, landing, lake):
    put(landing, "t_1_0.json", *[{"a": i, "report_date": f"2024-01-0{i}"} for i in (1, 2, 3)], {"a": 0})
    run(spark, landing, lake)
    compact.compact_table(spark, lake, "t")
    first = snapshot_files(lake.open(spark).read("t"))
    assert len(first) == 4
    put(landing, "t_2_0.json", {"a": 9, "report_date": "2024-01-02"}, {"a": 8})
    run(spark, landing, lake)
    batch = lake.audit(spark).agg(F.max(BATCH)).first()[0]
    compact.compact_table(spark, lake, "t")
    table = lake.open(spark).read("t")
    kept = first & snapshot_files(table)
    assert sorted(f.split("report_date=")[1].split("/")[0] for f in kept) == ["2024-01-01", "2024-01-03"]
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(batch) == 1 and "IN (" not in plan and "INSET" not in plan
    assert rows(spark, lake, "t", "a") == [(0,), (1,), (2,), (3,), (8,), (9,)]
    compact.compact_table(spark, lake, "t")
    assert snapshot_files(lake.open(spark).read("t")) == snapshot_files(table)


def test_unfinished_batch_is_not_compacted(spark, landing, lake):
    put(landing, "t_1_0.json", {"a": 1})
    run(spark, landing, lake)
    stray = spark.createDataFrame([(2,)], "a bigint").withColumn("report_date", F.lit(None).cast("date"))
    ingest.write_batch(stray, lake.table_path("t"), "run-unfinished", "report_date")
    compact.compact_table(spark, lake, "t")
    assert lake.open(spark).published("t").rows == 1
    assert rows(spark, lake, "t", "a") == [(1,), (2,)]


def test_page_under_way_is_not_seen_in_any_table(spark, landing, lake, monkeypatch):
    put(landing, "t_1_0.json", {"a": 1})
    put(landing, "u_1_0.json", {"b": 1})
    run(spark, landing, lake)
    put(landing, "t_2_0.json", {"a": 2})
    put(landing, "u_2_0.json", {"b": 2})
    put(landing, "v_2_0.json", {"c": 2})
    real, seen = Lake.write_log, []

    def looking(self, session, kind, *args, **options):
        if kind == "audit":  # every table of the page is written by now
            opened = self.open(spark)
            seen.append([opened.read(t).count() for t in ("t", "u", "v")])
            seen.append(opened)
        return real(self, session, kind, *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(Lake, "write_log", looking)
        run(spark, landing, lake)
    assert seen[0] == [1, 1, 0]
    # A lake opened before the page ended goes on without it.
    assert [seen[1].read(t).count() for t in ("t", "u", "v")] == [1, 1, 0]
    opened = lake.open(spark)
    assert [opened.read(t).count() for t in ("t", "u", "v")] == [2, 2, 1]
    plan = opened.read("t")._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan and "Join" not in plan


def test_folded_logs_say_the_same_in_few_files(spark, landing, lake):
    def page(i):
        put(landing, f"t_{i}_0.json", {"a": i, f"c{i}": 1}, "oops", *[{"a": "x"}][: i])
        run(spark, landing, lake, page_files=1)

    def state():
        return audited(spark, lake), quarantined(spark, lake), sorted(map(tuple, lake.registry(spark).collect()))

    def files():
        return {kind: len(lake.log(spark, kind, schema).inputFiles()) for kind, schema in FOLDED.items()}

    found = []
    for i in range(12):
        page(i)
        if i % 3 == 2:
            before = state()
            compact.fold_logs(spark, lake)
            assert state() == before
            assert compact.fold_logs(spark, lake) and state() == before
            found.append(files())
    assert len(state()[0]) == 12 and len(state()[1]) == 23
    # Every fold leaves the newest page and what the fold before it replaced.
    assert all(found[-1][kind] <= found[0][kind] + 3 for kind in FOLDED), found
    assert len(list((landing.parent / "lake" / "audit").glob("_batch_id=*"))) <= 4
    assert len(list((landing.parent / "lake" / "claims").glob("_batch_id=*"))) == 1
    # A new checkpoint finds what is done in the folded audit.
    run(spark, landing, lake, checkpoint="other")
    assert len(rows(spark, lake, "t")) == 12
    compact.compact_table(spark, lake, "t")
    assert sorted(rows(spark, lake, "t", "a")) == [(i,) for i in range(12)]


def test_last_page_can_be_done_again_after_a_fold(spark, landing, lake):
    for i in range(3):
        put(landing, f"t_{i}_0.json", {"a": i}, "oops")
        files = [f for f in map(ingest.landing_file, ingest.discover_landing(spark, str(landing)).collect()) if f.name == f"t_{i}_0.json"]
        ingest.ingest_page(spark, lake, f"run-{i:010d}", files)
    assert compact.fold_logs(spark, lake) == ["run-0000000001"]
    before = rows(spark, lake, "t"), quarantined(spark, lake), audited(spark, lake)
    ingest.ingest_page(spark, lake, "run-0000000002", files)
    assert (rows(spark, lake, "t"), quarantined(spark, lake), audited(spark, lake)) == before


def test_counts_leave_compacted_dates_unread(spark, landing, lake):
    put(landing, "t_1_0.json", *[{"a": i, "report_date": f"2024-01-0{i % 3 + 1}"} for i in range(9)], {"a": 0})
    run(spark, landing, lake)
    compact.compact_table(spark, lake, "t")
    put(landing, "t_2_0.json", {"a": 9, "report_date": "2024-01-02"}, {"a": 8})
    run(spark, landing, lake)
    counts = lake.open(spark).counts_by_date("t")
    got = {str(r.report_date): r["rows"] for r in counts.collect()}
    assert got == {"2024-01-01": 3, "2024-01-02": 4, "2024-01-03": 3, "None": 2}
    assert not snapshot_files(counts)
    assert "ReadSchema: struct<>" in counts._sc._jvm.PythonSQLUtils.explainString(counts._jdf.queryExecution(), "formatted")


def test_table_without_the_date_is_compacted_whole(spark, tmp_path):
    spark.range(0, 100, 1, 20).write.parquet(str(tmp_path / "many"))
    source = spark.read.parquet(str(tmp_path / "many"))
    assert compact.compact_folder(source, str(tmp_path / "few"), "report_date") == 100
    assert count_files(tmp_path / "few") < count_files(tmp_path / "many")


def test_a_date_with_many_rows_is_written_by_several_tasks(spark, tmp_path):
    days = "case when id < 9000 then null when id < 9900 then date'2024-01-01' else date_add(date'2024-02-01', int(id % 20)) end"
    rows = spark.range(0, 10000, 1, 3).selectExpr("id", f"{days} as report_date")
    dealt = ingest.spread(rows, "report_date", 10)
    assert dealt.columns == rows.columns
    sizes = [r[0] for r in dealt.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) > 10 and max(sizes) <= 1010
    path = str(tmp_path / "table")
    ingest.write_batch(rows, path, "b", "report_date", 10)
    read = spark.read.parquet(path)
    assert read.count() == 10000 and read.select("id").distinct().count() == 10000
    assert read.where("report_date is null").count() == 9000
    files = read.select("report_date", F.input_file_name().alias("file")).distinct().groupBy("report_date").count().collect()
    assert all((r["count"] == 1) == (r.report_date is not None) for r in files) and len(files) == 22
    assert ingest.spread(rows.where("false"), "report_date", 3).count() == 0


def test_a_page_with_many_rows_is_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "TASK_ROWS", 10)
    lake, landing = Lake(str(tmp_path / "lake")), tmp_path / "landing"
    landing.mkdir()
    (landing / "some_data_1_0.json").write_text("\n".join(json.dumps({"v": i}) for i in range(200)) + "\n{oops" * 90)
    ingest.ingest_page(spark, lake, "b", [ingest.landing_file(r) for r in ingest.discover_landing(spark, str(landing)).collect()])
    stored = lake.open(spark).read("some_data")
    assert sorted(r.v for r in stored.select("v").collect()) == list(range(200))
    assert stored.select(F.input_file_name()).distinct().count() > 5
    aside = lake.quarantine(spark)
    assert [tuple(r) for r in aside.select("record", "reason").collect()] == [("{oops", ingest.MALFORMED)] * 90
    assert aside.select(F.input_file_name()).distinct().count() == 9


def test_lines_are_parsed_once(spark):
    lines = spark.createDataFrame([("f", '{"v":1}'), ("f", "[1"), ("g", "{oops"), ("f", '{"v":1},{"v":2}')], "file string, line string")
    fields = [StructField("v", LongType())]
    parsed = ingest.parse_lines(lines, StructType(fields))
    assert parsed.columns == ["file", "line", "record"]
    assert [r.record and r.record[0] for r in parsed.collect()] == [1, None, None, None]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    # A file without any JSON object has no schema.
    assert list(ingest.file_schemas(lines)) == ["f"]
