from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from telemetry_lake.operators import reports, sinks
from telemetry_lake.plans.daily_report import run_report


def dated(spark):
    rows = [(i, date(2024, 1, 1) + timedelta(days=i % 5), [None, "", "v1"][i % 3]) for i in range(60)]
    return spark.createDataFrame(rows, "id int, report_date date, fw_version string")


def test_bound_includes_its_first_day(spark):
    got = reports.since(dated(spark), "report_date", date(2024, 1, 5), 1)
    assert {r.report_date for r in got.collect()} == {date(2024, 1, 4), date(2024, 1, 5)}


def test_bound_defaults_to_today(spark):
    rows = [(date.today() - timedelta(days=d),) for d in range(5)]
    df = spark.createDataFrame(rows, "report_date date")
    assert reports.since(df, "report_date").count() in (1, 2)


def test_null_is_a_group(spark):
    counts = {r.fw_version: r["count"] for r in reports.count_by(dated(spark), "fw_version").collect()}
    assert counts == {None: 20, "": 20, "v1": 20}


def test_devices_ignore_null_and_unmatched_and_duplicates(spark):
    a = spark.createDataFrame(
        [(1, "m1"), (1, "m1"), (1, "m2"), (2, None), (3, "m3"), (9, "m9"), (None, "m0")],
        "report_id int, mac string",
    )
    b = spark.createDataFrame(
        [(1, "c1"), (1, "c1"), (1, "c2"), (2, "c2"), (2, "c3"), (3, None), (None, "c4")],
        "report_id int, configuration string",
    )
    got = {r.configuration: r.devices for r in reports.devices_per_configuration(a, b).collect()}
    assert got == {"c1": 2, "c2": 2, "c3": 0, None: 1}


def test_devices_with_a_key_hot_on_both_sides(spark):
    """A third of all rows on both sides share a key; the join must not multiply them."""
    n = 60_000
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    a = spark.range(n).select(hot.alias("report_id"), (F.col("id") % 1000).alias("mac"))
    b = spark.range(n).select(hot.alias("report_id"), (F.col("id") % 4).alias("configuration"))
    result = reports.devices_per_configuration(a, b)
    rows = {r.configuration: r.devices for r in result.collect()}
    pa, pb = a.toPandas(), b.toPandas().drop_duplicates()
    expected = pa.merge(pb, on="report_id").groupby("configuration").mac.nunique().to_dict()
    assert rows == expected


def test_a_hot_report_key_is_split(spark):
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
        a = spark.range(0, 300_000, 1, 8).select(hot.alias("report_id"), F.hash("id").alias("mac"))
        b = spark.range(0, 300_000, 1, 8).select(
            hot.alias("report_id"), (F.col("id") % 4).alias("configuration")
        )
        result = reports.devices_per_configuration(a, b)
        result.write.format("noop").mode("overwrite").save()
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "skew=true" in plan


def test_first_n_is_a_top_k_not_a_full_sort(spark):
    plan = reports.first_n(dated(spark), 3, "id")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_summary_is_one_scan_of_one_column(spark, tmp_path):
    path = str(tmp_path / "t")
    dated(spark).write.parquet(path)
    df = reports.report_summary(spark.read.parquet(path), "report_date", date(2024, 1, 5))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<report_date:date>" in plan


def test_date_bound_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append_by_date(dated(spark), path, "report_date")
    df = reports.count_by_since(spark.read.parquet(path), "fw_version", "report_date", date(2024, 1, 5))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_date" in plan
    assert "ReadSchema: struct<fw_version:string>" in plan


def test_report_run_and_history(spark, tmp_path):
    out = str(tmp_path / "report")
    hardware = dated(spark).select("report_date", F.col("fw_version").alias("hardware"))
    for day, overwrite in [(4, False), (5, False), (5, True)]:
        when = datetime(2024, 1, day, 9, 30, 0)
        run_report(dated(spark), hardware, out, when, overwrite_history=overwrite)
    history = sinks.read_history(spark, f"{out}/history").collect()
    assert [tuple(r) for r in history] == [("2024-01-05 09:30:00", 60, 24)]
    files = list((tmp_path / "report" / "fw_version.csv").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[0] == "fw_version,count"
    got = sinks.read_csv_report(spark, f"{out}/fw_version.csv", "fw_version string, count bigint")
    assert {r.fw_version: r["count"] for r in got.collect()} == {None: 8, "": 8, "v1": 8}


def test_report_is_one_file_only_when_asked(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4)
    for name, files in (("many", 4), ("one", 1)):
        sinks.write_csv_report(df, str(tmp_path / name), single_file=files == 1)
        assert len(list((tmp_path / name).glob("*.csv"))) == files
        assert sinks.read_csv_report(spark, str(tmp_path / name), "id bigint").count() == 1000


def test_csv_reads_back_as_it_was(spark, tmp_path):
    texts = ["x\ny", "\\N", "\\\\N", None, "", " a ", '"q", \\"r\\', "a\r\nb", "N", ",", "\\"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, `a.b` string")
    df.createOrReplaceTempView("csv_texts")
    sinks.export_csv(spark, "select * from csv_texts", str(tmp_path / "c"))
    got = sinks.read_csv_report(spark, str(tmp_path / "c"), "id int, `a.b` string")
    assert {r[0]: r[1] for r in got.collect()} == dict(enumerate(texts))


def test_history_is_empty_before_the_first_run(spark, tmp_path):
    assert sinks.read_history(spark, str(tmp_path / "none")).collect() == []
