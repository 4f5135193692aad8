import json

import pytest
from pyspark.sql import functions as F

from telemetry_lake.operators.compact import compact_table
from telemetry_lake.operators.device_sets import DeviceSets
from telemetry_lake.plans.lake import Lake
from telemetry_lake.streaming import ingest


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


class Landing:
    """Lands rows of both tables and remembers them."""

    def __init__(self, spark, folder, lake):
        self.spark, self.folder, self.lake = spark, folder, lake
        self.reports, self.info, self.pages = [], [], 0

    def land(self, reports, info):
        self.pages += 1
        for name, rows, columns in (
            ("report_data", reports, ("report_id", "mac", "report_date")),
            ("flat_info_data", info, ("report_id", "configuration", "report_date")),
        ):
            records = [{c: v for c, v in zip(columns, row) if v is not None} for row in rows]
            if records:
                path = self.folder / f"{name}_{self.pages}_0.json"
                path.write_text("".join(json.dumps(r) + "\n" for r in records))
        self.reports += reports
        self.info += info
        ingest.start_ingest(
            self.spark, str(self.folder), self.lake, self.lake.path("checkpoint")
        ).awaitTermination()

    def compact(self):
        for name in ("report_data", "flat_info_data"):
            compact_table(self.spark, self.lake, name)

    def exact(self):
        devices = {}
        for key, mac, day in self.reports:
            for other, configuration, info_day in self.info:
                if key is not None and (key, day) == (other, info_day):
                    devices.setdefault(configuration, set()).add(mac)
        return {c: len(macs - {None}) for c, macs in devices.items()}


@pytest.fixture
def landed(spark, landing, lake):
    return Landing(spark, landing, lake)


def counted(spark, sets):
    rows = sets.count(spark).collect()
    got = {r.configuration: r.devices for r in rows}
    assert len(got) == len(rows)
    return got


def day(n):
    return f"2024-01-{n:02d}"


def test_counts_equal_an_exact_count_at_every_step(spark, landed, lake):
    sets = DeviceSets(lake)
    # Shared devices over dates, repeated rows, a NULL device, key and configuration, no date.
    reports = [(i % 20, f"m{i % 13}", day(1 + i % 3)) for i in range(60)] + [(3, "m3", day(1))] * 5
    reports += [(50, None, day(1)), (None, "m1", day(1)), (51, "u", None), (52, "x", day(9))]
    info = [(i % 20, "abc"[i % 3], day(1 + i % 3)) for i in range(60)]
    info += [(50, "only null", day(1)), (51, "undated", None), (3, None, day(2)), (99, "none", day(1))]
    landed.land(reports, info)
    assert sets.keep(spark) == []
    assert counted(spark, sets) == landed.exact()

    landed.compact()
    assert counted(spark, sets) == landed.exact()
    assert sets.keep(spark) == ["2024-01-01", "2024-01-02", "2024-01-03", "__HIVE_DEFAULT_PARTITION__"]
    assert counted(spark, sets) == landed.exact()
    assert sets.keep(spark) == []

    # New devices and known ones, in a known date and a new one, not compacted yet.
    landed.land([(60, "m1", day(2)), (60, "new", day(2)), (61, "newer", day(8))], [(60, "a", day(2)), (61, "d", day(8))])
    assert counted(spark, sets) == landed.exact()
    landed.compact()
    assert counted(spark, sets) == landed.exact()
    assert sets.keep(spark) == ["2024-01-02", "2024-01-08"]
    assert counted(spark, sets) == landed.exact()
    assert landed.exact()["only null"] == 0 and "none" not in landed.exact()


def test_dates_without_new_rows_are_not_read(spark, landed, lake):
    sets = DeviceSets(lake)
    landed.land([(i, f"m{i}", day(1 + i % 4)) for i in range(40)], [(i, "c", day(1 + i % 4)) for i in range(40)])
    landed.compact()
    sets.keep(spark)
    landed.land([(100, "m100", day(2))], [(100, "c", day(2))])
    result = sets.count(spark)
    assert [tuple(r) for r in result.collect()] == [("c", 41)]
    read = [f for f in result.inputFiles() if "/snapshots/" in f]
    assert read and all("report_date=2024-01-02" in f for f in read)
    kept = [f for f in result.inputFiles() if "/device_sets/" in f and "/sets/" in f]
    assert kept and not any("report_date=2024-01-02" in f for f in kept)


def test_run_cut_off_is_done_again(spark, landed, lake, monkeypatch):
    sets = DeviceSets(lake)
    landed.land([(i, f"m{i % 7}", day(1)) for i in range(20)], [(i, "ab"[i % 2], day(1)) for i in range(20)])
    landed.compact()

    def failing(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Lake, "write_log", failing)
        with pytest.raises(RuntimeError):
            sets.keep(spark)
    assert counted(spark, sets) == landed.exact()
    assert sets.keep(spark) == ["2024-01-01"]
    assert counted(spark, sets) == landed.exact()
    numbers = spark.read.parquet(sets._path("numbers"))
    assert numbers.agg(F.count("*"), F.count_distinct("mac"), F.count_distinct("number")).first() == (7, 7, 7)
