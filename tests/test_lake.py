"""The chain over the snapshot store: what a failure leaves behind, and what a retry makes of it."""

from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from conftest import ARRIVAL
from pyspark.sql import functions as F

from assayer.contracts import DAILY_MART, DAILY_SCHEMA, HOURLY_MART
from assayer.operators import pending
from assayer.operators.publish import merged_windows, read_mart, run_path
from assayer.operators.sinks import overwrite, unit_path
from assayer.operators.snapshots import Change, Part, SnapshotConflict, SnapshotStore
from assayer.plans import lake, stages
from assayer.plans.summaries import month_windows
from assayer.sources import SourceSpec
from assayer.sources.storage import sizes_below

JANUARY, FEBRUARY = {}, {"tpep_pickup_datetime": "2024-02-03 08:00:00", "tpep_dropoff_datetime": "2024-02-03 09:00:00"}
STRAY = {"tpep_pickup_datetime": "2002-12-31 08:00:00", "tpep_dropoff_datetime": "2002-12-31 09:00:00"}
BAD = {"fare_amount": "-1"}


class Chain:
    """Runs of the whole chain below one folder."""

    def __init__(self, spark, bronze_rows, zones_csv, folder):
        self.spark, self.rows, self.folder, self.number = spark, bronze_rows, folder, 0
        self.zones = SourceSpec(zones_csv, "csv", "lookup")
        self.root = f"{folder}/root"
        self.store = lake.store_at(spark, self.root)

    def spec(self, month, *changes):
        self.number += 1
        path = f"{self.folder}/raw-{self.number}"
        self.rows(*changes).drop("_source_file_path", "_batch_id", "_ingested_at").write.parquet(path)
        return SourceSpec(path, "parquet", "tlc", (2024, month))

    def run(self, month, *changes, replace="unit"):
        spec = self.spec(month, *changes)
        return stages.run_all(self.spark, trips=spec, zones=self.zones, root=self.root, run_id=f"r{self.number}", ingested_at=ARRIVAL, replace=replace)

    def mart(self, table=DAILY_MART):
        return {(r["pickup_date"].year, r["pickup_date"].month): r["trip_count"] for r in read_mart(self.spark, f"{self.root}/marts", table).collect()}

    def gold(self):
        return {(r["pickup_year"], r["pickup_month"]): r["trip_count"] for r in lake.read_gold_tables(self.store)[0].collect()}


@pytest.fixture
def chain(spark, bronze_rows, zones_csv, tmp_path):
    return Chain(spark, bronze_rows, zones_csv, tmp_path)


def _dies(*_, **__):
    raise OSError("died here")


@pytest.mark.parametrize("point", ["silver", "before_gold", "gold_commit", "publish", "publish_commit"])
def test_a_run_killed_anywhere_is_made_good_by_the_next(chain, monkeypatch, point):
    """February leaves the unit with the corrected load, which dies; the retry has to take it out of gold and marts."""
    chain.run(1, JANUARY, JANUARY)
    chain.run(2, JANUARY, FEBRUARY)
    before = {(2024, 1): 3, (2024, 2): 1}
    assert chain.gold() == chain.mart() == before
    commits, real = [], SnapshotStore.commit

    def commit(self, base, change, **options):
        commits.append(change)
        if len(commits) == {"gold_commit": 2, "publish_commit": 3}.get(point):
            _dies()
        return real(self, base, change, **options)

    monkeypatch.setattr(SnapshotStore, "commit", commit)
    if point in ("silver", "publish"):
        monkeypatch.setattr(lake, {"silver": "_silver_part", "publish": "publish_marts"}[point], _dies)
    if point == "before_gold":
        monkeypatch.setattr(stages, "refresh_gold", _dies)
    with pytest.raises(OSError, match="died here"):
        chain.run(2, JANUARY, BAD)
    monkeypatch.undo()
    # Readers never see a half: gold and marts are as before, or as after.
    after = {(2024, 1): 3}
    assert chain.gold() == (before if point in ("silver", "before_gold", "gold_commit") else after)
    assert chain.mart() == (after if point == "publish_commit" else before)
    chain.run(2, JANUARY, BAD)
    for table in (DAILY_MART, HOURLY_MART):
        assert chain.mart(table) == after
    assert chain.gold() == after and chain.store.current().pending == {}


def test_a_failed_load_leaves_its_months_to_the_load_of_another_unit(chain, monkeypatch):
    chain.run(1, JANUARY)
    chain.run(2, FEBRUARY)
    lake.load(chain.store, trips=chain.spec(2, FEBRUARY, FEBRUARY), zones=chain.zones, batch_id="b", ingested_at=ARRIVAL)
    run = chain.run(1, JANUARY, JANUARY)
    assert run.silver.months == ((2024, 1),)
    assert chain.mart() == {(2024, 1): 2, (2024, 2): 2}


def test_a_stray_date_stages_its_month_and_not_all_between(chain):
    chain.run(1, JANUARY)
    run = chain.run(3, {"tpep_pickup_datetime": "2024-03-05 08:00:00", "tpep_dropoff_datetime": "2024-03-05 09:00:00"}, STRAY)
    assert run.publish.windows == ((date(2002, 12, 1), date(2002, 12, 31)), (date(2024, 3, 1), date(2024, 3, 31)))
    staged = chain.spark.read.parquet(run_path(f"{chain.root}/marts", DAILY_MART, run.publish.run_id))
    assert {r["pickup_date"].year for r in staged.select("pickup_date").collect()} == {2002, 2024} and staged.count() == 2
    assert chain.mart() == {(2002, 12): 1, (2024, 1): 1, (2024, 3): 1}
    owners = {r["pickup_date"].month: r["publish_run_id"] for r in read_mart(chain.spark, f"{chain.root}/marts", DAILY_MART).collect()}
    assert owners[1] != owners[3] == owners[12]


def test_other_zones_make_all_months_anew(chain, tmp_path):
    chain.run(1, JANUARY)
    chain.run(2, FEBRUARY)
    text = open(chain.zones.path, encoding="utf-8").read()
    (tmp_path / "zones2.csv").write_text(text.replace("Old Harbour", "New Harbour"), encoding="utf-8")
    chain.zones = SourceSpec(str(tmp_path / "zones2.csv"), "csv", "lookup")
    chain.run(2, FEBRUARY)
    names = {r["pickup_zone"] for r in read_mart(chain.spark, f"{chain.root}/marts", DAILY_MART).collect()}
    assert names == {"New Harbour"}


def test_a_whole_load_is_the_only_one_left(chain):
    chain.run(1, JANUARY, BAD)
    chain.run(2, FEBRUARY)
    chain.run(2, FEBRUARY, FEBRUARY, replace="all")
    store = chain.store
    assert set(store.current().of("silver")) == {"tlc-2024-02"} and chain.gold() == {(2024, 2): 2}
    assert lake.read_units(store).count() == 2 and lake.read_units(store, valid=False).count() == 0
    assert {r["source_unit"] for r in lake.read_bronze(store).collect()} == {"tlc-2024-02"}


def test_nothing_to_publish(chain):
    run = chain.run(1, BAD)
    assert run.publish is None and run.gold.daily.rows == 0
    assert stages.run_metrics(chain.spark, run).filter("stage = 'publish'").isEmpty()


def test_gold_reads_rollups_and_a_reload_its_own_unit_only(chain, monkeypatch):
    chain.run(1, JANUARY, JANUARY)
    chain.run(2, JANUARY)
    read = []
    real = lake.trip_rollup
    monkeypatch.setattr(lake, "trip_rollup", lambda trips: read.append(trips.inputFiles()) or real(trips))
    chain.run(2, JANUARY, JANUARY)
    scanned = [file for files in read for file in files]
    assert scanned and all("part_key=tlc-2024-02" in file and "/silver/" in file for file in scanned)
    assert chain.mart() == {(2024, 1): 4}


# ---- the store ----


def _part(store, rows, dataset="numbers", key="a"):
    path = store.fresh(dataset, key)
    return Part(path, overwrite(rows, store.full(path))["rows"])


def _numbers(store, snapshot=None):
    rows = store.read(snapshot or store.current(), "numbers", store.spark.range(0).schema)
    return sorted(r["id"] for r in rows.collect())


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path))


def test_readers_keep_their_snapshot(spark, store):
    assert store.current().version == 0 and _numbers(store) == []
    first = store.commit(store.current(), Change({("numbers", "a"): _part(store, spark.range(3))}))
    open_rows = store.read(first, "numbers", spark.range(0).schema)
    with pytest.raises(Exception, match="broken"):
        _part(store, spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("bigint").alias("id")))
    assert _numbers(store) == [0, 1, 2]
    second = store.commit(first, Change({("numbers", "a"): _part(store, spark.range(5)), ("numbers", "b"): _part(store, spark.range(1), key="b")}))
    assert open_rows.count() == 3 and _numbers(store, first) == [0, 1, 2] and _numbers(store) == [0, 0, 1, 2, 3, 4]
    assert store.at(second.version) == store.current() == second


def test_writers_of_other_parts_do_not_disturb_each_other(spark, store):
    base = store.commit(store.current(), Change({("numbers", "a"): _part(store, spark.range(2))}, mark={"next": ["x"]}))
    store.commit(base, Change({("numbers", "b"): _part(store, spark.range(1), key="b")}, mark={"next": ["y"]}))
    store.commit(base, Change({("numbers", "a"): _part(store, spark.range(3))}, clear={"next": ["x"]}))
    assert _numbers(store) == [0, 0, 1, 2] and store.current().waiting("next") == ("y",)
    with pytest.raises(SnapshotConflict, match="part a of numbers"):
        store.commit(base, Change(drops=[("numbers", "a")]))
    with pytest.raises(SnapshotConflict, match="changed numbers"):
        store.commit(base, Change(clear={"next": ["y"]}), read=["numbers"])
    with pytest.raises(ValueError, match="named by letters"):
        store.fresh("numbers", "../x")


def test_vacuum_keeps_what_is_read(spark, store):
    for n in (2, 3, 4):
        store.commit(store.current(), Change({("numbers", "a"): _part(store, spark.range(n))}))
    _part(store, spark.range(7))
    assert store.vacuum(grace_seconds=3600) == []
    assert len(store.vacuum(keep=1, grace_seconds=-1)) == 3
    assert _numbers(store) == [0, 1, 2, 3] and store.current().version == 3
    with pytest.raises(ValueError, match="current snapshot"):
        store.vacuum(keep=0)


# ---- marks of the stages on plain directories ----


def test_stages_on_directories_hand_unfinished_months_on(spark, bronze_rows, zones, tmp_path, monkeypatch):
    paths = {name: f"{tmp_path}/{name}" for name in ("silver", "zones", "daily", "hourly")}
    overwrite(zones, paths["zones"])

    def silver(*changes):
        overwrite(bronze_rows(*changes), unit_path(f"{tmp_path}/bronze", "m-1"))
        return stages.run_silver(spark, bronze_path=f"{tmp_path}/bronze", silver_path=paths["silver"], unit="m-1")

    def gold(months):
        return stages.run_gold(spark, **{f"{k}_path": v for k, v in paths.items()}, months=months)

    def publish(run_id, months):
        return stages.run_publish(spark, daily_path=paths["daily"], hourly_path=paths["hourly"], mart_root=f"{tmp_path}/marts", run_id=run_id, months=months)

    def mart():
        return {r["pickup_date"].month for r in read_mart(spark, f"{tmp_path}/marts", DAILY_MART).collect()}

    gold(silver(JANUARY, FEBRUARY).months)
    publish("r1", [(2024, 1), (2024, 2)])
    assert mart() == {1, 2}
    silver(JANUARY)
    run = silver(JANUARY)
    assert run.months == ((2024, 1), (2024, 2))
    gold(run.months)
    # The publish fails, and the next load touches January alone.
    monkeypatch.setattr(stages, "publish_marts", _dies)
    with pytest.raises(OSError):
        publish("r2", run.months)
    monkeypatch.undo()
    run = silver(JANUARY, JANUARY)
    assert run.months == ((2024, 1),)
    gold(run.months)
    assert publish("r3", run.months).windows == ((date(2024, 1, 1), date(2024, 2, 29)),)
    assert mart() == {1}
    assert not pending.marked(spark, paths["silver"]) and not pending.marked(spark, paths["daily"])


def test_marks_set_later_stay(spark, tmp_path):
    path = str(tmp_path)
    pending.mark(spark, path, [(2024, 1), (2002, 12)])
    seen = pending.marked(spark, path)
    pending.mark(spark, path, [(2024, 1)])
    pending.clear(spark, seen, [(2024, 1)])
    assert set(pending.marked(spark, path)) == {(2024, 1), (2002, 12)} and len(pending.marked(spark, path)[2024, 1]) == 1


def test_windows_are_merged():
    day = lambda n: date(2024, 1, n)
    assert merged_windows([(day(9), day(9)), (day(1), day(3)), (day(4), day(6)), (day(2), day(2))]) == ((day(1), day(6)), (day(9), day(9)))
    assert month_windows([(2024, 2), (2002, 12), (2024, 1)]) == ((date(2002, 12, 1), date(2002, 12, 31)), (day(1), date(2024, 2, 29)))
    with pytest.raises(ValueError, match="ends before"):
        merged_windows([(day(2), day(1))])


def test_gold_columns_come_back_in_order(chain):
    chain.run(1, JANUARY)
    assert lake.read_gold_tables(chain.store)[0].columns == DAILY_SCHEMA.names


def _spread(chain, month, *changes, files=6):
    """A unit whose raw rows lie in several files, so that its load writes as many for each month."""
    spec = chain.spec(month, *changes)
    path = f"{spec.path}-spread"
    chain.spark.read.parquet(spec.path).repartition(files).write.parquet(path)
    return SourceSpec(path, "parquet", "tlc", (2024, month))


def _silver(chain, snapshot=None):
    rows = [lake.read_units(chain.store, snapshot, valid=valid) for valid in (True, False)]
    return Counter(str(r) for r in rows[0].unionByName(rows[1]).select("vendor_id", "pickup_timestamp", "is_valid", "fare_amount").collect())


def test_compaction_bounds_the_files_of_stray_months_and_changes_no_row(chain):
    store = chain.store
    many = [JANUARY] * 30 + [FEBRUARY] * 12 + [STRAY] * 12 + [BAD] * 12
    lake.load(store, trips=_spread(chain, 1, *many), zones=chain.zones, batch_id="b", ingested_at=ARRIVAL)
    lake.load(store, trips=chain.spec(2, FEBRUARY), zones=chain.zones, batch_id="b", ingested_at=ARRIVAL)
    lake.refresh_gold(store)
    before, rows = store.current(), _silver(chain)
    crowded = sizes_below(chain.spark, store.full(before.of("silver")["tlc-2024-01"].path))
    assert sorted(crowded) == ["row_set=invalid/row_month=all", *[f"row_set=valid/row_month=m{m}" for m in ("2002-12", "2024-01", "2024-02")]]
    assert all(len(files) > 2 for files in crowded.values())
    assert lake.compact_silver(store) == ("tlc-2024-01",)
    after = store.current()
    parts = after.of("silver")
    assert {d: len(f) for d, f in sizes_below(chain.spark, store.full(parts["tlc-2024-01"].path)).items()} == dict.fromkeys(crowded, 1)
    assert parts["tlc-2024-02"] == before.of("silver")["tlc-2024-02"] and parts["tlc-2024-01"].notes == before.of("silver")["tlc-2024-01"].notes
    # The rows are those of before, in either snapshot, and nothing is left to do.
    assert _silver(chain) == _silver(chain, before) == rows
    assert after.pending == before.pending and lake.compact_silver(store) == ()


@pytest.fixture
def one_task_a_file(spark):
    """No two files share a read task, so a load writes as many files as it reads."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_compaction_splits_a_hot_month_and_copies_what_is_well_filled(chain, one_task_a_file):
    """With a tiny target January, all equal rows, is several files of about equal size; February is not crowded."""
    store = chain.store
    spec = _spread(chain, 1, *[JANUARY] * 120, files=12)
    extra = chain.spec(1, FEBRUARY)
    chain.spark.read.parquet(extra.path).write.mode("append").parquet(spec.path)
    lake.load(store, trips=spec, zones=chain.zones, batch_id="b", ingested_at=ARRIVAL)
    part, rows = store.current().of("silver")["tlc-2024-01"], _silver(chain)
    january, february = "row_set=valid/row_month=m2024-01", "row_set=valid/row_month=m2024-02"
    sizes = sizes_below(chain.spark, store.full(part.path))
    target = -(-sum(sizes[january]) // 3)
    assert len(sizes[january]) > 6 and len(sizes[february]) == 1
    assert lake.compact_silver(store, file_bytes=target) == ("tlc-2024-01",)
    new = store.current().of("silver")["tlc-2024-01"]
    assert {d: len(f) for d, f in sizes_below(chain.spark, store.full(new.path)).items()} == {january: 3, february: 1}
    counts = [r["n"] for r in chain.spark.read.parquet(f"{store.full(new.path)}/{january}").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sum(counts) == 120 and max(counts) - min(counts) <= 12
    assert _silver(chain) == rows


def test_a_load_during_compaction_wins(chain, monkeypatch):
    store, real = chain.store, lake._regrouped
    lake.load(store, trips=_spread(chain, 1, *[JANUARY] * 12), zones=chain.zones, batch_id="b", ingested_at=ARRIVAL)

    def slow(*args, **options):
        monkeypatch.setattr(lake, "_regrouped", real)
        lake.load(store, trips=chain.spec(1, JANUARY, BAD), zones=chain.zones, batch_id="b2", ingested_at=ARRIVAL)
        return real(*args, **options)

    monkeypatch.setattr(lake, "_regrouped", slow)
    assert lake.compact_silver(store) == ()
    assert sum(_silver(chain).values()) == 2


def test_compaction_of_an_empty_store_and_of_an_empty_unit(chain):
    assert lake.compact_silver(chain.store) == ()
    lake.load(chain.store, trips=chain.spec(1, BAD), zones=chain.zones, batch_id="b", ingested_at=ARRIVAL)
    assert lake.compact_silver(chain.store) == ()
    with pytest.raises(ValueError, match="at least a byte"):
        lake.compact_silver(chain.store, file_bytes=0)


def test_compaction_shuffles_nothing_and_reads_a_file_s_share_in_a_task(chain, one_task_a_file, monkeypatch):
    """A task reads the parquet files that become one, not their rows out of a shuffle; also where that takes several writes."""
    store, plans, real = chain.store, [], lake._regrouped
    lake.load(store, trips=_spread(chain, 1, *[JANUARY] * 120, *[FEBRUARY] * 30, files=15), zones=chain.zones, batch_id="b", ingested_at=ARRIVAL)
    part, rows = store.current().of("silver")["tlc-2024-01"], _silver(chain)
    sizes = sizes_below(chain.spark, store.full(part.path))
    target = -(-sum(sizes["row_set=valid/row_month=m2024-01"]) // 3)

    def watched(*args):
        for frame in real(*args):
            plans.append(frame._jdf.queryExecution().executedPlan().toString())
            yield frame

    monkeypatch.setattr(lake, "_regrouped", watched)
    monkeypatch.setattr(lake, "FILES_AT_ONCE", 2)
    assert lake.compact_silver(store, file_bytes=target) == ("tlc-2024-01",)
    assert len(plans) > 1 and not any("Exchange" in plan for plan in plans)
    assert _silver(chain) == rows


def test_files_are_dealt_by_size():
    dealt = lake._dealt({"a": 10, "b": 1, "c": 1, "d": 7}, 2)
    assert sorted(map(sorted, dealt)) == [["a"], ["b", "c", "d"]]
    assert lake._dealt({"a": 1}, 3) == [["a"]]
