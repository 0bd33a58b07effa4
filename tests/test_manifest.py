"""Bucketed tables: what a batch rewrites, what readers open."""

from pyspark.sql import functions as F

from strata.functions.fingerprint import add_fingerprint
from strata.plans import jobs
from strata.rules import CollectionSpec
from strata.session import scratch_path
from strata.sources import manifest, publish

SPEC = CollectionSpec("things", "id", "updated_at", 2, buckets=8)
DAYS = [(f"2024-0{m}-01", f"2024-0{m}-01 06:00:00") for m in range(1, 7)]


def batch(spark, rows, extra=None):
    df = spark.createDataFrame(rows, "id string, name string")
    return add_fingerprint(df if extra is None else df.withColumn("extra", extra))


def merged(spark, lake, rows, day, spec=SPEC, extra=None):
    return jobs.merge_batch(spark, lake, spec, batch(spark, rows, extra), *day)


def state(df):
    return sorted((r.id, r.name, r.version_number, r.is_current) for r in df.collect())


def test_a_batch_of_one_key_rewrites_one_bucket(spark):
    lake = jobs.Lake(scratch_path(spark, "one-key"))
    root = lake.silver("things")
    merged(spark, lake, [(str(i), "a") for i in range(100)], DAYS[0])
    before = manifest.newest(spark, root)
    assert len(before.current) == 8
    written = merged(spark, lake, [("7", "b")], DAYS[1])
    after = manifest.newest(spark, root)
    moved = {f.bucket for f in set(after.current) - set(before.current)}
    assert len(after.current) == 8 and len(moved) == 1
    assert written["closed"] == 1 and written["current"] < 30
    assert publish.read_scd2_current(spark, root).where("is_current").count() == 100
    full = [r for r in state(publish.read_scd2_full(spark, root)) if r[0] == "7"]
    assert full == [("7", "a", 1, False), ("7", "b", 2, True)]
    # only the data folder of the touched bucket is read by a merge
    scan = manifest.read(spark, root, [f for f in after.current if f.bucket in moved])
    assert len(scan.inputFiles()) < len(publish.read_scd2_current(spark, root).inputFiles())


def test_buckets_do_not_change_the_table(spark):
    loads = [
        [(str(i), "a") for i in range(40)],
        [(str(i), "b") for i in range(30, 50)],
        [(str(i), "b") for i in range(30, 50)] + [("3", "c"), (None, "lost")],
        [],
    ]
    states = []
    for buckets in (1, 3, 16):
        lake = jobs.Lake(scratch_path(spark, f"same-{buckets}"))
        spec = CollectionSpec("things", "id", "updated_at", 2, buckets=buckets)
        for rows, day in zip(loads, DAYS):
            merged(spark, lake, rows, day, spec)
        states.append(state(publish.read_scd2_full(spark, lake.silver("things"))))
    assert states[0] == states[1] == states[2] and len(states[0]) == 50 + 11


def test_scd1_rewrites_touched_buckets_only(spark):
    lake = jobs.Lake(scratch_path(spark, "scd1"))
    spec = CollectionSpec("things", "id", "updated_at", 1, buckets=8)
    merged(spark, lake, [(str(i), "a") for i in range(100)], DAYS[0], spec)
    before = manifest.newest(spark, lake.silver("things"))
    merged(spark, lake, [("7", "b"), ("new", "n")], DAYS[1], spec)
    after = manifest.newest(spark, lake.silver("things"))
    assert 1 <= len(set(after.current) - set(before.current)) <= 2
    rows = {r.id: r.name for r in publish.read_snapshot(spark, lake.silver("things")).collect()}
    assert len(rows) == 101 and rows["7"] == "b" and rows["8"] == "a"


def test_late_rows_are_kept_apart_in_the_same_write(spark):
    lake = jobs.Lake(scratch_path(spark, "late"))
    root = lake.silver("things")
    merged(spark, lake, [("1", "a"), ("2", "b")], DAYS[2])
    written = merged(spark, lake, [("1", "too late"), ("2", "b"), ("3", "new")], DAYS[1])
    assert written == {"current": 3, "closed": 0, "late": 1}
    assert [(r.id, r.name, r.load_date, r.version_number) for r in publish.read_late(spark, root).collect()] == [
        ("1", "too late", DAYS[1][0], None)
    ]
    assert state(publish.read_scd2_full(spark, root)) == [("1", "a", 1, True), ("2", "b", 1, True), ("3", "new", 1, True)]


def test_a_merge_scans_the_current_rows_once(spark):
    from strata.operators.scd import scd2_merge_tagged

    lake = jobs.Lake(scratch_path(spark, "scan"))
    merged(spark, lake, [("1", "a"), ("2", "b")], DAYS[0])
    current = publish.read_scd2_current(spark, lake.silver("things"))
    plan = scd2_merge_tagged(current, batch(spark, [("1", "c")]), "id", *DAYS[1])._jdf.queryExecution()
    assert plan.executedPlan().toString().count("FileScan parquet") == 1
    assert plan.optimizedPlan().toString().count("Join") == 1
    # the uniqueness check adds no exchange of its own to the batch's side
    assert plan.executedPlan().toString().count("Exchange hashpartitioning") == 2


def test_columns_added_to_some_buckets(spark):
    lake = jobs.Lake(scratch_path(spark, "drifted"))
    root = lake.silver("things")
    merged(spark, lake, [(str(i), "a") for i in range(50)], DAYS[0])
    merged(spark, lake, [("7", "b")], DAYS[1], extra=F.lit(5))
    merged(spark, lake, [("8", "b")], DAYS[2], extra=F.lit(6))  # another bucket: no drift any more
    current = publish.read_scd2_current(spark, root)
    assert {r.id: r.extra for r in current.where("extra is not null").collect()} == {"7": 5, "8": 6}
    assert current.count() == 50
    drift = spark.read.parquet(lake.drift).collect()
    assert [(r.change_type, r.column_name, r.resolved) for r in drift] == [("ADD_COLUMN", "extra", True)]
    assert drift[0].notes == "added; earlier rows NULL" and drift[0].resolved_at is not None


def test_as_of_reads_open_the_folders_of_their_time(spark, monkeypatch):
    lake = jobs.Lake(scratch_path(spark, "as-of"))
    root = lake.silver("things")
    for n, day in enumerate(DAYS):
        merged(spark, lake, [(str(i), f"v{n}") for i in range(20)], day)
    everything = publish.read_scd2_full(spark, root)
    jobs_before = _jobs_started(spark)
    early = publish.read_scd2_as_of(spark, root, "2024-01-15 00:00:00")
    # the manifest is read; no job opens a data file to learn its columns
    assert _jobs_started(spark) - jobs_before <= 6
    assert {r.name for r in early.collect()} == {"v0"} and early.count() == 20
    late = publish.read_scd2_as_of(spark, root, "2024-06-15 00:00:00")
    assert {r.name for r in late.collect()} == {"v5"}
    opened = [len(x.inputFiles()) for x in (early, late, everything)]
    assert opened[1] < opened[0] < opened[2]
    assert publish.read_scd2_as_of(spark, root, "2023-01-01 00:00:00").count() == 0


def _jobs_started(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


def test_empty_first_load_keeps_its_columns(spark):
    for buckets in (1, 4):
        lake = jobs.Lake(scratch_path(spark, "empty"))
        spec = CollectionSpec("things", "id", "updated_at", 2, buckets=buckets)
        merged(spark, lake, [], DAYS[0], spec)
        assert publish.read_snapshot(spark, lake.silver("things")).count() == 0
        merged(spark, lake, [("1", "a")], DAYS[1], spec)
        assert state(publish.read_scd2_full(spark, lake.silver("things"))) == [("1", "a", 1, True)]
