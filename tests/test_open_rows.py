"""The open-row index: what a fold reads and rewrites, and late keys."""

import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strata.operators.open_rows import late_buckets, order_number
from strata.plans import runs
from strata.plans.replay import rebuild_keys, run_replay
from strata.plans.runs import bucket_of, run_source, segment_of
from test_runs import make, stage, ts

START = datetime(2026, 1, 1)


def batch(day, keys, minute=0, flag="n"):
    return [(k, "g", f"d{day}", flag, START + timedelta(days=day, minutes=minute)) for k in keys]


def history(store):
    return sorted(tuple(str(v) for v in r) for r in store.read("demo.silver.src_history").drop("bronze_load_ts").collect())


def current(store):
    return sorted(tuple(str(v) for v in r) for r in store.read("demo.silver.src_current").drop("bronze_load_ts").collect())


def run_days(spark, batches, mode, buckets=16):
    store, control = make(spark, load_mode="FULL", options_json='{"fold_mode": "%s", "silver_buckets": %d}' % (mode, buckets))
    heads = []
    for day, rows in enumerate(batches):
        stage(spark, store, rows)
        run_source(spark, control, "src", as_of=str(START + timedelta(days=day, hours=12)))
        heads.append(store.head("demo.silver.src_history"))
    return store, control, heads


def test_closed_folders_are_only_added(spark):
    """16 buckets, every key in every batch: no closed folder is ever replaced."""
    batches = [batch(day, range(150)) for day in range(4)]
    store, _, heads = run_days(spark, batches, "incremental")
    for before, after in zip(heads, heads[1:]):
        assert {p for p in before.parts if segment_of(p) == "closed"} <= set(after.parts)
    assert {bucket_of(p) for p in heads[-1].parts} == set(range(16))
    full, _, _ = run_days(spark, batches, "full")
    assert history(store) == history(full) and current(store) == current(full)
    # the current table is the live part of the history, shared
    assert set(store.head("demo.silver.src_current").parts) == {p for p in heads[-1].parts if segment_of(p) == "live"}
    assert store.head("demo.silver.src_history").row_count == 600


def test_a_batch_of_few_keys_carries_all_other_folders(spark):
    store, _, heads = run_days(spark, [batch(0, range(60)), batch(1, range(60)), batch(2, [7])], "incremental")
    before, after = heads[1], heads[2]
    touched = {bucket_of(p) for p in set(after.parts) - set(before.parts)}
    assert len(touched) == 1
    assert {p for p in before.parts if bucket_of(p) not in touched} <= set(after.parts)
    assert store.read("demo.silver.src_current").count() == 60


@pytest.mark.parametrize("buckets", [1, 4])
def test_late_keys_take_the_whole_bucket(spark, buckets):
    """Late rows, NULL ordering values, deleted and returning keys, ties."""
    batches = [
        batch(2, range(12)) + [(50, "g", "null", "n", None)],
        batch(3, [1, 2], flag="Y") + batch(1, [3]),  # 3 is late
        batch(4, [1, 5]) + batch(4, [5], flag="Y") + [(6, "g", "null", "n", None)],
        batch(5, [6, 50, None]) + batch(4, [5]) + batch(0, [2]),
        batch(6, [1, 2, 3, 5, 6, 50, None]),
    ]
    a, _, _ = run_days(spark, batches, "incremental", buckets)
    b, _, _ = run_days(spark, batches, "full", buckets)
    assert history(a) == history(b) and current(a) == current(b)


def test_without_recorded_order_the_rows_decide(spark, monkeypatch):
    monkeypatch.setattr(runs, "_only_later", lambda *a: False)
    batches = [batch(0, range(20)), batch(1, range(10)), batch(0, [3], minute=5) + batch(2, [4, 30])]
    store, _, heads = run_days(spark, batches, "incremental", 8)
    kept = {bucket_of(p) for p in heads[1].parts if segment_of(p) == "closed" and p in heads[2].parts}
    lost = {bucket_of(p) for p in heads[1].parts if segment_of(p) == "closed" and p not in heads[2].parts}
    assert len(lost) == 1 and kept and not kept & lost  # only the bucket of key 3
    full, _, _ = run_days(spark, batches, "full", 8)
    assert history(store) == history(full) and current(store) == current(full)


def test_many_closed_folders_become_one(spark, monkeypatch):
    monkeypatch.setattr(runs, "CLOSED_PARTS", 2)
    store, _, heads = run_days(spark, [batch(day, range(6)) for day in range(6)], "incremental", 1)
    assert max(sum(segment_of(p) == "closed" for p in h.parts) for h in heads) == 2
    assert store.read("demo.silver.src_history").count() == 36


def test_late_buckets_by_row(spark):
    def rows(values, current=True):
        df = spark.createDataFrame([(k, t and ts(t)) for k, t in values], "k long, o timestamp")
        return df.select("k", "o", F.lit(ts("2026-01-01 00:00:00") if current else ts("2026-02-01 00:00:00")).alias("bronze_load_ts"),
                         F.lit(True).alias("is_current"))

    old = rows([(1, "2026-01-01 10:00:00"), (2, "2026-01-01 10:00:00"), (3, None), (4, "2026-01-01 10:00:00"), (None, "2026-01-05 00:00:00")])
    new = rows([(1, "2026-01-02 00:00:00"), (2, "2025-12-31 00:00:00"), (3, "2026-01-02 00:00:00"), (4, "2026-01-01 10:00:00"), (5, None),
                (None, "2026-01-04 00:00:00")], current=False)
    found = late_buckets(old, new, ["k"], "o", F.coalesce("k", F.lit(-1))).collect()
    assert {r[0] for r in found} == {2, 3, -1}  # 4 ties on the ordering value and was loaded later


def test_order_number_sorts_like_the_value(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select explode(array('1969-12-31 23:59:59.999999', '2024-03-10 02:30:00', '2024-11-03 01:30:00.000001', '2024-11-03 01:30:00.000002')) t")
        df = df.select(F.col("t").cast("timestamp_ntz").alias("a"), F.col("t").cast("date").alias("b"))
        for name in ("a", "b"):
            got = [r[0] for r in df.select(order_number(name, df.schema[name].dataType)).collect()]
            assert got == sorted(got) and (name == "b" or len(set(got)) == 4)
        assert order_number("t", spark.sql("select 'x' t").schema["t"].dataType) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_replay_reads_only_folders_that_can_hold_its_keys(spark, monkeypatch):
    store, control, _ = run_days(spark, [batch(0, range(40)), batch(1, [100, 101]), batch(2, [7, 102])], "incremental", 4)
    seen = []
    monkeypatch.setattr("strata.plans.replay.fold_silver", lambda store, cfg, scope, **kw: seen.append(scope) or None)
    control.submit_replay(1, "src", "ENTITY", entity_predicate="id = 7")
    rebuild_keys(spark, control, control.get_registration("src"), control.get_replay_request(1))
    files = {f.rsplit("/", 1)[0].split("/data/")[1] for f in seen[0].inputFiles() if "/bronze/" in f}
    parts = store.head("demo.bronze.src").parts
    assert files == {p.split("/data/")[1] for p in (parts[0], parts[2])}
    assert seen[0].count() == 2


def test_file_count_stays_flat_over_ten_replays(spark):
    store, control, _ = run_days(spark, [batch(0, range(40)), batch(1, range(40))], "incremental", 4)
    before, rows = None, history(store)
    for n in range(10):
        control.submit_replay(n, "src", "ENTITY", entity_predicate=f"id IN ({n}, {n + 11}, {n + 23})")
        run_replay(spark, control, n)
        files = len(store.read("demo.silver.src_history").inputFiles()) + len(store.read("demo.silver.src_current").inputFiles())
        before = before or files
        assert files <= before + 4
    assert history(store) == rows


def test_a_replay_writes_a_bucket_in_pieces(spark, monkeypatch):
    """No task holds a whole bucket (nor a whole key) when a replay writes it again."""
    monkeypatch.setattr(runs, "ROWS_PER_WINDOW_GROUP", 20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store, control, _ = run_days(spark, [batch(day, range(40)) for day in range(3)], "incremental", 1)
        before = history(store), current(store)
        control.submit_replay(1, "src", "ENTITY", entity_predicate="id = 7")
        run_replay(spark, control, 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (history(store), current(store)) == before
    for name, rows in (("demo.silver.src_history", 120), ("demo.silver.src_current", 40)):
        sizes = [r["count"] for r in store.read(name).groupBy(F.input_file_name()).count().collect()]
        assert sum(sizes) == rows and max(sizes) < rows * 0.5
