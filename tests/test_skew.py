"""Hot-key paths give the same rows as the plain plans."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare, duck
from strata.operators.scd2 import build_scd2
from strata.operators.skew import skew_left_join
from strata.plans.catalogue import events_bronze, read


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_skew_left_join_matches_plain_join(spark):
    orders = read(spark, SF_SMALL, "orders").select("o_orderkey", "o_custkey")
    items = read(spark, SF_SMALL, "lineitem").select(
        # a third of the lines move to one order: a hot right-side key
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")).alias("l_orderkey"),
        "l_linenumber", "l_partkey",
    )
    plain = orders.join(items, orders["o_orderkey"] == items["l_orderkey"], "left")
    salted = skew_left_join(orders, items, [("o_orderkey", "l_orderkey")], rows_per_task=50)
    assert sorted(salted.columns) == sorted(plain.columns)
    assert _same(salted.select(*plain.columns), plain)
    # NULL keys on either side never match
    with_nulls = orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_orderkey")))
    plain = with_nulls.join(items, with_nulls["o_orderkey"] == items["l_orderkey"], "left")
    salted = skew_left_join(with_nulls, items, [("o_orderkey", "l_orderkey")], rows_per_task=50)
    assert _same(salted.select(*plain.columns), plain)


def test_serving_query_with_forced_salting(spark):
    spark.conf.set("strata.join.rowsPerTask", "40")
    try:
        df = entry.queries()["serving_order_fulfilment"](spark, SF_SMALL)
        ok, msg = compare(df, duck(SF_SMALL), entry.oracle_sql()["serving_order_fulfilment"])
    finally:
        spark.conf.unset("strata.join.rowsPerTask")
    assert ok, msg


def test_scd2_copies_are_split(spark):
    """A third of the rows are exact copies of one row: still exact, and the
    copies land in several buckets."""
    bronze = events_bronze(spark, SF_SMALL)
    copy = bronze.orderBy("event_id").limit(1)
    n = bronze.count() // 2
    copies = copy.withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_c")
    skewed = bronze.unionByName(copies)
    ref_h, _ = build_scd2(skewed, ["user_id"], "ts", rows_per_bucket=10**9)
    hot_h, _ = build_scd2(skewed, ["user_id"], "ts", rows_per_bucket=40)
    cols = ["event_id", "user_id", "effective_from", "effective_to", "is_current"]
    assert _same(hot_h.select(*cols), ref_h.select(*cols))
    assert hot_h.where("is_current").groupBy("user_id").count().where("count > 1").count() == 0


def test_fold_with_buckets_subbuckets_and_hot_keys(spark, monkeypatch):
    """Storage buckets, window sub-buckets and hot-key ranges all at once
    still give the oracle's history."""
    import strata.plans.runs as runs

    monkeypatch.setattr(runs, "ROWS_PER_SILVER_BUCKET", 60)
    monkeypatch.setattr(runs, "ROWS_PER_WINDOW_GROUP", 30)
    spark.conf.set("strata.scd2.rowsPerBucket", "3")
    try:
        for name in ("fold_incremental", "replay_entity_rebuild"):
            df = entry.queries()[name](spark, SF_SMALL)
            ok, msg = compare(df, duck(SF_SMALL), entry.oracle_sql()[name])
            assert ok, f"{name}: {msg}"
    finally:
        spark.conf.unset("strata.scd2.rowsPerBucket")


def test_composite_key_hot_path(spark):
    spark.conf.set("strata.scd2.rowsPerBucket", "2")
    try:
        df = entry.queries()["scd2_composite_key"](spark, SF_SMALL)
        ok, msg = compare(df, duck(SF_SMALL), entry.oracle_sql()["scd2_composite_key"])
    finally:
        spark.conf.unset("strata.scd2.rowsPerBucket")
    assert ok, msg


def test_hot_paths_without_broadcast(spark, monkeypatch):
    """Above the broadcast bounds the hot-key tables are joined without a
    broadcast hint; results are unchanged."""
    import strata.operators.scd2 as scd2
    import strata.operators.skew as skew

    monkeypatch.setattr(scd2, "MAX_BROADCAST_BUCKETS", 0)
    monkeypatch.setattr(skew, "MAX_HOT_KEYS", 0)
    for name in ("scd2_hot_split", "skew_join_salted"):
        df = entry.queries()[name](spark, SF_SMALL)
        ok, msg = compare(df, duck(SF_SMALL), entry.oracle_sql()[name])
        assert ok, f"{name}: {msg}"
