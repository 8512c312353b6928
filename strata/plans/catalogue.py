"""Registered queries: every operator of the inventory applied to the provided
tables, each paired with an independent SQL statement computing the same
result (checked by DuckDB).

Data mapping:

* ``events`` is an incremental change log keyed by ``user_id`` and ordered by
  ``ts``, landed as two batches (rows up to 2024-01-15, then the rest up to
  the second run's instant);
* ``part`` is a full snapshot landed twice, with a price change for some parts;
* ``orders`` is ordered by a sequence column (``o_orderkey``) per ``o_custkey``;
* orders/customer/lineitem/part/supplier form the serving star;
* ``pages`` feeds the page conversion job.

Queries that write tables do so in a fresh folder of the session's
warehouse (never a machine-local temp folder) and return a lazy read of the
written version.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.config import SourceRegistration
from strata.functions.hashing import record_hash_col
from strata.functions.options import json_field
from strata.functions.watermark import mark_literal, mark_text_col
from strata.operators.bronze import enrich_bronze
from strata.operators.merge import keyed_update, upsert
from strata.operators.pages import extract_pages, palette_manifest, render_pages
from strata.operators.quality import required_columns_rule, row_count_rule
from strata.operators.scd2 import build_scd2
from strata.operators.scope import (
    entity_filter,
    impacted_keys,
    rewrite_impacted,
    rows_for_keys,
    rows_without_keys,
    union_evolving,
)
from strata.operators.serving import Side, greatest_of, left_join_chain
from strata.operators.skew import skew_left_join
from strata.plans.control import ControlPlane, next_id, normalize_registrations, status_assignments
from strata.plans.metrics import run_counts
from strata.plans.replay import run_replay
from strata.plans.demo import build_serving
from strata.plans.runs import run_all_sources, run_source, write_buckets
from strata.session import warehouse_root
from strata.sources.extract import date_range_predicate, extract_window, high_water_mark, source_frame
from strata.sources.tables import TableStore

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Scenario constants (batch cut-offs, load instants, replay windows).
BATCH1_END = "2024-01-15 00:00:00"
BATCH1_LOAD = "2024-01-15 01:00:00"
BATCH2_END = "2200-01-01 00:00:00"
BATCH2_LOAD = "2200-01-01 00:00:00"
RANGE_START = "2024-01-29 00:00:00"
RANGE_END = "2024-01-29 06:00:00"
ENTITY_PREDICATE = "user_id IN (3, 7, 11) OR value > 200"
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]
BRONZE_VIEW_COLUMNS = [*EVENT_COLUMNS, "pipeline_batch_id", "bronze_load_ts"]
HISTORY_VIEW_COLUMNS = [*EVENT_COLUMNS, "effective_from", "effective_to", "is_current", "pipeline_batch_id", "bronze_load_ts"]
PAGE_TEMPLATE = (
    '<title>%%TITLE%%</title><i fill="%%ACCENT_ENC%%"/>'
    "<style>a{color:%%ACCENT%%;border:%%ACCENT2%%}</style><a href=\"%%SLUG%%.html\">"
)


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the provided tables as temporary views (for SQL-defined sources)."""
    for name in names:
        read(spark, sf_dir, name).createOrReplaceTempView(name)


def scratch_store(spark: SparkSession) -> TableStore:
    """A fresh table root below the session's warehouse."""
    return TableStore(spark, f"{warehouse_root(spark)}/q_{uuid.uuid4().hex[:16]}")


def events_registration(**extra) -> SourceRegistration:
    base = dict(
        source_name="events", bronze_table="demo.bronze.events", source_object="events_src",
        load_mode="INCREMENTAL_TS", watermark_column="ts", watermark_type="TIMESTAMP", primary_keys=["user_id"],
        silver_current_table="demo.silver.events_current", silver_history_table="demo.silver.events_history",
        gold_table="demo.gold.events",
    )
    base.update(extra)
    return SourceRegistration(**base)


def events_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` landed as two incremental batches."""
    src = read(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    reg = events_registration()
    b1 = enrich_bronze(extract_window(src, reg, None, BATCH1_END), "events", 1, reg.load_mode, ntz(BATCH1_LOAD))
    b2 = enrich_bronze(extract_window(src, reg, BATCH1_END, BATCH2_END), "events", 2, reg.load_mode, ntz(BATCH2_LOAD))
    return b1.unionByName(b2)


def events_history(spark: SparkSession, sf_dir: str, **kw) -> tuple[DataFrame, DataFrame]:
    return build_scd2(events_bronze(spark, sf_dir), ["user_id"], "ts", **kw)


def _range_keys(bronze: DataFrame) -> DataFrame:
    pred = date_range_predicate(bronze, "ts", RANGE_START, RANGE_END, "TIMESTAMP")
    return impacted_keys(bronze.where(pred), ["user_id"])


def _entity_keys(bronze: DataFrame) -> DataFrame:
    return impacted_keys(entity_filter(bronze, ENTITY_PREDICATE), ["user_id"])


# ----------------------------------------------------------------- sources
def q_src_table(spark, d):
    register_views(spark, d, ["customer"])
    reg = SourceRegistration(source_name="customer", bronze_table="b", source_object="customer")
    return source_frame(spark, reg).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def q_src_sql(spark, d):
    register_views(spark, d, ["orders", "customer"])
    reg = SourceRegistration(
        source_name="orders", bronze_table="b",
        base_extract_sql=(
            "SELECT o.o_orderkey, o.o_totalprice, c.c_mktsegment FROM orders o "
            "JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderstatus = 'F'"
        ),
    )
    return source_frame(spark, reg)


def q_src_union_all(spark, d):
    register_views(spark, d, ["nation", "region"])
    reg = SourceRegistration(
        source_name="geo", bronze_table="b",
        base_extract_sql="SELECT n_nationkey AS k, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region",
    )
    return source_frame(spark, reg)


def _events_cols(spark, d):
    return read(spark, d, "events").select("event_id", "ts", "user_id")


def q_extract_full(spark, d):
    return extract_window(_events_cols(spark, d), events_registration(load_mode="FULL"), BATCH1_END, "2024-01-20 00:00:00")


def q_extract_first_run(spark, d):
    return extract_window(_events_cols(spark, d), events_registration(), None, "2024-01-20 00:00:00")


def q_extract_incremental(spark, d):
    return extract_window(_events_cols(spark, d), events_registration(), "2024-01-10 00:00:00", "2024-01-20 00:00:00")


def q_extract_sequence(spark, d):
    """Incremental extract ordered by a numeric sequence column: lower bound
    from the stored mark, no wall-clock upper bound."""
    reg = SourceRegistration(source_name="orders", bronze_table="b", load_mode="CDC", sequence_column="o_orderkey",
                             watermark_type="BIGINT", primary_keys=["o_custkey"])
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return extract_window(orders, reg, "7000", "2024-01-20 00:00:00")


def q_high_water_mark(spark, d):
    return high_water_mark(read(spark, d, "events"), "ts")


def q_watermark_text(spark, d):
    ev = read(spark, d, "events")
    return ev.select(
        "event_id",
        mark_text_col(F.col("ts")).alias("mark_ts"),
        mark_text_col(F.col("ts").cast("date")).alias("mark_date"),
        mark_text_col(F.col("event_id")).alias("mark_seq"),
    )


def q_watermark_cast(spark, d):
    ev = read(spark, d, "events")
    types = {f.name: f.dataType for f in ev.schema.fields}
    cond = (
        (F.col("event_id") > mark_literal("500", "BIGINT", types["event_id"]))
        & (F.col("ts") > mark_literal("2024-01-10 00:00:00", "TIMESTAMP", types["ts"]))
        & (F.col("ts") > mark_literal("2024-01-05", "DATE", types["ts"]))
    )
    return ev.where(cond).select("event_id")


def q_next_batch_id(spark, d):
    return next_id(read(spark, d, "orders"), "o_orderkey")


def q_record_hash(spark, d):
    cust = read(spark, d, "customer")
    return cust.select("c_custkey", record_hash_col(["c_custkey", "c_name", "c_nationkey"]).alias("record_hash"))


def q_bronze_enrich(spark, d):
    cust = read(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    return enrich_bronze(cust, "customer", 1001, "FULL", ntz("2024-02-01 00:00:00"))


# -------------------------------------------------------------------- SCD2
def q_latest_per_key(spark, d):
    hist, _ = events_history(spark, d)
    return hist.where("is_current").select("user_id", "event_id", "ts")


def q_effective_ranges(spark, d):
    hist, _ = events_history(spark, d)
    return hist.select("user_id", "effective_from", "effective_to")


def q_scd2_history(spark, d):
    hist, _ = events_history(spark, d)
    return hist.select(*HISTORY_VIEW_COLUMNS)


def q_scd2_current(spark, d):
    _, cur = events_history(spark, d)
    return cur.select(*HISTORY_VIEW_COLUMNS)


def q_scd2_current_cdc(spark, d):
    flag = (
        F.when(F.col("event_type") == "error", F.lit("y"))
        .when(F.col("event_type") == "view", F.lit(None).cast("string"))
        .otherwise(F.lit("n"))
    )
    bronze = events_bronze(spark, d).withColumn("del_flag", flag)
    _, cur = build_scd2(bronze, ["user_id"], "ts", delete_column="del_flag")
    return cur.select(*HISTORY_VIEW_COLUMNS, "del_flag")


def q_scd2_current_null_live(spark, d):
    """Soft deletes with NULL flags treated as live rows (option ``null_flag_is_live``)."""
    flag = (
        F.when(F.col("event_type") == "error", F.lit("YES"))
        .when(F.col("event_type") == "view", F.lit(None).cast("string"))
        .otherwise(F.lit("no"))
    )
    bronze = events_bronze(spark, d).withColumn("del_flag", flag)
    _, cur = build_scd2(bronze, ["user_id"], "ts", delete_column="del_flag", null_flag_is_live=True)
    return cur.select(*HISTORY_VIEW_COLUMNS, "del_flag")


def q_scd2_hot_split(spark, d):
    """SCD2 with a bucket size of 20 rows: every user is a hot key, split into
    range buckets and stitched back (the plan a key holding a large share of
    the rows gets at scale)."""
    hist, _ = build_scd2(events_bronze(spark, d), ["user_id"], "ts", rows_per_bucket=20)
    return hist.select(*HISTORY_VIEW_COLUMNS)


def q_scd2_sequence(spark, d):
    orders = read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    bronze = enrich_bronze(orders, "orders", 1, "FULL", ntz("2024-02-01 00:00:00"))
    hist, _ = build_scd2(bronze, ["o_custkey"], "o_orderkey")
    return hist.select("o_custkey", "o_orderkey", "o_orderstatus", "effective_from", "effective_to", "is_current")


def q_scd2_composite_key(spark, d):
    """Composite business key (customer, priority), sequence column o_orderkey."""
    orders = read(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")
    bronze = enrich_bronze(orders, "orders", 1, "FULL", ntz("2024-02-01 00:00:00"))
    hist, cur = build_scd2(bronze, ["o_custkey", "o_orderpriority"], "o_orderkey")
    return hist.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice", "effective_from", "effective_to",
                       "is_current")


def part_snapshots(spark, d) -> DataFrame:
    part = read(spark, d, "part")
    changed = F.col("p_partkey") % 10 == 0
    snap1 = part.select("p_partkey", "p_name", "p_retailprice", ntz("2024-01-01 00:00:00").alias("chg_ts"))
    snap2 = part.select(
        "p_partkey", "p_name",
        F.when(changed, F.col("p_retailprice") * 2).otherwise(F.col("p_retailprice")).alias("p_retailprice"),
        F.when(changed, ntz("2024-01-02 00:00:00")).otherwise(ntz("2024-01-01 00:00:00")).alias("chg_ts"),
    )
    return enrich_bronze(snap1, "part", 1, "FULL", ntz("2024-01-01 01:00:00")).unionByName(
        enrich_bronze(snap2, "part", 2, "FULL", ntz("2024-01-02 01:00:00"))
    )


def q_scd2_full_snapshots(spark, d):
    hist, _ = build_scd2(part_snapshots(spark, d), ["p_partkey"], "chg_ts")
    return hist.select(
        "p_partkey", "p_name", "p_retailprice", "effective_from", "effective_to", "is_current",
        "pipeline_batch_id", "bronze_load_ts",
    )


def q_gold_snapshot(spark, d):
    store = scratch_store(spark)
    _, cur = events_history(spark, d)
    store.replace("demo.silver.events_current", cur)
    store.share("demo.silver.events_current", "demo.gold.events")
    return store.read("demo.gold.events").select(*HISTORY_VIEW_COLUMNS)


# ------------------------------------------------------------------- scope
def q_impacted_keys(spark, d):
    return _range_keys(events_bronze(spark, d))


def q_anti_remaining(spark, d):
    bronze = events_bronze(spark, d)
    hist, _ = build_scd2(bronze, ["user_id"], "ts")
    return rows_without_keys(hist, _range_keys(bronze), ["user_id"]).select(*HISTORY_VIEW_COLUMNS)


def q_replay_date_range_scope(spark, d):
    bronze = events_bronze(spark, d)
    return rows_for_keys(bronze, _range_keys(bronze), ["user_id"]).select(*BRONZE_VIEW_COLUMNS)


def q_replay_entity_scope(spark, d):
    bronze = events_bronze(spark, d)
    return rows_for_keys(bronze, _entity_keys(bronze), ["user_id"]).select(*BRONZE_VIEW_COLUMNS)


def q_rewrite_impacted(spark, d):
    cols = ["event_id", "user_id", "effective_from", "effective_to"]
    bronze = events_bronze(spark, d)
    old, _ = build_scd2(bronze.where(F.col("pipeline_batch_id") == 1), ["user_id"], "ts")
    keys = impacted_keys(bronze.where((F.col("pipeline_batch_id") == 2) & (F.col("value") > 190)), ["user_id"])
    rebuilt, _ = build_scd2(rows_for_keys(bronze, keys, ["user_id"]), ["user_id"], "ts")
    return rewrite_impacted(old.select(*cols), rebuilt.select(*cols), keys, ["user_id"])


def q_union_by_name_evolve(spark, d):
    cust = read(spark, d, "customer")
    building = F.col("c_mktsegment") == "BUILDING"
    old = cust.where(building).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    new = cust.where(~building | F.col("c_mktsegment").isNull()).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("extra")
    )
    return union_evolving(old, new)


# ------------------------------------------------- runs, replays, restores
def _events_row(options_json: str) -> dict:
    reg = events_registration()
    return {
        "source_name": reg.source_name, "source_type": "TABLE", "source_object": reg.source_object,
        "enabled": True, "load_mode": reg.load_mode, "watermark_column": "ts", "watermark_type": "TIMESTAMP",
        "primary_keys": ["user_id"], "bronze_table": reg.bronze_table,
        "silver_current_table": reg.silver_current_table, "silver_history_table": reg.silver_history_table,
        "gold_table": reg.gold_table, "silver_transform_name": "scd2_current_history",
        "gold_publish_name": "publish_current_snapshot",
        "options_json": options_json,
    }


def _events_control(spark, d, options_json: str = '{"required_columns": ["event_id", "ts", "user_id"]}') -> ControlPlane:
    """A fresh catalog with the events source registered (not yet run)."""
    store = scratch_store(spark)
    read(spark, d, "events").select(*EVENT_COLUMNS).createOrReplaceTempView("events_src")
    control = ControlPlane(store)
    control.bootstrap()
    control.register([_events_row(options_json)])
    return control


def _two_runs(spark, d) -> tuple[ControlPlane, int]:
    control = _events_control(spark, d)
    run_source(spark, control, "events", forced_batch_id=1, as_of=BATCH1_END)
    after_first = control.store.head("demo.silver.events_current").version
    run_source(spark, control, "events", forced_batch_id=2, as_of=BATCH2_END)
    return control, after_first


def _history_view(control: ControlPlane) -> DataFrame:
    hist = control.store.read("demo.silver.events_history")
    # load instants are session-zone timestamps; their wall-clock text is zone-free
    return hist.withColumn("bronze_load_ts", F.col("bronze_load_ts").cast("timestamp_ntz")).select(*HISTORY_VIEW_COLUMNS)


def _damage_silver(control: ControlPlane) -> None:
    """Spoil both silver tables, in their own layout: every row is marked, and
    the history loses its closed versions."""
    for name in ("demo.silver.events_history", "demo.silver.events_current"):
        head = control.store.head(name)
        spoiled = control.store.read(name).where("is_current").withColumn("event_type", F.lit("damaged"))
        parts, counted = write_buckets(control.store, name, spoiled, ["user_id"], head.lineage["buckets"])
        control.store.replace_parts(name, parts, head.schema, counted["rows"], head.lineage)


def _replay(spark, d, mode: str, **kw) -> DataFrame:
    """Two runs, spoiled silver tables, then the replay: keys in its scope come
    back whole, all others stay spoiled."""
    control, _ = _two_runs(spark, d)
    _damage_silver(control)
    control.submit_replay(9001, "events", mode, **kw)
    run_replay(spark, control, 9001)
    return _history_view(control)


# The failed run's instant in the replay-after-failure scenario.
FAILED_RUN = "2024-01-22 00:00:00"


def q_replay_after_failed_run(spark, d):
    """Run 2 lands a batch and fails its gate, a partial replay follows, run 3
    lands everything after the mark again: no landed row may be lost."""
    control = _events_control(spark, d)
    run_source(spark, control, "events", forced_batch_id=1, as_of=BATCH1_END)
    control.register([_events_row('{"required_columns": ["missing_column"]}')])
    try:
        run_source(spark, control, "events", forced_batch_id=2, as_of=FAILED_RUN)
    except ValueError:
        pass
    else:
        raise AssertionError("run 2 must fail its quality gate")
    control.register([_events_row('{"required_columns": ["event_id"]}')])
    control.submit_replay(9003, "events", "ENTITY", entity_predicate="user_id = 3")
    run_replay(spark, control, 9003)
    run_source(spark, control, "events", forced_batch_id=7, as_of=BATCH2_END)
    return _history_view(control)


def q_replay_empty_scope(spark, d):
    """A partial replay without matching rows changes nothing and is logged."""
    control, _ = _two_runs(spark, d)
    control.submit_replay(9004, "events", "ENTITY", entity_predicate="user_id IS NULL AND user_id IS NOT NULL")
    run_replay(spark, control, 9004)
    rows = control.store.read("demo.silver.events_history").groupBy(F.lit(9004).alias("replay_request_id")).agg(F.count(F.lit(1)).alias("history_rows"))
    log = control.run_log().select("replay_request_id", "run_mode", "run_status", "quality_status", "rows_read")
    request = control.replay_requests().select("replay_request_id", "request_status")
    return request.join(log, "replay_request_id").join(rows, "replay_request_id").drop("replay_request_id")


def q_run_log_rows(spark, d):
    """The run log that two runs wrote."""
    control, _ = _two_runs(spark, d)
    return control.run_log().select(
        "batch_id", "source_name", "run_mode", "run_status", "rows_read", "bronze_rows_written", "silver_rows_written",
        "gold_rows_written", "quality_status", "watermark_value")


def q_quality_rows(spark, d):
    """The quality results that two runs wrote, a missing column among those asked for."""
    control = _events_control(spark, d)
    run_source(spark, control, "events", forced_batch_id=1, as_of=BATCH1_END)
    control.register([_events_row('{"required_columns": ["event_id", "missing_column"]}')])
    try:
        run_source(spark, control, "events", forced_batch_id=2, as_of=BATCH2_END)
    except ValueError:
        pass  # the gate; its rows are what is asked for
    return control.quality_results().select("batch_id", "rule_name", "rule_status", "observed_value", "expected_value")


def _registered_customers(spark, d) -> ControlPlane:
    """One registration per nation, every fifth disabled, then all upserted again
    with another load mode while marks stay."""
    control = ControlPlane(scratch_store(spark))
    control.bootstrap()
    key = F.col("n_nationkey")
    rows = read(spark, d, "nation").select(
        F.col("n_name").alias("source_name"), F.concat(F.lit("src_"), key).alias("source_object"), (key % 5 != 0).alias("enabled"),
        F.concat(F.lit("demo.bronze.n"), key).alias("bronze_table"), F.array(F.lit("id")).alias("primary_keys"), key.alias("n"))
    control.register_from(rows.withColumn("load_mode", F.lit("FULL")))
    for n in rows.orderBy("n").limit(3).collect():  # the first three run and leave marks
        control.update_source_watermark(n["source_name"], 7, f"mark-{n['n']}")
    control.register_from(rows.withColumn("load_mode", F.lit("CDC")))
    return control


def _positions(ordered: DataFrame, column: str) -> DataFrame:
    """Rows of a small control table, numbered from 0 in its listing order."""
    return ordered.select((F.row_number().over(Window.orderBy(column)) - 1).alias("position"), column)


def q_registry_rows(spark, d):
    """The registry after registration, marks and re-registration."""
    return _registered_customers(spark, d).registrations().select(
        "source_name", "source_object", "load_mode", "enabled", "bronze_table", "last_successful_watermark", "last_batch_id")


def q_active_sources(spark, d):
    """The enabled sources in the order runs take them."""
    return _positions(_registered_customers(spark, d).active_sources(), "source_name")


def q_requested_replays(spark, d):
    """Requests still open, in the order the runner takes them."""
    control = ControlPlane(scratch_store(spark))
    control.bootstrap()
    control.submit_replays(read(spark, d, "nation").select(
        F.col("n_nationkey").alias("replay_request_id"), F.col("n_name").alias("source_name"), F.lit("FULL_REBUILD").alias("replay_mode")))
    control.mark_replay_requests(F.col("replay_request_id") % 4 == 0, "COMPLETED")
    return _positions(control.requested_replays(), "replay_request_id")


# Five sources made from given tables: key, ordering column, extract.
STAR_SOURCES = {
    "customer": ("customer_id", "source_change_ts",
                 "SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS location, "
                 "TIMESTAMP_NTZ '1992-01-01 00:00:00' AS source_change_ts FROM customer"),
    "orders": ("order_id", "source_change_ts",
               "SELECT o_orderkey AS order_id, o_custkey AS customer_id, part AS product_id, o_orderstatus AS order_status, "
               "o_totalprice AS order_amount, CAST(o_orderdate AS DATE) AS order_date, CAST(o_orderdate AS TIMESTAMP_NTZ) AS source_change_ts "
               "FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS part FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey"),
    "product": ("product_id", "source_change_ts",
                "SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS category, p_retailprice AS unit_price, "
                "TIMESTAMP_NTZ '1992-01-02 00:00:00' AS source_change_ts FROM part"),
    "invoice": ("invoice_id", "source_change_ts",
                "SELECT o_orderkey + 1000000 AS invoice_id, o_orderkey AS order_id, o_orderpriority AS invoice_status, o_totalprice AS invoice_amount, "
                "CAST(o_orderdate AS TIMESTAMP_NTZ) AS source_change_ts FROM orders WHERE o_orderstatus <> 'P'"),
    "shipment": ("shipment_id", "source_change_ts",
                 "SELECT l_orderkey * 10 AS shipment_id, l_orderkey AS order_id, max(l_linestatus) AS shipment_status, max(l_returnflag) AS warehouse_code, "
                 "CAST(max(l_shipdate) AS TIMESTAMP_NTZ) AS source_change_ts FROM lineitem GROUP BY l_orderkey"),
}


def _star(spark, d, parallelism: int) -> ControlPlane:
    """All five sources registered by their SQL and run in one call."""
    register_views(spark, d, ["orders", "customer", "part", "lineitem"])
    control = ControlPlane(scratch_store(spark), "demo")
    control.bootstrap()
    control.register([{
        "source_name": name, "source_type": "SQL", "base_extract_sql": sql, "load_mode": "FULL", "watermark_column": ordering, "watermark_type": "TIMESTAMP",
        "primary_keys": [key], "bronze_table": f"demo.bronze.{name}", "silver_current_table": f"demo.silver.{name}_current",
        "silver_history_table": f"demo.silver.{name}_history", "gold_table": f"demo.gold.{name}_serving",
    } for name, (key, ordering, sql) in STAR_SOURCES.items()])
    run_all_sources(spark, control, as_of=BATCH2_END, parallelism=parallelism)
    return control


def q_run_all_sources(spark, d):
    """The run log of one call that runs five sources side by side."""
    return _star(spark, d, parallelism=5).run_log().select(
        "batch_id", "source_name", "run_mode", "run_status", "quality_status", "rows_read", "silver_rows_written", "gold_rows_written")


def q_serving_table(spark, d):
    """Five sources landed, folded and published, then the serving table built
    from their gold snapshots and read back."""
    return build_serving(_star(spark, d, parallelism=1).store)


def q_list_tables(spark, d):
    """Tables of each layer by name, with their row counts, after a run."""
    store = _two_runs(spark, d)[0].store
    frames = [store.read(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
              for layer in ("bronze", "silver", "gold") for name in store.list_tables(f"demo.{layer}")]
    return reduce(DataFrame.unionByName, frames)


# Run instants of the four weekly landings used by the fold queries.
FOLD_CUTS = ["2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00", "2200-01-01 00:00:00"]


def _weekly_runs(spark, d, fold_mode: str) -> DataFrame:
    control = _events_control(spark, d, '{"fold_mode": "%s", "silver_buckets": 16}' % fold_mode)
    for batch_id, cut in enumerate(FOLD_CUTS, start=1):
        run_source(spark, control, "events", forced_batch_id=batch_id, as_of=cut)
    return _history_view(control)


def q_fold_incremental(spark, d):
    """Four weekly runs, silver folded incrementally (only keys of new batches)."""
    return _weekly_runs(spark, d, "incremental")


def q_fold_full(spark, d):
    """Four weekly runs, silver rebuilt from all of bronze every run."""
    return _weekly_runs(spark, d, "full")


def q_two_batch_run(spark, d):
    control, _ = _two_runs(spark, d)
    cur = control.store.read("demo.gold.events")
    return cur.select("user_id", "event_id", "effective_from", "pipeline_batch_id")


def q_replay_full_rebuild(spark, d):
    return _replay(spark, d, "FULL_REBUILD")


def q_replay_date_range_rebuild(spark, d):
    return _replay(spark, d, "DATE_RANGE", start_watermark=RANGE_START, end_watermark=RANGE_END)


def q_replay_entity_rebuild(spark, d):
    return _replay(spark, d, "ENTITY", entity_predicate=ENTITY_PREDICATE)


def q_snapshot_restore(spark, d):
    control, after_first = _two_runs(spark, d)
    control.submit_replay(9002, "events", "ICEBERG_RESTORE", snapshot_id=after_first)
    run_replay(spark, control, 9002)
    return control.store.read("demo.silver.events_current").select("user_id", "effective_from")


def q_run_metrics(spark, d):
    bronze = events_bronze(spark, d)
    hist, cur = build_scd2(bronze, ["user_id"], "ts")
    return run_counts(bronze, hist, cur)


# ------------------------------------------------------- control-table DML
def q_merge_upsert(spark, d):
    cust = read(spark, d, "customer")
    auto = cust.where(F.col("c_mktsegment") == "AUTOMOBILE")
    src = auto.select("c_custkey", "c_name", (F.col("c_acctbal") + 1).alias("c_acctbal")).unionByName(
        auto.select((F.col("c_custkey") + 1000000).alias("c_custkey"), "c_name", "c_acctbal")
    )
    target = cust.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    merged = upsert(target, src, ["c_custkey"], ["c_name", "c_acctbal"])
    return merged.select("c_custkey", "c_name", "c_acctbal", F.col("c_mktsegment").alias("preserved"))


def q_keyed_update(spark, d):
    orders = read(spark, d, "orders")
    cond = (F.col("o_orderkey") == 7) & (F.col("o_custkey") >= 0)
    out = keyed_update(orders, cond, {"o_orderstatus": F.lit("SUCCESS")})
    return out.select("o_orderkey", F.col("o_orderstatus").alias("run_status"))


def q_status_transition(spark, d):
    orders = read(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.col("o_orderstatus").alias("request_status"),
        F.col("o_orderdate").alias("started_ts"),
        F.col("o_orderdate").alias("completed_ts"),
    )
    now = ntz("2024-02-01 00:00:00")
    running = keyed_update(orders, F.col("o_orderstatus") == "P", status_assignments("RUNNING", now))
    done = keyed_update(running, F.col("o_orderstatus") == "F", status_assignments("COMPLETED", now))
    return done.select("o_orderkey", "request_status", "started_ts", "completed_ts")


# ----------------------------------------------------------------- quality
def q_dq_row_count(spark, d):
    return row_count_rule(read(spark, d, "events"))


def q_dq_required_columns(spark, d):
    return required_columns_rule(read(spark, d, "events"), ["event_id", "ts", "missing_col"])


# ----------------------------------------------------------- registry rows
def q_parse_registration(spark, d):
    nation = read(spark, d, "nation")
    registry = nation.select(
        "n_nationkey",
        F.lit("").alias("load_mode"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" , ,"), F.col("n_nationkey").cast("string"), F.lit(" ")).alias("primary_keys"),
    )
    parsed = normalize_registrations(registry)
    return parsed.select("n_nationkey", "load_mode", F.array_join("primary_keys", "|").alias("primary_keys"))


def q_options_parse(spark, d):
    ev = read(spark, d, "events")
    return ev.select("event_id", json_field(F.col("props"), "k", "int").alias("k"))


# ----------------------------------------------------------------- serving
def q_serving_order_fulfilment(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    wide = left_join_chain(
        orders,
        [
            Side(read(spark, d, "customer"), [("o_custkey", "c_custkey")],
                 [("c_name", "customer_name"), ("c_mktsegment", "customer_segment")]),
            Side(read(spark, d, "lineitem"), [("o_orderkey", "l_orderkey")],
                 [("l_partkey", "l_partkey"), ("l_suppkey", "l_suppkey"), ("l_linenumber", "l_linenumber"),
                  ("l_linestatus", "l_linestatus"), ("l_extendedprice", "l_extendedprice"), ("l_shipdate", "l_shipdate")]),
            Side(read(spark, d, "part"), [("l_partkey", "p_partkey")],
                 [("p_name", "p_name"), ("p_brand", "p_brand"), ("p_retailprice", "p_retailprice")]),
            Side(read(spark, d, "supplier"), [("l_suppkey", "s_suppkey")], [("s_name", "s_name")]),
        ],
    )
    return wide.select(
        "o_orderkey", "o_custkey", "customer_name", "customer_segment", "l_partkey", "p_name", "p_brand",
        "o_orderstatus", "l_linenumber", "l_linestatus", "s_name", "o_totalprice", "l_extendedprice",
        "p_retailprice", "o_orderdate", greatest_of(["o_orderdate", "l_shipdate"]).alias("serving_effective_from"),
    )


def q_skew_join_salted(spark, d):
    """orders LEFT JOIN lineitem with a per-task size of 2 rows: every order
    with lines is a hot right-side key and takes the salted path."""
    orders = read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    items = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    joined = skew_left_join(orders, items, [("o_orderkey", "l_orderkey")], rows_per_task=2)
    return joined.select("o_orderkey", "o_orderstatus", "l_linenumber", "l_partkey")


def q_serving_sparse(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = read(spark, d, "customer").where((F.col("c_acctbal") > 0) & (F.col("c_mktsegment") == "BUILDING"))
    part = read(spark, d, "part").where(F.col("p_size") > 25).withColumn("d", ntz("1999-01-01 00:00:00"))
    wide = left_join_chain(
        orders,
        [
            Side(cust, [("o_custkey", "c_custkey")], [("c_name", "c_name")]),
            Side(part, [("o_orderkey", "p_partkey")], [("p_name", "p_name"), ("d", "_d")]),
        ],
    )
    return wide.select("o_orderkey", "c_name", "p_name", greatest_of(["o_orderdate", "_d"]).alias("serving_effective_from"))


# ------------------------------------------------------------------- pages
def page_manifest(pages: DataFrame) -> DataFrame:
    """Every page plus one slug with no page (max id + 1)."""
    missing = pages.agg((F.max("page_id") + 1).alias("slug")).select(
        "slug", F.lit("#000000").alias("accent"), F.lit("#111111").alias("accent2")
    )
    return palette_manifest(pages).unionByName(missing)


def _extracted(spark, d):
    pages = read(spark, d, "pages")
    return extract_pages(page_manifest(pages), pages)


def q_page_title(spark, d):
    return _extracted(spark, d).where(F.col("page_id").isNotNull()).select("page_id", "title")


def q_page_body(spark, d):
    return _extracted(spark, d).where(F.col("has_body")).select("page_id", "body")


def q_page_status(spark, d):
    return _extracted(spark, d).select("slug", "status")


def q_page_render(spark, d):
    return render_pages(_extracted(spark, d), PAGE_TEMPLATE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "src_table": q_src_table,
    "src_sql": q_src_sql,
    "src_union_all": q_src_union_all,
    "extract_full": q_extract_full,
    "extract_first_run": q_extract_first_run,
    "extract_incremental": q_extract_incremental,
    "extract_sequence": q_extract_sequence,
    "high_water_mark": q_high_water_mark,
    "watermark_text": q_watermark_text,
    "watermark_cast": q_watermark_cast,
    "next_batch_id": q_next_batch_id,
    "record_hash": q_record_hash,
    "bronze_enrich": q_bronze_enrich,
    "latest_per_key": q_latest_per_key,
    "effective_ranges": q_effective_ranges,
    "scd2_history": q_scd2_history,
    "scd2_current": q_scd2_current,
    "scd2_current_cdc": q_scd2_current_cdc,
    "scd2_current_null_live": q_scd2_current_null_live,
    "scd2_hot_split": q_scd2_hot_split,
    "scd2_sequence": q_scd2_sequence,
    "scd2_full_snapshots": q_scd2_full_snapshots,
    "scd2_composite_key": q_scd2_composite_key,
    "gold_snapshot": q_gold_snapshot,
    "impacted_keys": q_impacted_keys,
    "anti_remaining": q_anti_remaining,
    "replay_date_range_scope": q_replay_date_range_scope,
    "replay_entity_scope": q_replay_entity_scope,
    "rewrite_impacted": q_rewrite_impacted,
    "union_by_name_evolve": q_union_by_name_evolve,
    "replay_after_failed_run": q_replay_after_failed_run,
    "replay_empty_scope": q_replay_empty_scope,
    "run_log_rows": q_run_log_rows,
    "quality_rows": q_quality_rows,
    "registry_rows": q_registry_rows,
    "active_sources": q_active_sources,
    "requested_replays": q_requested_replays,
    "replay_full_rebuild": q_replay_full_rebuild,
    "replay_date_range_rebuild": q_replay_date_range_rebuild,
    "replay_entity_rebuild": q_replay_entity_rebuild,
    "two_batch_run": q_two_batch_run,
    "fold_incremental": q_fold_incremental,
    "fold_full": q_fold_full,
    "run_all_sources": q_run_all_sources,
    "serving_table": q_serving_table,
    "list_tables": q_list_tables,
    "snapshot_restore": q_snapshot_restore,
    "run_metrics": q_run_metrics,
    "merge_upsert": q_merge_upsert,
    "keyed_update": q_keyed_update,
    "status_transition": q_status_transition,
    "dq_row_count": q_dq_row_count,
    "dq_required_columns": q_dq_required_columns,
    "parse_registration": q_parse_registration,
    "options_parse": q_options_parse,
    "serving_order_fulfilment": q_serving_order_fulfilment,
    "serving_sparse": q_serving_sparse,
    "skew_join_salted": q_skew_join_salted,
    "page_title": q_page_title,
    "page_body": q_page_body,
    "page_status": q_page_status,
    "page_render": q_page_render,
}
