"""The two-batch sales demo reproduces the expected run log, history, serving
table and replay outcome."""

import uuid

import pytest
from pyspark.sql import functions as F

from strata.plans.demo import DEMO_SOURCES, run_demo
from strata.session import warehouse_root
from strata.sources.tables import TableStore

AS_OF = ("2026-04-01 12:00:00", "2026-04-03 00:00:00", None)


@pytest.fixture(scope="module")
def demo(spark):
    store = TableStore(spark, f"{warehouse_root(spark)}/demo_{uuid.uuid4().hex[:8]}")
    control = run_demo(spark, store, AS_OF)
    return store, control


def test_run_log(demo):
    store, control = demo
    rows = {
        r["batch_id"]: r
        for r in control.run_log().orderBy("batch_id").collect()
    }
    expected = {
        1001: ("customer", "PIPELINE_INCREMENTAL_TS", 2, 2, 4, 2, "PASSED", "2026-04-01 08:15:00"),
        1101: ("orders", "PIPELINE_INCREMENTAL_TS", 2, 2, 4, 2, "PASSED", "2026-04-01 09:10:00"),
        1201: ("product", "PIPELINE_FULL", 2, 2, 4, 2, "PASSED", "2026-04-01 07:35:00"),
        1301: ("invoice", "PIPELINE_INCREMENTAL_TS", 2, 2, 4, 2, "PASSED", "2026-04-01 10:05:00"),
        1401: ("shipment", "PIPELINE_INCREMENTAL_TS", 2, 2, 4, 2, "PASSED", "2026-04-01 11:05:00"),
        1002: ("customer", "PIPELINE_INCREMENTAL_TS", 1, 1, 5, 2, "PASSED", "2026-04-02 09:00:00"),
        1102: ("orders", "PIPELINE_INCREMENTAL_TS", 1, 1, 5, 2, "PASSED", "2026-04-02 09:30:00"),
        1202: ("product", "PIPELINE_FULL", 2, 2, 6, 2, "PASSED", "2026-04-02 08:45:00"),
        1302: ("invoice", "PIPELINE_INCREMENTAL_TS", 1, 1, 5, 2, "PASSED", "2026-04-02 10:00:00"),
        1402: ("shipment", "PIPELINE_INCREMENTAL_TS", 1, 1, 5, 2, "PASSED", "2026-04-02 11:00:00"),
        1403: ("customer", "REPLAY_FULL_REBUILD", 3, 0, 5, 2, "REPLAYED", None),
    }
    assert set(rows) == set(expected)
    for batch_id, want in expected.items():
        r = rows[batch_id]
        got = (r["source_name"], r["run_mode"], r["rows_read"], r["bronze_rows_written"],
               r["silver_rows_written"], r["gold_rows_written"], r["quality_status"], r["watermark_value"])
        assert got == want, batch_id
        assert r["run_status"] == "SUCCESS"


def test_quality_rows_and_replay_status(demo):
    store, control = demo
    assert control.quality_results().count() == 20
    req = control.replay_requests().where("replay_request_id = 9001").first()
    assert req["request_status"] == "COMPLETED"
    assert req["started_ts"] is not None and req["completed_ts"] is not None


def _hist(store, source, value_col):
    df = store.read(f"demo.silver.{source}_history")
    key = DEMO_SOURCES[source][0]
    rows = [
        (r[key], str(r[value_col]), str(r["effective_from"]), None if r["effective_to"] is None else str(r["effective_to"]),
         r["is_current"], r["pipeline_batch_id"])
        for r in df.collect()
    ]
    return sorted(rows, key=str)


def test_history_after_two_batches(demo):
    store, _ = demo
    assert _hist(store, "customer", "location") == sorted([
        (1, "Bangalore", "2026-04-02 09:00:00", None, True, 1002),
        (1, "London", "2026-04-01 08:00:00", "2026-04-02 09:00:00", False, 1001),
        (2, "New York", "2026-04-01 08:15:00", None, True, 1001),
    ], key=str)
    assert _hist(store, "product", "unit_price") == sorted([
        (1001, "250.00", "2026-04-01 07:30:00", "2026-04-01 07:30:00", False, 1201),
        (1001, "250.00", "2026-04-01 07:30:00", None, True, 1202),
        (1002, "175.00", "2026-04-02 08:45:00", None, True, 1202),
        (1002, "180.00", "2026-04-01 07:35:00", "2026-04-02 08:45:00", False, 1201),
    ], key=str)
    assert _hist(store, "shipment", "shipment_status") == sorted([
        (7001, "PICKED", "2026-04-01 11:00:00", "2026-04-02 11:00:00", False, 1401),
        (7001, "SHIPPED", "2026-04-02 11:00:00", None, True, 1402),
        (7002, "PICKED", "2026-04-01 11:05:00", None, True, 1401),
    ], key=str)


def test_serving_table(demo):
    store, _ = demo
    rows = store.read("demo.gold.sales_order_fulfillment").orderBy("order_id").collect()
    got = [tuple(str(v) for v in r) for r in rows]
    assert got == [
        ("101", "1", "Acme Retail", "Bangalore", "1001", "Laptop Pro 15", "Computing", "INVOICED", "5001", "PAID",
         "7001", "SHIPPED", "BLR-01", "250.00", "250.00", "250.00", "2026-04-01", "2026-04-02 11:00:00"),
        ("102", "2", "Northwind Stores", "New York", "1002", "Noise Cancel Headset", "Accessories", "PLACED", "5002",
         "GENERATED", "7002", "PICKED", "NYC-01", "180.00", "180.00", "175.00", "2026-04-01", "2026-04-02 08:45:00"),
    ]


def test_every_layer_is_written_with_the_compact_codec(demo):
    """Landed, silver, gold and serving folders hold zstd files only."""
    store, _ = demo
    for name in ("demo.bronze.orders_incremental", "demo.silver.orders_history", "demo.silver.orders_current",
                 "demo.gold.orders_serving", "demo.gold.sales_order_fulfillment"):
        files = store.read(name).inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files), name


def test_unchanged_source_third_run_has_no_data(spark, demo):
    from strata.plans.runs import run_source

    store, control = demo
    batch = run_source(spark, control, "customer", as_of="2026-04-04 00:00:00")
    r = control.run_log().where(F.col("batch_id") == batch).first()
    assert (r["run_status"], r["quality_status"], r["rows_read"]) == ("SUCCESS", "NO_DATA", 0)
    assert r["watermark_value"] == "2026-04-02 09:00:00"


def test_layer_listing(demo):
    store, _ = demo
    assert store.list_tables("demo.bronze") == sorted(
        ["demo.bronze.customer_incremental", "demo.bronze.orders_incremental", "demo.bronze.product_snapshot",
         "demo.bronze.invoice_incremental", "demo.bronze.shipment_incremental"]
    )


def test_sources_in_parallel_match_sequential(spark):
    """Five sources run from a thread pool share the control tables safely and
    give the same silver tables as one-by-one runs."""
    from strata.plans.control import ControlPlane
    from strata.plans.demo import SEED_BATCH_1, SEED_BATCH_2, STAGING_SCHEMAS, registrations, seed
    from strata.plans.runs import run_all_sources

    outcomes = []
    for parallelism in (1, 5):
        store = TableStore(spark, f"{warehouse_root(spark)}/par_{uuid.uuid4().hex[:8]}")
        control = ControlPlane(store)
        control.bootstrap()
        for source, schema in STAGING_SCHEMAS.items():
            store.create_empty(f"demo.staging.{source}_source", schema)
        control.register(registrations())
        seed(spark, store, SEED_BATCH_1)
        run_all_sources(spark, control, as_of=AS_OF[0], parallelism=parallelism)
        seed(spark, store, SEED_BATCH_2)
        ids = run_all_sources(spark, control, as_of=AS_OF[1], parallelism=parallelism)
        assert len(set(ids)) == len(DEMO_SOURCES)
        log = control.run_log().collect()
        assert len(log) == 10 and all(r["run_status"] == "SUCCESS" for r in log)
        assert control.quality_results().count() == 20
        outcomes.append({
            s: sorted(tuple(str(v) for v in r) for r in
                      store.read(f"demo.silver.{s}_history").drop("bronze_load_ts", "pipeline_batch_id").collect())
            for s in DEMO_SOURCES
        })
    assert outcomes[0] == outcomes[1]
