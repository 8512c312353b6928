"""The two-batch sales demo: five sources, two seed snapshots, a serving table
and a full-rebuild replay.

``run_demo`` resets the catalog, registers the sources, seeds snapshot 1,
runs every source with fixed batch ids, seeds snapshot 2, runs again, builds
the serving table from the five gold snapshots and replays ``customer``.
"""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.operators.serving import sales_fulfilment
from strata.plans.control import ControlPlane
from strata.plans.replay import run_replay
from strata.plans.runs import run_source
from strata.sources.tables import TableStore

CATALOG = "demo"

STAGING_SCHEMAS = {
    "customer": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("source_change_ts", T.TimestampType()),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("order_amount", T.DecimalType(12, 2)),
        T.StructField("order_date", T.DateType()),
        T.StructField("source_change_ts", T.TimestampType()),
    ]),
    "product": T.StructType([
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("unit_price", T.DecimalType(12, 2)),
        T.StructField("source_change_ts", T.TimestampType()),
    ]),
    "invoice": T.StructType([
        T.StructField("invoice_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("invoice_status", T.StringType()),
        T.StructField("invoice_amount", T.DecimalType(12, 2)),
        T.StructField("source_change_ts", T.TimestampType()),
    ]),
    "shipment": T.StructType([
        T.StructField("shipment_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("shipment_status", T.StringType()),
        T.StructField("warehouse_code", T.StringType()),
        T.StructField("source_change_ts", T.TimestampType()),
    ]),
}


def _ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def _d(text: str) -> Decimal:
    return Decimal(text)


# Seed snapshot 1 (one row per entity, in table order).
SEED_BATCH_1 = {
    "customer": [
        (1, "Acme Retail", "London", _ts("2026-04-01 08:00:00")),
        (2, "Northwind Stores", "New York", _ts("2026-04-01 08:15:00")),
    ],
    "orders": [
        (101, 1, 1001, "PLACED", _d("250.00"), date(2026, 4, 1), _ts("2026-04-01 09:00:00")),
        (102, 2, 1002, "PLACED", _d("180.00"), date(2026, 4, 1), _ts("2026-04-01 09:10:00")),
    ],
    "product": [
        (1001, "Laptop Pro 15", "Computing", _d("250.00"), _ts("2026-04-01 07:30:00")),
        (1002, "Noise Cancel Headset", "Accessories", _d("180.00"), _ts("2026-04-01 07:35:00")),
    ],
    "invoice": [
        (5001, 101, "GENERATED", _d("250.00"), _ts("2026-04-01 10:00:00")),
        (5002, 102, "GENERATED", _d("180.00"), _ts("2026-04-01 10:05:00")),
    ],
    "shipment": [
        (7001, 101, "PICKED", "LON-01", _ts("2026-04-01 11:00:00")),
        (7002, 102, "PICKED", "NYC-01", _ts("2026-04-01 11:05:00")),
    ],
}

# Seed snapshot 2 (one changed and one unchanged row per table).
SEED_BATCH_2 = {
    "customer": [
        (1, "Acme Retail", "Bangalore", _ts("2026-04-02 09:00:00")),
        (2, "Northwind Stores", "New York", _ts("2026-04-01 08:15:00")),
    ],
    "orders": [
        (101, 1, 1001, "INVOICED", _d("250.00"), date(2026, 4, 1), _ts("2026-04-02 09:30:00")),
        (102, 2, 1002, "PLACED", _d("180.00"), date(2026, 4, 1), _ts("2026-04-01 09:10:00")),
    ],
    "product": [
        (1001, "Laptop Pro 15", "Computing", _d("250.00"), _ts("2026-04-01 07:30:00")),
        (1002, "Noise Cancel Headset", "Accessories", _d("175.00"), _ts("2026-04-02 08:45:00")),
    ],
    "invoice": [
        (5001, 101, "PAID", _d("250.00"), _ts("2026-04-02 10:00:00")),
        (5002, 102, "GENERATED", _d("180.00"), _ts("2026-04-01 10:05:00")),
    ],
    "shipment": [
        (7001, 101, "SHIPPED", "BLR-01", _ts("2026-04-02 11:00:00")),
        (7002, 102, "PICKED", "NYC-01", _ts("2026-04-01 11:05:00")),
    ],
}

# Per source -> (key column, load mode, required columns, first batch id).
DEMO_SOURCES = {
    "customer": ("customer_id", "INCREMENTAL_TS", ["customer_id", "location", "source_change_ts"], 1001),
    "orders": ("order_id", "INCREMENTAL_TS", ["order_id", "customer_id", "order_status", "source_change_ts"], 1101),
    "product": ("product_id", "FULL", ["product_id", "product_name", "category", "source_change_ts"], 1201),
    "invoice": ("invoice_id", "INCREMENTAL_TS", ["invoice_id", "order_id", "invoice_status", "source_change_ts"], 1301),
    "shipment": ("shipment_id", "INCREMENTAL_TS", ["shipment_id", "order_id", "shipment_status", "source_change_ts"], 1401),
}


def bronze_table(source: str) -> str:
    suffix = "snapshot" if DEMO_SOURCES[source][1] == "FULL" else "incremental"
    return f"{CATALOG}.bronze.{source}_{suffix}"


def registrations() -> list[dict]:
    import json

    rows = []
    for source, (key, mode, required, _) in DEMO_SOURCES.items():
        rows.append({
            "source_name": source,
            "domain_name": "sales",
            "source_type": "TABLE",
            "source_object": f"{CATALOG}.staging.{source}_source",
            "enabled": True,
            "load_mode": mode,
            "watermark_column": "source_change_ts",
            "watermark_type": "TIMESTAMP",
            "primary_keys": [key],
            "bronze_table": bronze_table(source),
            "silver_current_table": f"{CATALOG}.silver.{source}_current",
            "silver_history_table": f"{CATALOG}.silver.{source}_history",
            "gold_table": f"{CATALOG}.gold.{source}_serving",
            "silver_transform_name": "scd2_current_history",
            "gold_publish_name": "publish_current_snapshot",
            "quality_rule_set": f"{source}_core",
            "replay_mode_default": "FULL_REBUILD",
            "options_json": json.dumps({"required_columns": required}),
        })
    return rows


def seed(spark: SparkSession, store: TableStore, batch: dict) -> None:
    """Replace each staging table with the given snapshot (INSERT OVERWRITE)."""
    for source, rows in batch.items():
        store.replace(f"{CATALOG}.staging.{source}_source", spark.createDataFrame(rows, STAGING_SCHEMAS[source]))


def demo_tables() -> list[str]:
    out = [f"{CATALOG}.gold.sales_order_fulfillment"]
    for source in DEMO_SOURCES:
        out += [
            f"{CATALOG}.gold.{source}_serving", f"{CATALOG}.silver.{source}_current",
            f"{CATALOG}.silver.{source}_history", bronze_table(source), f"{CATALOG}.staging.{source}_source",
        ]
    return out


def build_serving(store: TableStore) -> DataFrame:
    """``CREATE OR REPLACE`` the serving table from the five gold snapshots."""
    gold = {s: store.read(f"{CATALOG}.gold.{s}_serving") for s in DEMO_SOURCES}
    counts = {s: store.head(f"{CATALOG}.gold.{s}_serving").row_count for s in DEMO_SOURCES}
    wide = sales_fulfilment(gold["orders"], gold["customer"], gold["product"], gold["invoice"], gold["shipment"],
                            rows=counts)
    name = f"{CATALOG}.gold.sales_order_fulfillment"
    store.replace(name, wide)
    return store.read(name)


def run_demo(spark: SparkSession, store: TableStore, as_of: tuple[str, str, str] | None = None) -> ControlPlane:
    """Reset, register, two seeded batches over all sources, serving, replay.

    ``as_of`` fixes the run instants of batch 1, batch 2 and the replay
    (session-zone text); by default each run reads the clock.
    """
    first, second = as_of[:2] if as_of else (None, None)
    control = ControlPlane(store, CATALOG)
    control.reset(demo_tables())
    control.bootstrap()
    for source, schema in STAGING_SCHEMAS.items():
        store.create_empty(f"{CATALOG}.staging.{source}_source", schema)
    control.register(registrations())
    seed(spark, store, SEED_BATCH_1)
    for source, (_, _, _, batch_id) in DEMO_SOURCES.items():
        run_source(spark, control, source, forced_batch_id=batch_id, as_of=first)
    seed(spark, store, SEED_BATCH_2)
    for source, (_, _, _, batch_id) in DEMO_SOURCES.items():
        run_source(spark, control, source, forced_batch_id=batch_id + 1, as_of=second)
    build_serving(store)
    control.submit_replay(9001, "customer", "FULL_REBUILD", requested_by="platform-support",
                          notes="Rebuild customer history and current from bronze")
    run_replay(spark, control, 9001)
    return control


def main() -> None:
    """Run the demo into the session's warehouse and show what it produced."""
    from strata.session import build_session, warehouse_root

    spark = build_session("strata-demo")
    try:
        store = TableStore(spark, warehouse_root(spark) + "/demo_catalog")
        control = run_demo(spark, store)
        control.run_log().select(
            "batch_id", "source_name", "run_mode", "run_status", "rows_read", "silver_rows_written", "watermark_value"
        ).orderBy("batch_id").show(truncate=False)
        for layer in ("silver", "gold"):
            for name, preview in store.preview(f"{CATALOG}.{layer}").items():
                print(f"=== {name}")
                preview.show(truncate=False)
        store.read(f"{CATALOG}.gold.sales_order_fulfillment").orderBy("order_id").show(truncate=False)
        control.replay_requests().select("replay_request_id", "source_name", "request_status").show()
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
