"""A streaming source lands through the same run path, once per micro-batch."""

import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.plans.control import ControlPlane
from strata.session import warehouse_root
from strata.sources.tables import TableStore
from strata.streaming import stream_source


def test_stream_lands_and_folds(spark):
    root = f"{warehouse_root(spark)}/stream_{uuid.uuid4().hex[:8]}"
    store = TableStore(spark, root)
    control = ControlPlane(store)
    control.bootstrap()
    control.register([{
        "source_name": "events", "source_object": "unused", "load_mode": "EVENT", "watermark_column": "ts",
        "watermark_type": "TIMESTAMP", "primary_keys": ["user_id"], "bronze_table": "demo.bronze.events",
        "silver_current_table": "demo.silver.events_current", "silver_history_table": "demo.silver.events_history",
        "gold_table": "demo.gold.events", "options_json": '{"required_columns": ["event_id", "user_id"]}',
    }])
    static = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    stream = (
        spark.readStream.schema(static.schema).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL)
        .select("event_id", "ts", "user_id", "event_type", "value")
    )
    checkpoint = f"{root}/_stream_checkpoint"
    for _ in range(2):  # the second start finds nothing new
        q = stream_source(spark, control, "events", stream, checkpoint, trigger={"availableNow": True})
        q.awaitTermination()
    runs = control.run_log().collect()
    assert len(runs) == 1 and runs[0]["run_status"] == "SUCCESS"
    assert runs[0]["requested_by"].startswith("stream:land_events:")
    assert store.read("demo.bronze.events").count() == static.count()
    users = static.select("user_id").distinct().count()
    assert store.read("demo.gold.events").count() == users
    assert control.get_registration("events").last_successful_watermark == str(
        static.agg(F.max("ts").cast("string")).first()[0]
    )
