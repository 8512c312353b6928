"""Sources that change between runs (new columns, wider types) and instants in a repeated clock hour."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.schemas import evolved, wider
from strata.plans.replay import run_replay
from strata.plans.runs import run_source
from test_runs import make

BATCHES = [
    ("id int, val int, del string, ts timestamp", [(i, i, "n", 1) for i in range(40)]),
    ("id int, val int, del string, ts timestamp", [(i, i + 100, "n", 2) for i in range(0, 40, 3)]),
    # gains a column, widens val
    ("id int, val bigint, del string, ts timestamp, note string", [(i, (1 << 40) + i, "n", 3, f"n{i}") for i in range(0, 40, 5)]),
    # the present form again
    ("id int, val bigint, del string, ts timestamp, note string", [(2, 7, "n", 4, "again"), (50, 1, "n", 4, None)]),
    # the key widens too
    ("id bigint, val bigint, del string, ts timestamp, note string", [(1 << 35, 1, "n", 5, "big"), (3, 3, "y", 5, "gone")]),
]


def land(spark, store, control, batches, first=0):
    for n, (schema, rows) in enumerate(batches, first):
        hour = T._parse_datatype_string(schema).fieldNames().index("ts")
        rows = [r[:hour] + (datetime(2026, 1, 1, r[hour]),) + r[hour + 1:] for r in rows]
        store.replace("demo.staging.src", spark.createDataFrame(rows, schema))
        run_source(spark, control, "src", as_of=f"2026-01-02 0{n}:00:00")


def rows_in(store):
    frames = [store.read(f"demo.{t}") for t in ("silver.src_history", "silver.src_current", "gold.src", "bronze.src")]
    return [(df.schema.simpleString(), sorted(str(sorted(r.asDict().items())) for r in df.collect())) for df in frames]


def test_a_source_that_gains_columns_and_widens_equals_a_rebuild(spark):
    store, control = make(spark, options_json='{"silver_buckets": 4}')

    def replayed(number, mode, entity=None):
        control.submit_replay(number, "src", mode, entity_predicate=entity)
        run_replay(spark, control, number)
        return rows_in(store)

    land(spark, store, control, BATCHES[:4])  # folded batch by batch
    folded = rows_in(store)
    assert replayed(1, "ENTITY", "id in (2, 3, 5)") == folded == replayed(2, "FULL_REBUILD")
    land(spark, store, control, BATCHES[4:], first=4)
    folded = rows_in(store)
    assert replayed(3, "FULL_REBUILD") == folded
    history, current = store.read("demo.silver.src_history"), store.read("demo.silver.src_current")
    assert history.count() == 40 + 14 + 8 + 2 + 2 and {history.schema[c].dataType for c in ("id", "val")} == {T.LongType()}
    assert {r.id: (r.val, r.note) for r in current.where("id in (1, 2, 3, 5)").collect()} == {1: (1, None), 2: (7, "again"), 5: ((1 << 40) + 5, "n5")}
    assert current.where("note = 'big'").count() == 1


def test_unsafe_changes_fail(spark):
    store, control = make(spark)
    land(spark, store, control, BATCHES[:1])
    for schema, row in (("id int, val string, del string, ts timestamp", (1, "x", "n", 2)), ("id int, del string, ts timestamp", (1, "n", 2))):
        with pytest.raises(ValueError, match="Landing into"):
            land(spark, store, control, [(schema, [row])])
    assert store.read("demo.bronze.src").count() == 40


def test_wider_types():
    dec = T.DecimalType
    assert wider(dec(10, 2), dec(12, 2)) == dec(12, 2) and wider(dec(10, 2), dec(10, 4)) is None
    assert wider(T.DoubleType(), T.FloatType()) == T.DoubleType() and wider(T.LongType(), T.ByteType()) == T.LongType()
    assert wider(T.DateType(), T.TimestampType()) is None and wider(T.IntegerType(), T.StringType()) is None
    a, b = (T._parse_datatype_string(s) for s in ("k int, v float", "x string, v double, k int"))
    assert evolved("t", a, b).simpleString() == "struct<k:int,v:double,x:string>"


def test_rows_of_a_repeated_clock_hour_are_read_once(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        store, control = make(spark, load_mode="INCREMENTAL_TS")
        # 2025-11-02: 05:30 UTC is 01:30 summer time, 06:10 and 06:20 UTC are 01:10 and 01:20 an hour later
        base = int(datetime(2025, 11, 2, tzinfo=timezone.utc).timestamp())
        for minutes in ([330, 370], [330, 370, 380], [330, 370, 380, 440]):
            rows = spark.createDataFrame([(m, "g", str(m), "n", base + 60 * m) for m in minutes], "id long, grp string, val string, del string, at long")
            store.replace("demo.staging.src", rows.withColumn("ts", F.timestamp_seconds("at")).drop("at"))
            run_source(spark, control, "src")
        landed = sorted((r.id, r.pipeline_batch_id) for r in store.read("demo.bronze.src").collect())
        assert [i for i, _ in landed] == [330, 370, 380, 440] and len({b for _, b in landed}) == 3
        assert control.get_registration("src").last_successful_watermark == "2025-11-02 02:20:00"  # 07:20 UTC, not ambiguous
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
