"""Column functions and registry parsing."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import ReplayRequest, SourceRegistration, from_row
from strata.functions.options import normalize_list_col
from strata.functions.watermark import mark_literal
from strata.operators.bronze import enrich_bronze
from strata.operators.quality import required_columns_result, rollup, row_count_result
from strata.plans.control import REGISTRATION_SCHEMA, normalize_registrations, normalize_requests


def test_normalize_list(spark):
    rows = spark.createDataFrame([(1, None, None), (2, [" a", None, "", "b "], " a , ,b ")], "i int, items array<string>, text string")
    got = rows.select(normalize_list_col(F.col("items"), True), normalize_list_col(F.col("text"), False)).orderBy("i").collect()
    assert [list(map(list, r)) for r in got] == [[[], []], [[" a", "b "], ["a", "b"]]]


def _registration(spark, **values):
    row = {"source_name": "s", "bronze_table": "b", **values}
    df = spark.createDataFrame([tuple(row.get(f.name) for f in REGISTRATION_SCHEMA.fields)], REGISTRATION_SCHEMA)
    return from_row(SourceRegistration, normalize_registrations(df).first())


def test_options_parsing(spark):
    for text in (None, "", "{not json", "[1, 2]"):
        reg = _registration(spark, options_json=text)
        assert reg.options == {} and reg.required_columns == [] and reg.deleted_values == ["Y", "YES", "TRUE", "1", "D"]
    reg = _registration(spark, options_json='{"required_columns": ["a", " "], "deleted_values": ["x", "Yes"], "silver_buckets": 4}')
    assert (reg.required_columns, reg.deleted_values, reg.options["silver_buckets"]) == (["a"], ["X", "YES"], 4)
    assert _registration(spark, options_json='{"required_columns": "only", "fold_mode": "FULL"}').required_columns == ["only"]


def test_registration_defaults(spark):
    reg = _registration(spark, load_mode="", primary_keys=["k1", " ", "k2"], options_json="oops")
    assert reg.load_mode == "FULL" and reg.primary_keys == ["k1", "k2"] and reg.options == {}
    assert reg.silver_transform_name == "scd2_current_history" and not reg.is_incremental
    inc = SourceRegistration(source_name="s", bronze_table="b", load_mode="CDC", watermark_column="ts",
                             sequence_column="seq")
    assert inc.ordering_column == "seq" and inc.is_incremental
    df = spark.createDataFrame([(3, "s", "entity", "")], "replay_request_id long, source_name string, replay_mode string, request_status string")
    req = from_row(ReplayRequest, normalize_requests(df).first())
    assert (req.replay_mode, req.request_status) == ("ENTITY", "REQUESTED")


def test_normalize_registrations_frame(spark):
    df = spark.createDataFrame(
        [("a", "", ["k", None, " "], '{"required_columns": ["k"]}'), ("b", "cdc", None, "bad")],
        "source_name string, load_mode string, primary_keys array<string>, options_json string",
    )
    rows = {r["source_name"]: r for r in normalize_registrations(df).collect()}
    assert rows["a"]["load_mode"] == "FULL" and rows["a"]["primary_keys"] == ["k"]
    assert rows["a"]["options"]["required_columns"] == ["k"]
    assert rows["b"]["load_mode"] == "CDC" and rows["b"]["primary_keys"] == []


def test_mark_literals(spark):
    assert mark_literal(None, "TIMESTAMP") is None
    row = spark.range(1).select(
        mark_literal("2026-04-01 08:15:00", "TIMESTAMP", T.TimestampNTZType()).alias("a"),
        mark_literal("2026-04-01", "date").alias("b"),
        mark_literal("42", "BIGINT", T.LongType()).alias("c"),
        mark_literal("1.5", "DOUBLE").alias("d"),
        mark_literal("x'y", "STRING").alias("e"),
    )
    types = [f.dataType for f in row.schema.fields]
    assert types == [T.TimestampNTZType(), T.DateType(), T.LongType(), T.DoubleType(), T.StringType()]
    assert row.first()["e"] == "x'y"


def test_bronze_system_name_collision(spark):
    src = spark.createDataFrame([(1, "from-source")], "id long, source_name string")
    out = enrich_bronze(src, "registry-name", 5, "FULL", F.lit("2026-01-01 00:00:00").cast("timestamp"))
    assert out.columns == ["id", "source_name", "pipeline_batch_id", "bronze_load_ts", "load_mode", "record_hash"]
    row = out.first()
    assert row["source_name"] == "registry-name"
    expected = spark.range(1).select(F.sha2(F.lit('{"id":1,"source_name":"registry-name"}'), 256)).first()[0]
    assert row["record_hash"] == expected


def test_quality_rules():
    ok = row_count_result(3)
    empty = row_count_result(0)
    assert (ok.rule_status, ok.observed_value, ok.expected_value) == ("PASSED", "3", ">= 0")
    assert empty.rule_status == "NO_DATA"
    req = required_columns_result(["a", "b"], [])
    assert (req.rule_status, req.expected_value, req.details) == (
        "PASSED", "configured per source", "All required columns were present.")
    bad = required_columns_result(["a", "b"], ["a", "c", "d"])
    assert (bad.rule_status, bad.observed_value, bad.details) == ("FAILED", "a, b", "Missing columns: c, d")
    assert rollup([ok, bad]) == "FAILED" and rollup([empty, req]) == "NO_DATA" and rollup([ok, req]) == "PASSED"
