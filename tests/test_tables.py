"""Versioned table verbs: create, append, replace-from-self, restore, share, drop."""

import uuid

import pytest
from pyspark.sql import functions as F

from strata.session import warehouse_root
from strata.sources.tables import TableStore


@pytest.fixture()
def store(spark):
    return TableStore(spark, f"{warehouse_root(spark)}/t_{uuid.uuid4().hex[:8]}")


def test_versions_and_restore(spark, store):
    t = "ns.tbl"
    assert not store.exists(t)
    v1 = store.append(t, spark.range(3))
    v2 = store.append(t, spark.range(3, 5))
    assert store.read(t).count() == 5
    v3 = store.replace(t, store.read(t).where(F.col("id") % 2 == 0))  # reads itself
    assert sorted(r.id for r in store.read(t).collect()) == [0, 2, 4]
    assert store.read(t, version=v1).count() == 3
    store.restore(t, v2)
    assert store.read(t).count() == 5
    assert [r.version for r in store.versions(t).orderBy("version").collect()] == [1, 2, 3, 4]
    assert (v1, v2, v3) == (1, 2, 3)


def test_append_schema_must_match(spark, store):
    store.append("a.b", spark.range(2))
    with pytest.raises(ValueError, match="differs"):
        store.append("a.b", spark.range(2).withColumn("x", F.lit(1)))


def test_share_is_zero_copy(spark, store):
    store.replace("s.src", spark.range(4))
    store.share("s.src", "g.dst")
    assert store.head("g.dst").parts == store.head("s.src").parts
    assert store.read("g.dst").count() == 4


def test_drop_and_empty(spark, store):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.LongType())])
    store.create_empty("c.e", schema)
    assert store.exists("c.e") and store.read("c.e").count() == 0
    assert store.create_empty("c.e", schema) is None
    assert store.drop("c.e")
    assert not store.exists("c.e")
    assert not store.drop("c.e")
    with pytest.raises(ValueError):
        store.read("c.e")
    assert store.list_tables("c") == []


def test_namespaces_and_preview(spark, store):
    store.create_namespace("demo.bronze")
    assert store.namespace_exists("demo.bronze") and store.list_tables("demo.bronze") == []
    store.append("demo.bronze.x", spark.range(50))
    store.append("demo.bronze.y", spark.range(5))
    previews = store.preview("demo.bronze")
    assert sorted(previews) == ["demo.bronze.x", "demo.bronze.y"]
    assert previews["demo.bronze.x"].count() == 20 and previews["demo.bronze.y"].count() == 5


def test_append_log_is_incremental(spark, store, monkeypatch):
    import json

    import strata.sources.tables as tables

    monkeypatch.setattr(tables, "CHECKPOINT_EVERY", 4)
    for i in range(9):
        store.append("b.log", spark.range(i, i + 1))
    fresh = TableStore(spark, store.root)  # no cache: resolves from the log files
    assert fresh.read("b.log").count() == 9
    assert sorted(r.id for r in fresh.read("b.log", version=6).collect()) == list(range(6))
    entries = [json.loads(store._read_text(f"{store._log_path('b.log')}/{v:020d}.json")) for v in range(1, 10)]
    assert [e["parts"] is None for e in entries] == [False, True, True, False, True, True, True, False, True]
    assert all(len(e["added"]) == 1 for e in entries if e["parts"] is None)


def test_optimistic_commits(spark, store):
    from strata.sources.tables import CommitConflict

    store.replace("c.t", spark.range(3))
    stale = store.head("c.t").version
    store.replace("c.t", spark.range(5), expected_version=stale)
    with pytest.raises(CommitConflict):
        store.replace("c.t", spark.range(7), expected_version=stale)  # computed from an old version
    assert store.read("c.t").count() == 5
    other = TableStore(spark, store.root)  # a second writer with its own cache
    store.append("c.a", spark.range(1))
    other.append("c.a", spark.range(1, 2))
    store.append("c.a", spark.range(2, 3))
    assert sorted(r.id for r in other.read("c.a").collect()) == [0, 1, 2]


def test_control_update_retries_on_conflict(spark, store, monkeypatch):
    from strata.plans.control import ControlPlane

    control = ControlPlane(store)
    control.bootstrap()
    control.register([{"source_name": "a", "bronze_table": "x"}, {"source_name": "b", "bronze_table": "y"}])
    real_read = store.read
    raced = {"done": False}

    def racing_read(name, version=None):
        frame = real_read(name, version)
        if name == control.registry and not raced["done"]:
            raced["done"] = True  # another writer moves the registry forward mid-update
            ControlPlane(TableStore(spark, store.root)).update_source_watermark("b", 9, "mark-b")
        return frame

    monkeypatch.setattr(store, "read", racing_read)
    control.update_source_watermark("a", 8, "mark-a")
    monkeypatch.setattr(store, "read", real_read)
    marks = {r["source_name"]: r["last_successful_watermark"] for r in control.registrations().collect()}
    assert marks == {"a": "mark-a", "b": "mark-b"}  # neither update is lost


def test_latest_version_hint_may_lag(spark, store):
    for i in range(4):
        store.append("h.t", spark.range(i, i + 1))
    store._write_hint("h.t", 2)  # a hint that lags behind (e.g. a concurrent writer's)
    fresh = TableStore(spark, store.root)
    assert fresh.head("h.t").version == 4 and fresh.read("h.t").count() == 4
    fs, jpath = store._fs(f"{store._log_path('h.t')}/_last")
    fs.delete(jpath, False)  # no hint at all: the log is listed
    assert TableStore(spark, store.root).head("h.t").version == 4
