"""Steps of the Jaccard join that decide which pairs are looked at: none may lose a link."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import common
from strata.llm import jaccard_join as jj
from strata.llm.common import mix


def sets_near(rng, n, changed):
    a = np.unique(mix(rng.integers(1 << 62, size=n).astype(np.uint64)))
    b = np.unique(np.r_[a[changed:], mix(rng.integers(1 << 62, size=changed).astype(np.uint64))])
    return a, b


def signature(s):
    whole, half = jj._stored(s, False)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([whole], pa.binary()), pa.array([half], pa.binary())], names=["cls", "tokens", "halves"])
    out = next(jj._signatures([batch]))
    return np.array([out["x"][0].as_py()]), np.array([out["y"][0].as_py()])


def test_signatures_never_part_linked_sets():
    rng = np.random.default_rng(5)
    parted = 0
    for _ in range(3000):
        n = int(rng.integers(1, 600))
        a, b = sets_near(rng, n, int(rng.integers(0, max(1, n // 4))))
        common = len(np.intersect1d(a, b))
        linked = 185 * common >= 85 * (len(a) + len(b))
        near = bool(jj._near(len(a), *signature(a), len(b), *signature(b), 85)[0])
        assert near or not linked
        parted += not near
    assert parted > 200  # and they do part many that are not linked


def test_judgement_of_stored_sets():
    rng = np.random.default_rng(6)
    rows, want = [], []
    for _ in range(400):
        n = int(rng.integers(2, 700))
        a, b = sets_near(rng, n, int(rng.integers(0, max(1, n // 6))))
        rows.append((*jj._stored(a, False), *jj._stored(b, False)))
        want.append(185 * len(np.intersect1d(a, b)) >= 85 * (len(a) + len(b)))
    k = pa.array(range(len(rows)), pa.int64())
    batch = pa.RecordBatch.from_arrays([k, k, *(pa.array(c, pa.binary()) for c in zip(*rows))], names=["a", "b", "x", "xh", "y", "yh"])
    found = next(jj._judge(85)([batch])).to_pylist()
    assert {r["a"] for r in found} >= {i for i, w in enumerate(want) if w}
    assert all(want[r["a"]] for r in found if r["sure"])
    assert any(not r["sure"] for r in found)


def test_sketches_never_part_linked_sets():
    """Sets of any two sizes: a linked pair always stays, most others go."""
    rng = np.random.default_rng(7)
    rows, linked = [], []
    for _ in range(2000):
        n = int(2 ** rng.uniform(0, 12))
        a, b = sets_near(rng, n, int(rng.integers(0, max(1, n // 3))))
        b = b[: max(1, int(len(b) * rng.uniform(0.7, 1)))] if rng.random() < 0.5 else b
        rows.append((len(a), jj.sketch(a), len(b), jj.sketch(b)))
        linked.append(185 * len(np.intersect1d(a, b)) >= 85 * (len(a) + len(b)))
    k = pa.array(range(len(rows)), pa.int64())
    n1, s1, n2, s2 = zip(*rows)
    batch = pa.RecordBatch.from_arrays([k, k, pa.array(n1), pa.array(n2), pa.array(s1, pa.binary()), pa.array(s2, pa.binary())], names=["a", "b", "n1", "n2", "s1", "s2"])
    kept = set(next(jj._alike(85)([batch])).column("a").to_pylist())
    assert kept >= {i for i, w in enumerate(linked) if w}
    assert len(kept) - sum(linked) < 0.3 * (len(rows) - sum(linked))


def rows_of(rng, tokens, classes):
    """(token, cls, at, root, x, y) with one token that most classes have."""
    rows = []
    for c in range(classes):
        n, root = rng.randrange(20, 26), c % 7 if c % 3 else c
        for pos, t in enumerate([1] * (c % 10 > 0) + rng.sample(range(2, tokens), 2)):
            rows.append((t, c, (n << 32) + pos, root, 0, 0))
    return rows


def pairs_by_hand(rows):
    out = set()
    for i, (t, c, at, r, _, _) in enumerate(rows):
        for t2, c2, at2, r2, _, _ in rows[:i]:
            if t == t2 and r != r2 and jj._fit(np.int64(at >> 32), np.int64(at & 255), np.int64(at2 >> 32), np.int64(at2 & 255), 85):
                out.add((min(c, c2), max(c, c2)))
    return out


def test_crossings_in_blocks_equal_all_pairs(spark, monkeypatch):
    rows = rows_of(random.Random(3), 40, 150)
    df = spark.createDataFrame(rows, "token long, cls long, at long, root long, x long, y long").repartition(4)
    want = pairs_by_hand(rows)
    assert want
    for block in (2048, 16, 1):
        monkeypatch.setattr(jj, "BLOCK", block)
        assert {tuple(r) for r in jj.crossings(df, 85).collect()} == want


def test_crossings_make_a_pair_once(spark, monkeypatch):
    """Sets that share many tokens make one row a pair, not one a token."""
    rng = random.Random(8)
    rows = []
    for c in range(60):  # each is a component of its own and lacks two of 40 tokens
        tokens = sorted(set(range(1000, 1040)) - set(rng.sample(range(1000, 1040), 2)))
        rows += [(t, c, (300 << 32) + pos, c, 0, 0) for pos, t in enumerate(tokens)]
    df = spark.createDataFrame(rows, "token long, cls long, at long, root long, x long, y long").repartition(4)
    monkeypatch.setattr(type(df), "distinct", lambda self: self)
    made = [tuple(r) for r in jj.crossings(df, 85).collect()]
    assert set(made) == {(a, b) for b in range(60) for a in range(b)} and len(made) == 60 * 59 // 2


def test_crossings_drop_pairs_by_long_signatures(spark):
    rng = np.random.default_rng(9)
    base = np.unique(mix(rng.integers(1 << 62, size=400).astype(np.uint64)))
    sets = [np.r_[base[: 400 - 10 * k], mix(rng.integers(1 << 62, size=10 * k).astype(np.uint64))] for k in range(8)]
    stored = [jj._stored(s, False) for s in sets]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8), pa.int64()), *(pa.array(c, pa.binary()) for c in zip(*stored))], names=["cls", "tokens", "halves"])
    known = spark.createDataFrame(next(jj._signatures([batch])).to_pandas())
    rows = spark.createDataFrame([(7, c, len(s) << 32, c) for c, s in enumerate(sets)], "token long, cls long, at long, root long")
    got = {tuple(r) for r in jj.crossings(rows, 85, known.select("cls", *jj.SIGNS)).collect()}
    linked = {(a, b) for b in range(8) for a in range(b) if 185 * len(np.intersect1d(sets[a], sets[b])) >= 85 * (len(sets[a]) + len(sets[b]))}
    assert got >= linked and len(linked) >= 5 and len(got) <= len(linked) + 4 < 28


def test_further_orders_looked_up_by_pair(spark):
    """Linked pairs stay, most pairs of few common tokens go."""
    rng = np.random.default_rng(10)
    levels, pairs, rows, linked = np.zeros(1 << jj.SKETCH_BITS, np.uint8), [], [], set()
    for i in range(200):
        n = int(rng.integers(20, 300))
        a, b = sets_near(rng, n, int(rng.integers(0, n // 12 + 1)) if i % 2 else n - 3)
        for c, s in ((2 * i, a), (2 * i + 1, b)):
            p = np.concatenate([jj.prefix(s, order, levels, 85) for order in range(1, jj.ORDERS)])
            rows.append((c, len(s), bytearray((p >> np.uint64(32)).astype("<u4").tobytes())))
        pairs.append((2 * i, 2 * i + 1))
        if 185 * len(np.intersect1d(a, b)) >= 85 * (len(a) + len(b)):
            linked.add(pairs[-1])
    left = jj.share_in_orders(spark.createDataFrame(pairs, "a long, b long"), spark.createDataFrame(rows, "cls long, n long, prefixes binary"), 85)
    got = {tuple(r) for r in left.collect()}
    assert got >= linked and len(linked) >= 50 and len(got) < 120


def test_shared_rows_over_small_batches(spark):
    """Rows of one token may come in any number of batches."""
    rows = [(t, c, at) for t, c, at, *_ in rows_of(random.Random(4), 40, 150)] * 2
    want = {(t, c) for t, c, at in rows if any(t == t2 and c != c2 and jj.least_overlap(max(at >> 32, at2 >> 32), 85) <= min(at >> 32, at2 >> 32) for t2, c2, at2 in rows)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.createDataFrame(rows, jj.PREFIX_SCHEMA).repartition("token").sortWithinPartitions("token", "at", "cls")
        got = [(r.token, r.cls) for r in df.mapInArrow(jj._shared(85), jj.PREFIX_SCHEMA).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert len(got) == len(set(got)) and set(got) == want


def test_filter_holds_every_hash(spark):
    ids = spark.range(5000).select(F.xxhash64("id").alias("h"))
    held = np.array([r[0] for r in ids.collect()])
    bits = common.hash_filter(ids, "h")
    assert common.passes(bits, held).all()
    others = np.array([r[0] for r in spark.range(5000, 25000).select(F.xxhash64("id")).collect()])
    assert common.passes(bits, others).mean() < 0.01
    assert not common.passes(common.hash_filter(ids.where("false"), "h"), held).any()


def test_rows_of_repeated_keys(spark, monkeypatch):
    rows = spark.createDataFrame([(k % 40 if k % 3 else 7, k) for k in range(200)], "h long, v long")
    counts = rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 3")
    big = {r.h: r.n for r in counts.collect()}
    want = sorted((r.h, r.v, big[r.h] > 20) for r in rows.collect() if r.h in big)
    for most in (100_000, 0):
        monkeypatch.setattr(common, "MOST_BROADCAST", most)
        assert sorted(tuple(r) for r in common.rows_of_repeated(rows, ["h"], counts, 20).collect()) == want


def test_small_results_take_few_files(spark):
    rows = spark.range(100).repartition(8)
    written = common.materialize(rows, 100)
    assert len(written.inputFiles()) == 1
    assert sorted(r[0] for r in written.collect()) == list(range(100))
    assert len(common.materialize(rows, 100 * common.ROWS_PER_FILE).inputFiles()) == 8


def test_components_write_few_files(spark, monkeypatch):
    files = []
    write = common.materialize

    def counted(df, *rows):
        out = write(df, *rows)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(common, "materialize", counted)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        chain = spark.createDataFrame([(i, i + 1) for i in range(0, 90) if i % 30 != 29], "a long, b long")
        got = {r["node"]: r["root"] for r in common.components(chain).collect()}
    finally:
        spark.conf.unset(key)
    assert got == {i: i // 30 * 30 for i in range(90)}
    assert max(files) == 1


def test_keep_one_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (None, "x")], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(1) for c in ("__id", "__rows", "id_hash", "cls", "component_id")})
    kept = jj.keep_one(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 1), (True, None)]
