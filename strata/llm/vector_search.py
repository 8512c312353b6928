"""Approximate nearest neighbours by randomly rotated one-bit codes.

Unit vectors are assigned to the nearest of a few thousand coarse centres.  The
residual to the centre is rotated by a seeded orthogonal matrix and kept as its
sign bits, its norm and the inner product of the unit residual with its own code
(the correction).  For a query q the code gives the unbiased estimate
``<c,q> + norm * <code, Rq> / correction`` of the cosine, with an error below
``norm * sqrt(1 - correction^2) / correction * EPSILON / sqrt(D - 1)`` up to a
small probability.  A vector is read again in double precision if its upper bound
reaches the bar: the exact k-th best score among the most promising estimates of
its block.

Centres are fitted on a sample of at most ``SAMPLE`` vectors (smallest id hashes;
documented bound); every vector is indexed.  A query visits its nearest lists,
as many as held 97 % of the true nearest rows when measured by brute force
inside the sample.  Lists are cut into blocks of about ``BLOCK`` vectors by a hash of
the id, and the queries of a list into parts of ``QUERY_PART``, so copies of one
vector, on either side, never meet in one task.

Edge cases: vectors that are null, zero, hold null or non-finite components,
have another length than most, or lack an id take no part; rows with the query's
id are its own rows; of repeated ids the nearest counts once; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialize

SAMPLE = 30_000
LIST_ROWS = 1024
MOST_LISTS = 4096
LEAST_PROBES = 8
BLOCK = 4096
QUERY_PART = 2048
EPSILON = 3.0
ROUNDS = 8
SEED = 11


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def unit(v: np.ndarray) -> np.ndarray:
    big = np.abs(v).max(axis=1, keepdims=True)  # scaled first: squares of extreme components stay finite
    v = v / np.where(big > 0, big, 1)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def encode(u: np.ndarray, centres: np.ndarray, lists: np.ndarray, turn: np.ndarray):
    """(packed sign bits, residual norm, correction) of unit vectors."""
    r = u - centres[lists]
    norm = np.sqrt((r * r).sum(axis=1))
    o = (r / np.where(norm > 0, norm, 1)[:, None]) @ turn.T
    return np.packbits(o > 0, axis=1), norm, np.abs(o).sum(axis=1) / np.sqrt(o.shape[1])


def estimate(bits, norm, correction, centre, queries, turn):
    """(estimated cosines, error bounds), queries by vectors."""
    dim = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    dots = (queries @ turn.T) @ signs.T / np.sqrt(dim)
    safe = np.maximum(correction, 1e-6)
    est = (queries @ centre)[:, None] + norm * dots / safe
    err = norm * np.sqrt(np.maximum(1 - safe**2, 0)) / safe * EPSILON / np.sqrt(max(dim - 1, 1)) + 1e-5
    return est, np.broadcast_to(err, est.shape)


def fit_centres(u: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means on the sample."""
    rng = np.random.default_rng(SEED)
    centres = u[rng.choice(len(u), k, replace=False)].copy()
    for _ in range(ROUNDS if k > 1 else 1):
        near = np.concatenate([(u[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(u), 4096)])
        total = np.zeros_like(centres)
        np.add.at(total, near, u)
        many = np.bincount(near, minlength=k)
        centres = np.where(many[:, None] > 0, total / np.maximum(many, 1)[:, None], centres)
    return centres.astype(np.float32)


def fit_probes(u: np.ndarray, centres: np.ndarray, top: int, share: float = 0.97, queries: int = 256) -> int:
    """How many lists a query must visit to meet ``share`` of its true nearest
    rows, measured by brute force inside the sample (in the full table they are
    nearer still)."""
    ask = u[:queries]
    near = lambda v: v @ centres.T - 0.5 * (centres * centres).sum(axis=1)
    home = np.concatenate([near(u[i : i + 4096]).argmax(axis=1) for i in range(0, len(u), 4096)])
    place = np.argsort(np.argsort(-near(ask), axis=1, kind="stable"), axis=1, kind="stable")
    cosine = ask @ u.T
    cosine[np.arange(len(ask)), np.arange(len(ask))] = -2
    best = np.argpartition(-cosine, min(top, len(u) - 1), axis=1)[:, :top]
    return int(np.quantile(np.take_along_axis(place, home[best], axis=1), share)) + 1


def _usable(batches):
    """Rows with an id and a non-zero vector of finite numbers, length by length."""
    for batch in batches:
        col = batch.column("embedding")
        size = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = col.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
        start = np.cumsum(size) - size
        has_id = batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
        for dim in np.unique(size[size > 0]).tolist():
            rows = np.flatnonzero((size == dim) & has_id)
            m = flat[start[rows][:, None] + np.arange(dim)]
            good = np.isfinite(m).all(axis=1) & m.any(axis=1)
            rows, m = rows[good], np.ascontiguousarray(m[good])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").cast(pa.int64()).take(pa.array(rows)), pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), dim).cast(pa.list_(pa.float64())),
                 pa.array(np.full(len(rows), dim), pa.int32())], names=["vec_id", "embedding", "dim"])


def _matrix(col, dim):
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _assign(centres: np.ndarray, probes: int, every: int):
    """Each vector with its list; each query also with the lists it visits."""

    def run(batches):
        dim = centres.shape[1]
        for batch in batches:
            v = _matrix(batch.column("embedding"), dim)
            u = unit(v).astype(np.float32)
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            near = u @ centres.T - 0.5 * (centres * centres).sum(axis=1)  # smallest distance
            own = near.argmax(axis=1)
            q = np.flatnonzero(ids % every == 0)
            visit = np.argsort(-near[q], axis=1, kind="stable")[:, :probes]
            rows = np.concatenate([np.arange(len(ids)), np.repeat(q, visit.shape[1])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([own, visit.ravel()]), pa.int32()), pa.array(np.arange(len(rows)) >= len(ids)),
                 batch.column("vec_id").take(pa.array(rows)), batch.column("embedding").take(pa.array(rows))], names=["list", "query", "vec_id", "embedding"])

    return run


def _search(centres: np.ndarray, top: int):
    turn = rotation(centres.shape[1])

    def best(q_id, q, ids, v, centre):
        """Reranked (query, vector, score) of one block, ``top`` per query."""
        uv, uq = unit(v), unit(q)
        bits, norm, correction = encode(uv.astype(np.float32), centre[None], np.zeros(len(v), int), turn)
        out = []
        for lo in range(0, len(q), 256):
            part = slice(lo, lo + 256)
            est, err = estimate(bits, norm, correction, centre, uq[part].astype(np.float32), turn)
            own = q_id[part][:, None] == ids[None, :]
            est = np.where(own, -np.inf, est)
            k = min(top, len(ids))
            few = min(4 * top, len(ids))
            # the exact k-th best of the most promising estimates is the bar
            first = np.argpartition(-est, few - 1, axis=1)[:, :few]
            exact = np.einsum("qd,qfd->qf", uq[part], uv[first])
            exact[np.take_along_axis(own, first, axis=1)] = -np.inf
            bar = np.partition(exact, few - k, axis=1)[:, few - k]
            qi, vi = np.nonzero((est + err >= bar[:, None] - 1e-9) & ~own)
            for a in range(0, len(qi), 100_000):
                x, y = qi[a : a + 100_000], vi[a : a + 100_000]
                score = (uq[part][x] * uv[y]).sum(axis=1)
                hit = score >= bar[x] - 1e-9
                out.append((q_id[part][x[hit]], ids[y[hit]], score[hit]))
        return tuple(np.concatenate(c) for c in zip(*out)) if out else None

    def run(key, data):
        dim = centres.shape[1]
        query = data.column("query").to_numpy(zero_copy_only=False)
        data_ids = data.column("vec_id").to_numpy(zero_copy_only=False)
        m = _matrix(data.column("embedding").combine_chunks(), dim)
        found = None
        if query.any() and not query.all():
            found = best(data_ids[query], m[query], data_ids[~query], m[~query], centres[key[0].as_py()])
        if found is None:
            found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        qid, vid, score = found
        order = np.lexsort((vid, -score, qid))
        qid, vid, score = qid[order], vid[order], score[order]
        _, once = np.unique(np.stack([qid, vid]), axis=1, return_index=True)  # of a repeated id the nearest
        once.sort()
        qid, vid, score = qid[once], vid[once], score[once]
        rank = np.arange(len(qid)) - np.searchsorted(qid, qid)
        keep = rank < top
        return pa.table([pa.array(qid[keep], pa.int64()), pa.array(vid[keep], pa.int64()), pa.array(score[keep], pa.float64())], names=["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, top: int = 5, every: int = 50, probes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows of each vector whose id is
    divisible by ``every``."""
    spark = vectors.sparkSession
    usable = vectors.select("vec_id", "embedding").mapInArrow(_usable, "vec_id long, embedding array<double>, dim int")
    sizes = usable.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    dim, n = sizes["dim"], sizes["n"]
    usable = usable.where(F.col("dim") == dim).select("vec_id", "embedding")
    sample = usable.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(SAMPLE).toArrow()
    u = unit(_matrix(sample.column("embedding").combine_chunks(), dim)).astype(np.float32)
    centres = fit_centres(u, max(1, min(n // LIST_ROWS, MOST_LISTS, len(u) // 4)))
    if probes is None:
        probes = max(LEAST_PROBES, fit_probes(u, centres, top))
    placed = materialize(usable.mapInArrow(_assign(centres, probes, every), "list int, query boolean, vec_id long, embedding array<double>"))
    # one row per list (MOST_LISTS at most): how many blocks and query parts it has
    plan = placed.groupBy("list").agg(
        F.ceil(F.count_if(~F.col("query")) / BLOCK).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.count_if("query") / QUERY_PART).cast("int"), F.lit(1)).alias("parts"))
    rows = placed.join(F.broadcast(plan), "list")
    block = F.pmod(F.xxhash64("vec_id"), F.greatest("blocks", F.lit(1))).cast("int")
    part = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts")).cast("int")
    every_block = F.sequence(F.lit(0), F.greatest("blocks", F.lit(1)) - 1)
    stored = (rows.where("not query").withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    asked = rows.where("query").withColumn("part", part).withColumn("block", F.explode(every_block))
    columns = ["list", "block", "part", "query", "vec_id", "embedding"]
    found = (stored.select(columns).union(asked.select(columns)).groupBy("list", "block", "part")
             .applyInArrow(_search(centres, top), "query_id long, vec_id long, score double"))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
