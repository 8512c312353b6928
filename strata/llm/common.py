"""Shared helpers of the text operators: Arrow text buffers, word tables, folds.

Python runs only inside Spark tasks here: every operator hands Arrow batches to
numpy, and a batch is walked in slices of at most ``SLICE_BYTES`` of text (one
document at least) so that the working arrays of a task stay small whatever the
batch size is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 2_000_000

# bytes that separate words: blank and TAB, LF, VT, FF, CR
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# A-Z -> a-z, every other byte unchanged
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_CODE = np.random.default_rng(20240607).integers(1, 1 << 63, 256).astype(np.uint64)


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Batches of at most ``rows`` rows in scans and towards Python, unless the
    cluster says otherwise: texts are long, a task's scan holds one batch of them,
    and an Arrow batch is held by the JVM and by Python at once."""
    for key in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"):
        if not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold_of(doc_id: Column, n: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``n`` (a null id counts as 0)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows holding about ``limit`` text bytes."""
    _, off = text_buffer(batch.column(column))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield batch.slice(lo, hi - lo)
        lo = hi


def per_document(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many positions of each document are set."""
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def spans_of(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of set positions that never cross a document border."""
    n = len(mask)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[off] = True
    start = mask.copy()
    start[1:] &= ~mask[:-1] | first[1:n]
    end = mask.copy()
    end[:-1] &= ~mask[1:] | first[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word ``[^\\x20\\x09-\\x0D]+``."""
    start, end = spans_of(~IS_SPACE[buf], off)
    return start, end, np.searchsorted(off, start, side="right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_POW = {"n": 0, "up": np.zeros(0, np.uint64), "down": np.zeros(0, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POW["n"] < n:
        size = max(n, SLICE_BYTES)
        up, down = np.full(size, _BASE), np.full(size, _BASE_INV)
        up[0] = down[0] = 1
        _POW.update(n=size, up=np.cumprod(up, dtype=np.uint64), down=np.cumprod(down, dtype=np.uint64))
    return _POW["up"][:n], _POW["down"][:n]


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit content hash of each byte span, from one prefix sum over ``buf``."""
    up, down = _powers(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[buf] * up[: len(buf)], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def windows(values: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` consecutive values inside one document.

    Returns (position of the first value, hash)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    pos = np.flatnonzero(doc[:n] == doc[width - 1 :])
    h = np.zeros(len(pos), np.uint64)
    for j in range(width):
        h = mix(h * _BASE + values[pos + j])
    return pos, h


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which entries hold a value that occurs more than once."""
    out = np.zeros(len(keys), bool)
    if len(keys) > 1:
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        out[order[1:]] = same
        out[order[:-1]] |= same
    return out


def keep_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; all others (whatever they are called) are left out."""
    return df.select(*[F.col(n) for n in names])


def partitions_for(spark: SparkSession, floor: int = 1) -> int:
    return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


ROWS_PER_FILE = 5_000  # of small written results


def materialize(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint folder and read it
    back: lineage ends there, and an executor's loss costs no recomputation.

    Where about how many ``rows`` come is known, a small result takes few tasks and
    files, not one for each shuffle partition (every new file of a local file system
    costs the executor a few child processes); a large one is left as it is dealt."""
    import uuid

    from strata.session import checkpoint_dir

    spark = df.sparkSession
    if rows is not None and (files := max(1, -(-rows // ROWS_PER_FILE))) < partitions_for(spark):
        df = df.coalesce(files)
    path = f"{checkpoint_dir(spark).rstrip('/')}/strata-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


FILTER_BITS = 26  # 8 MB whatever the number of hashes


def hash_filter(rows: DataFrame, column: str) -> np.ndarray:
    """Bits of a fixed-size filter, two for each 64-bit hash in ``column``: at most
    2^20 words of 64 bits come to the driver; a full filter lets all rows pass."""
    bits = F.explode(F.array(*[F.pmod(F.shiftright(column, k), F.lit(1 << FILTER_BITS)) for k in (0, 32)]))
    words = (rows.select(bits.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")).toArrow())
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[words.column("word").to_numpy()] = words.column("mask").to_numpy()
    return out


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter (all that are, and few others)."""
    out = np.ones(len(hashes), bool)
    for k in (0, 32):
        at = (hashes >> k) & ((1 << FILTER_BITS) - 1)
        out &= (bits[at >> 6].view(np.uint64) >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
    return out


MOST_BROADCAST = 100_000  # keys of a list that is broadcast


def rows_of_repeated(rows: DataFrame, keys: list[str], counts: DataFrame, hot: int) -> DataFrame:
    """The rows (a written table) whose key ``counts`` (keys, n) lists, with ``hot``
    set for keys of more than ``hot`` rows.

    Those keys are few (rows / hot at most); up to ``MOST_BROADCAST`` of them are
    broadcast, so their rows are marked where they lie and never meet in one task."""
    big = counts.where(F.col("n") > hot).select(*keys)
    if big.limit(MOST_BROADCAST + 1).count() > MOST_BROADCAST:
        return rows.join(counts, keys).select(*rows.columns, (F.col("n") > hot).alias("hot"))
    big = F.broadcast(big)
    some = rows.join(big, keys, "left_anti").join(counts.where(F.col("n") <= hot).select(*keys), keys, "left_semi")
    many = rows.join(big, keys, "left_semi")
    return some.select(*rows.columns, F.lit(False).alias("hot")).union(many.select(*rows.columns, F.lit(True).alias("hot")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node
    of its connected component.

    Alternating large-star and small-star rounds: each is one grouped minimum
    and one join, and no node's neighbours are gathered in one place."""

    def minima(pairs):  # (u, v) -> smallest of u and its neighbours
        return pairs.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))

    rows = edges.count()
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), rows)
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small = (large.join(minima(large), "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("p"))
                 .select("p.*").where("u != v").distinct())
        e = materialize(small, rows)
        now = tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        if now == before:
            break
        before, rows = now, now[0]
    roots = e.select("v").distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
