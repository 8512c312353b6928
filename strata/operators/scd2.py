"""SCD type 2: fold an append-only change log into history + current.

Semantics (per business key):

* versions are ordered by the ordering column, then ``bronze_load_ts``, both
  ascending with NULLs last; ``effective_to`` is the next version's ordering
  value (``lead``), NULL for the last one;
* the current version is the first one under the *descending* order with
  NULLs last (so a NULL-ordered row is never current when a dated row exists);
* every bronze row is a history row (no hash de-duplication);
* the current table is the current history rows minus soft deletes
  (``upper(cast(flag as string)) IN deleted values``; a NULL flag drops the
  row unless ``null_flag_is_live``).

Rows tied on (ordering, load ts) are ordered by ``record_hash`` and then by
a per-row id, so the order is total: exactly one row per key is current, and
even a large group of identical copies can be split across tasks.

Scale: the plain plan is one hash exchange on the keys feeding two window
sorts.  A key holding a large share of all rows would then sit in one task,
so keys are first checked against a sample: a key with more than
``rows_per_bucket`` rows (estimated) is split into value-range buckets of the
total order, the windows run per (key, bucket), and a small per-bucket table
(bounded by the number of buckets) stitches the bucket edges back together:
the last row of a bucket takes its ``effective_to`` from the first row of the
next non-empty bucket, and only the winning bucket may hold the current row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.config import SYSTEM_COLUMNS
from strata.functions.options import DEFAULT_DELETED_VALUES
from strata.session import cut_lineage

LOAD_TS = "bronze_load_ts"
ROW_ID = "_rid"
HISTORY_TRAILER = ("pipeline_batch_id", "bronze_load_ts", "record_hash")
SCD2_COLUMNS = ("effective_from", "effective_to", "is_current")

DEFAULT_ROWS_PER_BUCKET = 4_000_000
SAMPLES_PER_BUCKET = 20
# Broadcast bound for the bucket-edge and stitch tables: one row per bucket of
# a hot key (about 100 bytes each), so 100k buckets stay near 10 MB; above it
# the same tables are joined without a broadcast hint.
MAX_BROADCAST_BUCKETS = 100_000
_SAMPLE_SEED = 20240101


def _null_safe_on(left: DataFrame, right_names: dict[str, str], keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(F.col(right_names[k])) for k in keys])


def _order_key(cols: Sequence[str], descending: bool) -> Column:
    """Struct whose natural order equals the window order with NULLs last.

    Ascending: (is_null, value) per column; descending (for ``max``):
    (is_not_null, value) per column.
    """
    fields = []
    for i, c in enumerate(cols):
        flag = F.col(c).isNotNull() if descending else F.col(c).isNull()
        fields += [flag.alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*fields)


def rows_per_bucket_setting(spark) -> int:
    value = spark.conf.get("strata.scd2.rowsPerBucket", None)
    return int(value) if value else DEFAULT_ROWS_PER_BUCKET


def hot_key_bounds(frame: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                   rows_per_bucket: int) -> DataFrame | None:
    """Bucket edges for keys with more than ``rows_per_bucket`` rows.

    A seeded Bernoulli sample with about ``SAMPLES_PER_BUCKET`` rows per
    bucket is taken (every row when buckets are smaller than that); a key
    with at least two buckets' worth of sampled rows is hot, and every
    bucket's worth of sampled order keys ends with an edge.  Returns ``None`` when no key is hot, else a checkpointed table
    (keys..., ``_bounds`` sorted array) whose row count is bounded by the
    number of buckets.
    """
    fraction = min(1.0, SAMPLES_PER_BUCKET / float(rows_per_bucket))
    per_edge = max(1, round(rows_per_bucket * fraction))  # sampled rows per bucket
    akey = _order_key(order_cols, descending=False).alias("_akey")
    sampled = frame.select(*keys, akey).sample(False, fraction, seed=_SAMPLE_SEED)
    # cheap first pass (one partial aggregate): is any key hot at all?
    busy = sampled.groupBy(*keys).count().where(F.col("count") >= 2 * per_edge)
    if not busy.take(1):
        return None
    per_key = Window.partitionBy(*keys)
    ordered = Window.partitionBy(*keys).orderBy(F.col("_akey"))
    edges = (
        sampled.withColumn("_n", F.count(F.lit(1)).over(per_key))
        .where(F.col("_n") >= 2 * per_edge)
        .withColumn("_rn", F.row_number().over(ordered))
        .where(F.col("_rn") % per_edge == 0)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("_akey")).alias("_bounds"))
    )
    edges = cut_lineage(edges)
    return edges if edges.take(1) else None


def build_scd2(
    bronze: DataFrame,
    keys: Sequence[str],
    ordering: str,
    *,
    delete_column: str | None = None,
    deleted_values: Sequence[str] = DEFAULT_DELETED_VALUES,
    null_flag_is_live: bool = False,
    tie_break: Sequence[str] | None = None,
    rows_per_bucket: int | None = None,
    row_count_hint: int | None = None,
    cluster_by: str | Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Return ``(history, current)`` for a bronze change log.

    ``row_count_hint`` (an upper bound on the input rows, e.g. from the table
    log) skips the hot-key sample when no key can fill two buckets.

    ``cluster_by`` names columns that are functions of the keys (a storage
    bucket, then a sub-bucket).  The window input is then hash-partitioned on
    them (plus the hot-key range bucket) and sorted by them first, so a writer
    partitioning by the storage bucket gets few files per bucket and needs no
    extra sort.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("SCD2 requires primary key columns.")
    if not ordering:
        raise ValueError("SCD2 requires a watermark_column or sequence_column.")
    missing = [c for c in [*keys, ordering, LOAD_TS] if c not in bronze.columns]
    if missing:
        raise ValueError(f"SCD2 input lacks columns: {missing}")
    payload = [c for c in bronze.columns if c not in SYSTEM_COLUMNS]
    clash = [c for c in payload if c in SCD2_COLUMNS]
    if clash:
        raise ValueError(f"Source columns collide with SCD2 columns: {clash}")
    if tie_break is None:
        tie_break = [c for c in ("record_hash",) if c in bronze.columns]
        bronze = bronze.withColumn(ROW_ID, F.monotonically_increasing_id())
        tie_break = [*tie_break, ROW_ID]
    order_cols = [ordering, LOAD_TS, *tie_break]

    asc = [F.col(c).asc_nulls_last() for c in order_cols]
    desc = [F.col(c).desc_nulls_last() for c in order_cols]
    rpb = rows_per_bucket or rows_per_bucket_setting(bronze.sparkSession)
    if row_count_hint is not None and row_count_hint < 2 * rpb:
        bounds = None
    else:
        bounds = hot_key_bounds(bronze, keys, order_cols, rpb)

    lead_cols = [cluster_by] if isinstance(cluster_by, str) else list(cluster_by or [])
    if bounds is None:
        part = [*lead_cols, *keys]
        staged = bronze
        if lead_cols:
            staged = staged.repartition(*[F.col(c) for c in lead_cols])
    else:
        n_buckets = bounds.select(F.sum(F.size("_bounds") + 1)).first()[0] or 0
        renamed = {k: f"_hk_{i}" for i, k in enumerate(keys)}
        right = bounds.select(*[F.col(k).alias(renamed[k]) for k in keys], "_bounds")
        if n_buckets <= MAX_BROADCAST_BUCKETS:
            right = F.broadcast(right)
        akey = _order_key(order_cols, descending=False)
        staged = (
            bronze.join(right, _null_safe_on(bronze, renamed, keys), "left")
            .withColumn(
                "_bucket",
                F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(
                    F.size(F.filter(F.col("_bounds"), lambda b: b <= akey))
                ),
            )
            .drop(*renamed.values())
        )
        part = [*lead_cols, *keys, "_bucket"]
        if lead_cols:
            staged = staged.repartition(*[F.col(c) for c in lead_cols], F.col("_bucket"))

    w_asc = Window.partitionBy(*part).orderBy(*asc)
    w_desc = Window.partitionBy(*part).orderBy(*desc)
    ranked = (
        staged.withColumn("_lead", F.lead(F.col(ordering)).over(w_asc))
        .withColumn("_has_next", F.lead(F.lit(True)).over(w_asc).isNotNull())
        .withColumn("_rn", F.row_number().over(w_desc))
    )

    if bounds is None:
        effective_to = F.col("_lead")
        is_current = F.col("_rn") == 1
    else:
        # One row per (hot key, bucket), from hash-aggregatable primitives:
        #   _first   first ordering value in the bucket (NULLs sort last),
        #   _mx      largest ordering value,
        #   _mx_lts  largest ordering value among rows with a load timestamp,
        #   _nl      bucket holds a row with NULL ordering and a load timestamp.
        ordc, ltsc = F.col(ordering), F.col(LOAD_TS)
        summary = (
            staged.where(F.col("_bounds").isNotNull())
            .groupBy(*keys, "_bucket")
            .agg(
                F.min(ordc).alias("_first"),
                F.max(ordc).alias("_mx"),
                F.max(F.when(ltsc.isNotNull(), ordc)).alias("_mx_lts"),
                F.max(F.when(ordc.isNull() & ltsc.isNotNull(), F.lit(1))).alias("_nl"),
            )
        )
        # The current row (first under the descending order) lies in the last
        # bucket holding the key's largest ordering value with a load
        # timestamp, else the last bucket holding that value; when every
        # ordering value is NULL, the last bucket with a load timestamp, else
        # the last bucket.  Bucket numbers follow the ascending order.
        by_key = Window.partitionBy(*keys)
        top = F.max("_mx").over(by_key)

        def last_bucket(cond: Column) -> Column:
            return F.max(F.when(cond, F.col("_bucket"))).over(by_key)

        winner = F.when(
            top.isNotNull(),
            F.coalesce(last_bucket(F.col("_mx_lts") == top), last_bucket(F.col("_mx") == top)),
        ).otherwise(F.coalesce(last_bucket(F.col("_nl") == 1), F.max("_bucket").over(by_key)))
        stitched = summary.select(
            *[F.col(k).alias(f"_gk_{i}") for i, k in enumerate(keys)],
            F.col("_bucket").alias("_gb"),
            F.lead(F.col("_first")).over(by_key.orderBy("_bucket")).alias("_next_from"),
            (F.col("_bucket") == winner).alias("_win"),
        )
        if n_buckets <= MAX_BROADCAST_BUCKETS:
            stitched = F.broadcast(stitched)
        on = reduce(
            lambda a, b: a & b,
            [ranked[k].eqNullSafe(F.col(f"_gk_{i}")) for i, k in enumerate(keys)],
        ) & (ranked["_bucket"] == F.col("_gb"))
        ranked = ranked.join(stitched, on, "left")
        hot = F.col("_gb").isNotNull()
        effective_to = F.when(hot & ~F.col("_has_next"), F.col("_next_from")).otherwise(F.col("_lead"))
        is_current = F.when(hot, F.col("_win") & (F.col("_rn") == 1)).otherwise(F.col("_rn") == 1)

    trailer = [c for c in HISTORY_TRAILER if c in bronze.columns]
    history = ranked.select(
        *[F.col(c) for c in payload],
        F.col(ordering).alias("effective_from"),
        effective_to.alias("effective_to"),
        is_current.alias("is_current"),
        *[F.col(c) for c in trailer],
    )
    current = current_from_history(history, delete_column, deleted_values, null_flag_is_live)
    return history, current


def live_rows(columns: Sequence[str], delete_column: str | None, deleted_values: Sequence[str],
              null_flag_is_live: bool) -> Column:
    """Whether a row is not soft-deleted (NULL where the flag does not tell)."""
    if not delete_column or delete_column not in columns:
        return F.lit(True)
    live = ~F.upper(F.col(delete_column).cast("string")).isin([str(v).upper() for v in deleted_values])
    return F.coalesce(live, F.lit(True)) if null_flag_is_live else live


def current_from_history(
    history: DataFrame,
    delete_column: str | None = None,
    deleted_values: Sequence[str] = DEFAULT_DELETED_VALUES,
    null_flag_is_live: bool = False,
) -> DataFrame:
    """Current rows of a history table, soft deletes removed.

    A delete column absent from the data is ignored.
    """
    return history.where(F.col("is_current") & live_rows(history.columns, delete_column, deleted_values, null_flag_is_live))
