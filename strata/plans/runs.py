"""One pipeline run per source: extract -> bronze -> quality -> silver -> gold.

Compared with a naive sequence of lazy frames, the batch is evaluated once:
the extract is written straight into a new bronze folder while an
``Observation`` collects its row count and maximum ordering value in the
same job, and the folder is committed only when rows arrived.  Silver tables are stored
in key-hash bucket folders, a history bucket as closed, live and open rows (see
``operators.open_rows``), and folded incrementally: a batch is windowed with
the live and open rows of its buckets, and the versions that it closes are
appended; closed folders are read and rewritten only in buckets where a row
arrived late.  The current table shares the live folders of the history, and
gold shares the current table's.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import SourceRegistration
from strata.functions.bitmaps import members, overlap, to_bitmap
from strata.functions.watermark import mark_text_col
from strata.operators.bronze import enrich_bronze
from strata.operators.open_rows import CLOSED, LIVE, late_buckets, order_number, segment_column
from strata.operators.quality import required_columns_result, rollup, row_count_result
from strata.operators.scd2 import build_scd2
from strata.operators.scope import rows_for_keys, rows_without_keys
from strata.plans.control import ControlPlane
from strata.sources.extract import extract_window, run_instant, source_frame
from strata.sources.tables import WRITE_OPTIONS, TableStore

# The one silver transform and gold publish step, by name.
SCD2_TRANSFORM = "SCD2_CURRENT_HISTORY"
PUBLISH_CURRENT = "PUBLISH_CURRENT_SNAPSHOT"

BUCKET = "_kb"
SUB_BUCKET = "_ks"
ROWS_PER_SILVER_BUCKET = 4_000_000
ROWS_PER_WINDOW_GROUP = 1_000_000
KEY_HASHES = 65_536  # range of the key hashes in a landing's bitmap (8 KB)
CLOSED_PARTS = 64  # closed folders of a bucket before they are written as one again
_BUCKET_DIR = re.compile(r"/_kb=(\d+)(?:-(\w+))?/?$")


@dataclass
class FoldResult:
    history_rows: int
    current_rows: int
    gold_rows: int
    rebuilt_rows: int


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that is filled by whichever job runs it."""
    obs = Observation(f"rows_{uuid.uuid4().hex[:12]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def align_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with exactly ``like``'s columns (missing ones NULL, typed)."""
    have = set(df.columns)
    return df.select(*[
        F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields
    ])


def _check_transform(cfg: SourceRegistration) -> None:
    if cfg.silver_transform_name.upper() != SCD2_TRANSFORM:
        raise ValueError(f"{cfg.source_name}: no silver transform is called {cfg.silver_transform_name}")
    if not cfg.silver_history_table or not cfg.silver_current_table:
        raise ValueError(f"{cfg.source_name}: a history and a current silver table are needed")


def silver_buckets(spark: SparkSession, cfg: SourceRegistration, bronze_rows: int | None, history=None) -> int:
    """Number of key-hash buckets of the silver tables.

    ``options.silver_buckets`` or ``strata.silver.buckets`` when set; else the
    count that ``history`` (the table's head) was laid out with; else, for a
    new table, a power of two giving about ``ROWS_PER_SILVER_BUCKET`` bronze
    rows per bucket.  Only a changed setting lays a table out anew.
    """
    value = cfg.options.get("silver_buckets") or spark.conf.get("strata.silver.buckets", None)
    if value:
        if int(value) < 1:
            raise ValueError(f"silver_buckets must be at least 1, not {value}")
        return int(value)
    if history is not None and history.op != "DROP" and history.lineage.get("buckets"):
        return int(history.lineage["buckets"])
    need = max(1, -(-(bronze_rows or 0) // ROWS_PER_SILVER_BUCKET))
    nb = 1
    while nb < need:
        nb *= 2
    return nb


def bucket_column(keys: list[str], buckets: int) -> Column:
    """Storage bucket of a key (NULL keys hash to a fixed bucket too)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def by_bucket(rows: DataFrame, keys: list[str], buckets: int, pieces: int) -> DataFrame:
    """History rows with their storage bucket, dealt by bucket and up to ``pieces``
    pieces of it: a replay leaves as many files as a fold, and no task writes a
    whole bucket (nor a whole key)."""
    piece = F.pmod(F.xxhash64(F.lit("piece"), *[F.col(k) for k in keys], F.col("effective_from")), F.lit(pieces))
    return rows.withColumn(BUCKET, bucket_column(keys, buckets)).repartition(F.col(BUCKET), piece)


def bucket_of(part: str) -> int | None:
    match = _BUCKET_DIR.search(part)
    return int(match.group(1)) if match else None


def segment_of(part: str) -> str | None:
    """Segment of a history folder; ``None`` when it holds rows of all."""
    match = _BUCKET_DIR.search(part)
    return match.group(2) if match else None


def write_buckets(store: TableStore, name: str, df: DataFrame, keys: list[str], buckets: int,
                  segment: Column | None = None, metrics: dict[str, Column] | None = None) -> tuple[list[str], dict]:
    """Write ``df`` split into one sub-folder per storage bucket (and segment).

    Returns the folders and what the writing job counted: ``rows`` and ``metrics``."""
    data = df if BUCKET in df.columns else df.withColumn(BUCKET, bucket_column(keys, buckets))
    obs = Observation(f"rows_{uuid.uuid4().hex[:12]}")
    counted = data.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (metrics or {}).items()])
    if segment is not None:
        counted = counted.withColumn(BUCKET, F.concat_ws("-", BUCKET, segment))
    folder = store.new_folder(name)
    counted.write.options(**WRITE_OPTIONS).partitionBy(BUCKET).parquet(folder)
    return store.subfolders(folder), obs.get


def _split_parts(head, touched: set[int] | None, buckets: int) -> tuple[list[str], list[str]]:
    """(folders to rewrite, folders to carry over).  Everything is rewritten
    when the table was laid out with another bucket count (or restored from
    a version without one); folders without a bucket are always rewritten."""
    parts = list(head.parts)
    if touched is None or head.lineage.get("buckets") != buckets:
        return parts, []
    hit = [p for p in parts if bucket_of(p) is None or bucket_of(p) in touched]
    return hit, [p for p in parts if p not in set(hit)]


def _total(store: TableStore, name: str, head, dropped_parts: list[str], added: int) -> int:
    """Row count of a new version = old count - rows of rewritten folders + new rows."""
    if head is None or head.op == "DROP":
        return added
    if not dropped_parts:
        return (head.row_count if head.row_count is not None else store.read(name).count()) + added
    old = head.row_count if head.row_count is not None else store.read(name).count()
    return old - store.read_parts(head.schema, dropped_parts).count() + added


def key_names(schema: T.StructType, keys: list[str]) -> list[str]:
    """Keys with their types: a key's hash, and so its bucket, depends on both."""
    kinds = {f.name.lower(): f.dataType.simpleString() for f in schema}
    return [f"{k} {kinds.get(k.lower(), '')}" for k in keys]


def fold_settings(cfg: SourceRegistration, schema: T.StructType) -> dict:
    """Everything the silver tables depend on besides the bronze rows; an
    incremental fold is only valid when these are unchanged."""
    return {
        "keys": key_names(schema, cfg.primary_keys),
        "ordering": cfg.ordering_column,
        "delete_column": cfg.delete_indicator_column,
        "deleted_values": list(cfg.deleted_values),
        "null_flag_is_live": bool(cfg.options.get("null_flag_is_live", False)),
    }


def _segment(cfg: SourceRegistration, columns: list[str]) -> Column:
    return segment_column(columns, cfg.delete_indicator_column, cfg.deleted_values,
                          bool(cfg.options.get("null_flag_is_live", False)))


def fold_silver(
    store: TableStore,
    cfg: SourceRegistration,
    scope: DataFrame,
    touched: set[int] | None = None,
    keys_df: DataFrame | None = None,
    null_safe: bool = False,
    lineage: dict | None = None,
    row_count_hint: int | None = None,
    keep_parts: frozenset[str] = frozenset(),
    history_rows: int | None = None,
) -> FoldResult:
    """Re-window ``scope`` into the silver tables, bucket by bucket.

    ``touched`` None rebuilds both tables from ``scope``.  Otherwise only the
    listed storage buckets are rewritten and every other bucket folder is
    carried into the new version unchanged, and so are ``keep_parts`` (closed
    rows that the batch cannot change).  With ``keys_df`` (a partial replay)
    rows of the touched buckets whose key is not in ``keys_df`` are kept as
    they were; without it ``scope`` must hold every other row of the touched
    buckets.  ``history_rows`` is the new row count where it is known
    beforehand.  Gold is then published from the current table.
    """
    _check_transform(cfg)
    keys = cfg.primary_keys
    if not keys:
        raise ValueError(f"{cfg.source_name}: versions need primary keys")
    spark = scope.sparkSession
    nb = silver_buckets(spark, cfg, row_count_hint, store.head(cfg.silver_history_table))
    # Window groups of about ROWS_PER_WINDOW_GROUP rows: each storage bucket
    # is split further by a second key hash, so window tasks stay bounded and
    # a table smaller than one bucket still uses several tasks.
    subs = max(1, -(-(row_count_hint or 0) // (nb * ROWS_PER_WINDOW_GROUP)))
    history, _ = build_scd2(
        scope.withColumn(BUCKET, bucket_column(keys, nb))
        .withColumn(SUB_BUCKET, F.pmod(F.xxhash64(F.lit("sub"), *[F.col(k) for k in keys]), F.lit(subs))),
        keys,
        cfg.ordering_column,
        delete_column=cfg.delete_indicator_column,
        deleted_values=cfg.deleted_values,
        null_flag_is_live=bool(cfg.options.get("null_flag_is_live", False)),
        row_count_hint=row_count_hint,
        cluster_by=[BUCKET, SUB_BUCKET],
    )
    history, rebuilt_obs = observed(history.drop(SUB_BUCKET))
    hist_schema = history.drop(BUCKET).schema
    hist_name, cur_name = cfg.silver_history_table, cfg.silver_current_table
    note = {**(lineage or {}), "buckets": nb, "settings": fold_settings(cfg, scope.schema)}

    # history: rewrite touched buckets, carry the rest
    hist_head = store.head(hist_name) if touched is not None else None
    live = hist_head is not None and hist_head.op != "DROP"
    rewrite, carry = _split_parts(hist_head, touched, nb) if live else ([], [])
    carry, rewrite = carry + [p for p in rewrite if p in keep_parts], [p for p in rewrite if p not in keep_parts]
    frame = history
    if keys_df is not None and rewrite:
        kept = rows_without_keys(store.read_parts(hist_head.schema, rewrite), keys_df, keys, null_safe)
        frame = align_columns(kept, history.drop(BUCKET)).unionByName(history.drop(BUCKET))
        frame = by_bucket(frame, keys, nb, subs)
    segment = _segment(cfg, hist_schema.fieldNames())
    metrics = {"live": F.count_if(segment == LIVE), "gaps": F.count_if(F.col("effective_from").isNull())}
    number = order_number("effective_from", hist_schema["effective_from"].dataType)
    if number is not None:
        metrics["top"] = F.max(number)
    new_parts, written = write_buckets(store, hist_name, frame, keys, nb, segment, metrics)
    rebuilt_rows = int(rebuilt_obs.get["rows"])
    note["top"], note["gaps"] = written.get("top"), written["gaps"]
    if carry:
        before = hist_head.lineage
        known = before.get("top") is not None and note["top"] is not None and before.get("gaps") is not None
        note["top"] = max(before["top"], note["top"]) if known else None
        note["gaps"] = before["gaps"] + note["gaps"] if known else None
    if history_rows is None:
        history_rows = _total(store, hist_name, hist_head if live else None, rewrite, int(written["rows"]))
    store.replace_parts(hist_name, carry + new_parts, hist_schema, history_rows, note)

    # current: the live folders of the history; a partial replay keeps other keys' rows as the table has them
    cur_head = store.head(cur_name) if touched is not None else None
    cur_live = cur_head is not None and cur_head.op != "DROP"
    cur_rewrite, cur_carry = _split_parts(cur_head, touched, nb) if cur_live else ([], [])
    cur_parts, cur_written = [p for p in new_parts if segment_of(p) == LIVE], int(written["live"])
    if keys_df is not None and cur_rewrite:
        rebuilt_current = rows_for_keys(store.read_parts(hist_schema, cur_parts), keys_df, keys, null_safe)
        kept_current = rows_without_keys(store.read_parts(cur_head.schema, cur_rewrite), keys_df, keys, null_safe)
        fresh = align_columns(kept_current, rebuilt_current).unionByName(rebuilt_current)
        cur_parts, counted = write_buckets(store, cur_name, by_bucket(fresh, keys, nb, subs), keys, nb)
        cur_written = int(counted["rows"])
    current_rows = _total(store, cur_name, cur_head if cur_live else None, cur_rewrite, cur_written)
    store.replace_parts(cur_name, cur_carry + cur_parts, hist_schema, current_rows, note)

    gold_rows = 0
    if cfg.gold_publish_name.upper() == PUBLISH_CURRENT and cfg.gold_table:
        store.share(cur_name, cfg.gold_table)
        gold_rows = current_rows
    return FoldResult(history_rows, current_rows, gold_rows, rebuilt_rows)


def _only_later(store: TableStore, bronze: str, seen: int, latest: int, history: dict) -> bool:
    """Whether every row landed after version ``seen`` lies beyond all of the
    history, as the landings and the fold recorded: no key can be late then."""
    if history.get("top") is None or history.get("gaps") != 0:
        return False
    for version in range(seen + 1, latest + 1):
        head = store.head(bronze, version)
        first = None if head is None else head.lineage.get("order_first")
        if first is None or head.lineage.get("order_gaps") != 0 or first <= history["top"]:
            return False
    return True


def _kept_parts(store: TableStore, cfg: SourceRegistration, hist_head, like: T.StructType, new_rows: DataFrame, touched: set[int],
                buckets: int, only_later: bool) -> frozenset[str]:
    """Closed folders of the touched buckets that the new rows leave alone."""
    parts = [p for p in hist_head.parts if bucket_of(p) in touched]
    closed = Counter(bucket_of(p) for p in parts if segment_of(p) == CLOSED)
    # folders of all segments together, or too many closed ones: written anew
    anew = {bucket_of(p) for p in parts if segment_of(p) is None} | {b for b, n in closed.items() if n >= CLOSED_PARTS}
    clean = touched - anew
    if clean and not only_later:
        open_rows = store.read_parts(T.StructType([*like.fields, hist_head.schema["is_current"]]), [p for p in parts if bucket_of(p) in clean and segment_of(p) != CLOSED])
        late = late_buckets(open_rows, new_rows, cfg.primary_keys, cfg.ordering_column, bucket_column(cfg.primary_keys, buckets))
        clean -= {int(r[0]) for r in late.collect()}  # at most one row a bucket
    return frozenset(p for p in parts if segment_of(p) == CLOSED and bucket_of(p) in clean)


def key_bitmaps(store: TableStore, bronze: str, first: int, last: int, names: list[str]) -> dict[int, str]:
    """Key-hash bitmap of each landing from version ``first`` to ``last``;
    versions that did not record one (or hashed other columns or types) are left out."""
    out = {}
    for version in range(first, last + 1):
        head = store.head(bronze, version)
        if head is not None and head.lineage.get("key_bitmap") and head.lineage.get("hash_keys") == names:
            out[version] = head.lineage["key_bitmap"]
    return out


def _recorded_buckets(store: TableStore, bronze: str, seen: int, latest: int, buckets: int,
                      names: list[str]) -> set[int] | None:
    """Touched buckets from the bitmaps of the landings after version ``seen``;
    ``None`` when a landing has none or the bucket count does not divide the
    hash range (the new rows are read for their buckets then)."""
    if KEY_HASHES % buckets:
        return None
    maps = key_bitmaps(store, bronze, seen + 1, latest, names)
    if len(maps) < latest - seen:
        return None
    return {h % buckets for bitmap in maps.values() for h in members(bitmap)}


def folders_with_keys(store: TableStore, head, bronze: str, keys: list[str], hashes: list[int]) -> list[str]:
    """The folders of bronze version ``head`` that may hold a key with one of
    ``hashes``: all but those whose landing recorded none of them."""
    wanted = to_bitmap(hashes, KEY_HASHES)
    skipped = set()
    for version, bitmap in key_bitmaps(store, bronze, 1, head.version, key_names(head.schema, keys)).items():
        if not overlap(bitmap, wanted):
            skipped.add(store.head(bronze, version).parts[-1])  # a landing adds one folder
    return [p for p in head.parts if p not in skipped]


def folded_version(store: TableStore, cfg: SourceRegistration) -> int | None:
    """The bronze version that the silver history was built from."""
    head = store.head(cfg.silver_history_table) if cfg.silver_history_table else None
    return None if head is None or head.op == "DROP" else head.lineage.get("bronze_version")


def fold_new_batches(store: TableStore, cfg: SourceRegistration, bronze_head=None) -> FoldResult:
    """Fold bronze into silver.

    Incremental (default, ``options.fold_mode``): the storage buckets of the
    keys in bronze folders added since the bronze version the history was
    built from are re-windowed from their live and open rows plus the new
    bronze rows, and versions that close are appended; a bucket with a late
    row is re-windowed from all its rows.  Everything else is carried over
    and bronze is not re-read.  Equal to a full rebuild because SCD2 is
    computed per key, each history row stands for one bronze row, and a
    closed row stays as it is while rows only follow it.  Falls back to a full
    rebuild without such lineage (first build, after a restore, bucket count
    changed) or when bronze was rewritten.
    """
    _check_transform(cfg)
    spark = store.spark
    bronze_head = bronze_head or store.head(cfg.bronze_table)  # one version for the whole fold
    lineage = {"bronze_version": bronze_head.version}
    hist_head = store.head(cfg.silver_history_table)
    nb = silver_buckets(spark, cfg, bronze_head.row_count, hist_head)
    cur_head = store.head(cfg.silver_current_table)
    if (
        cfg.fold_mode == "incremental"
        and hist_head is not None
        and hist_head.op != "DROP"
        and "bronze_version" in hist_head.lineage
        and hist_head.lineage.get("buckets") == nb
        and cur_head is not None
        and cur_head.op != "DROP"
        # both tables must come from the same fold (a fold that failed
        # between the two commits, or a restore of one table, forces a rebuild)
        and cur_head.lineage.get("bronze_version") == hist_head.lineage["bronze_version"]
        and cur_head.lineage.get("buckets") == nb
        # a re-registration with other keys, ordering or delete rules rebuilds
        and hist_head.lineage.get("settings") == fold_settings(cfg, bronze_head.schema)
        and cur_head.lineage.get("settings") == fold_settings(cfg, bronze_head.schema)
    ):
        seen = store.head(cfg.bronze_table, hist_head.lineage["bronze_version"])
        if seen is not None and set(seen.parts) <= set(bronze_head.parts):
            fresh = [p for p in bronze_head.parts if p not in set(seen.parts)]
            new_rows = store.read_parts(bronze_head.schema, fresh)
            touched = _recorded_buckets(store, cfg.bronze_table, seen.version, bronze_head.version, nb,
                                        key_names(bronze_head.schema, cfg.primary_keys))
            if touched is None:  # not recorded at landing: one pass over the new rows
                touched = {
                    int(r[0]) for r in new_rows.select(bucket_column(cfg.primary_keys, nb)).distinct().collect()
                }  # at most ``nb`` values
            # bronze's present schema: silver folders of earlier, narrower versions are read under it
            like = T.StructType([f for f in bronze_head.schema if f.name not in ("source_name", "load_mode")])
            keep = _kept_parts(store, cfg, hist_head, like, new_rows, touched, nb,
                               _only_later(store, cfg.bronze_table, seen.version, bronze_head.version, hist_head.lineage))
            rewrite = [p for p in _split_parts(hist_head, touched, nb)[0] if p not in keep]
            scope = store.read_parts(like, rewrite).unionByName(new_rows.select(*like.fieldNames()))
            counts = (hist_head.row_count, bronze_head.row_count, seen.row_count)
            total = None if None in counts else counts[0] + counts[1] - counts[2]  # every landed row is one history row
            return fold_silver(store, cfg, scope, touched=touched, lineage=lineage,
                               row_count_hint=bronze_head.row_count, keep_parts=keep, history_rows=total)
    return fold_silver(store, cfg, store.read(cfg.bronze_table, bronze_head.version), lineage=lineage,
                       row_count_hint=bronze_head.row_count)


def landed_before(store: TableStore, bronze: str, tag: str | None) -> dict | None:
    """The landing that bronze holds under ``tag``, looked up from the newest
    version back (a stream only ever repeats its last batch)."""
    head = store.head(bronze) if tag else None
    version = head.version if head is not None and head.op != "DROP" else 0
    while version > 0:
        entry = store.head(bronze, version)
        if entry is None or entry.op == "DROP":
            return None
        found = entry.lineage.get("tag")
        if found == tag:
            return entry.lineage
        if found and found.rpartition(":")[0] == tag.rpartition(":")[0]:
            return None  # an older batch of the same stream
        version -= 1
    return None


def run_source(
    spark: SparkSession,
    control: ControlPlane,
    source_name: str,
    forced_batch_id: int | None = None,
    requested_by: str = "runtime",
    as_of: str | None = None,
    extract: DataFrame | None = None,
    landing_tag: str | None = None,
) -> int:
    """Run one registered source end to end; returns the batch id.

    ``as_of`` fixes the run instant (upper bound and load timestamp) as
    session-zone text; by default it is read from the session once.
    ``extract`` replaces the registry-driven read (a streaming micro-batch);
    with ``landing_tag`` a batch that bronze already holds under that tag is
    not landed again, only checked, folded and logged.
    """
    store = control.store
    cfg = control.get_registration(source_name)
    run_mode = f"PIPELINE_{cfg.load_mode}"
    batch_id = control.create_batch_run(source_name, run_mode, requested_by, forced_batch_id=forced_batch_id)
    try:
        instant = as_of or run_instant(spark)
        if extract is None:
            source = source_frame(spark, cfg, store)
            extract = extract_window(source, cfg, cfg.last_successful_watermark, instant)
        landed = enrich_bronze(extract, cfg.source_name, batch_id, cfg.load_mode, F.lit(instant).cast("timestamp"))

        metrics = [F.count(F.lit(1)).alias("rows")]
        ordering = cfg.ordering_column
        if ordering and ordering in extract.columns:
            metrics.append(mark_text_col(F.max(F.col(ordering)), extract.schema[ordering].dataType).alias("mark"))
            metrics.append(F.count_if(F.col(ordering).isNull()).alias("order_gaps"))
            number = order_number(ordering, extract.schema[ordering].dataType)
            if number is not None:
                metrics.append(F.min(number).alias("order_first"))
        if cfg.primary_keys and all(k in landed.columns for k in cfg.primary_keys):
            # at most KEY_HASHES distinct values: the fold's touched buckets, and what a replay can skip
            metrics.append(F.collect_set(bucket_column(cfg.primary_keys, KEY_HASHES)).alias("hashes"))
        earlier = landed_before(store, cfg.bronze_table, landing_tag)
        if earlier is None:
            obs = Observation(f"land_{uuid.uuid4().hex[:12]}")
            folder = store.new_folder(cfg.bronze_table)
            landed.observe(obs, *metrics).write.options(**WRITE_OPTIONS).parquet(folder)
            seen = obs.get
        else:
            seen = {"rows": earlier["rows"], "mark": earlier["mark"]}
        rows = int(seen["rows"])
        mark = seen.get("mark")

        if rows == 0:
            control.finalize_batch_run(
                batch_id, source_name, "SUCCESS", quality_status="NO_DATA",
                watermark_value=cfg.last_successful_watermark,
            )
            return batch_id

        if earlier is None:
            note = {"batch_id": batch_id, "tag": landing_tag, "rows": rows, "mark": mark}
            if seen.get("hashes") is not None:
                note["key_bitmap"] = to_bitmap(seen["hashes"], KEY_HASHES)
                note["hash_keys"] = key_names(landed.schema, cfg.primary_keys)
            note.update({k: seen[k] for k in ("order_first", "order_gaps") if seen.get(k) is not None})
            store.append_folder(cfg.bronze_table, folder, landed.schema, rows, lineage=note)
        results = [row_count_result(rows), required_columns_result(landed.columns, cfg.required_columns)]
        control.insert_quality_results(batch_id, source_name, results)
        quality = rollup(results)
        if quality == "FAILED":
            raise ValueError(f"Quality checks failed for source {source_name}.")

        fold = fold_new_batches(store, cfg)
        control.update_source_watermark(source_name, batch_id, mark)
        control.finalize_batch_run(
            batch_id, source_name, "SUCCESS",
            rows_read=rows, bronze_rows_written=rows,
            silver_rows_written=fold.current_rows + fold.history_rows,
            gold_rows_written=fold.gold_rows,
            quality_status=quality, watermark_value=mark,
        )
        return batch_id
    except Exception as exc:
        control.finalize_batch_run(batch_id, source_name, "FAILED", error_message=str(exc))
        raise


def run_all_sources(
    spark: SparkSession,
    control: ControlPlane,
    source: str | None = None,
    forced_batch_id: int | None = None,
    requested_by: str = "runtime",
    as_of: str | None = None,
    parallelism: int = 1,
) -> list[int]:
    """Run one source, or every enabled source in name order.

    ``parallelism`` 1 runs them one after another and stops at the first
    failure.  Above 1, sources run concurrently from a thread pool (Spark
    schedules their jobs side by side; control-table commits are
    optimistic): batch ids are allocated up front, every source runs, and
    the first failure in name order is raised at the end.
    """
    sources = [source] if source else control.list_active_sources()
    if not sources:
        raise ValueError(f"No active sources were found in {control.registry}.")
    if parallelism <= 1 or len(sources) == 1:
        return [run_source(spark, control, s, forced_batch_id, requested_by, as_of) for s in sources]

    from concurrent.futures import ThreadPoolExecutor

    first = forced_batch_id or control.next_batch_id()
    ids = [forced_batch_id or first + i for i in range(len(sources))]

    def run(name: str, batch_id: int) -> int:
        # a pool of its own: with the FAIR scheduler no source waits for another one's jobs
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return run_source(spark, control, name, batch_id, requested_by, as_of)

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        futures = [pool.submit(run, s, batch_id) for s, batch_id in zip(sources, ids)]
    results, errors = [], []
    for future in futures:
        try:
            results.append(future.result())
        except Exception as exc:  # collected; raised after every source ran
            errors.append(exc)
    if errors:
        raise errors[0]
    return results
