"""Control tables: source registry, run log, quality results, replay requests.

Each is a small versioned table.  Inserts append a folder; keyed updates and
upserts rewrite the table as a new version (DataFrame ``when/otherwise`` and
full-outer-join merge), since parquet has no row-level DML.  All values are
passed as typed DataFrame rows, never spliced into SQL text.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import DEFAULT_PUBLISH, DEFAULT_TRANSFORM, ReplayRequest, SourceRegistration, from_row
from strata.functions.options import normalize_list_col, options_col
from strata.operators.merge import keyed_update, upsert
from strata.operators.quality import RuleResult
from strata.sources.tables import COMMIT_ATTEMPTS, CommitConflict, TableStore

CATALOG_DEFAULT = "demo"
# The layer namespaces of a catalog.
NAMESPACES = ("ctl", "staging", "bronze", "silver", "gold")

REGISTRATION_SCHEMA = T.StructType(
    [
        T.StructField("source_name", T.StringType()),
        T.StructField("domain_name", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("source_object", T.StringType()),
        T.StructField("enabled", T.BooleanType()),
        T.StructField("load_mode", T.StringType()),
        T.StructField("base_extract_sql", T.StringType()),
        T.StructField("watermark_column", T.StringType()),
        T.StructField("watermark_type", T.StringType()),
        T.StructField("primary_keys", T.ArrayType(T.StringType())),
        T.StructField("sequence_column", T.StringType()),
        T.StructField("delete_indicator_column", T.StringType()),
        T.StructField("bronze_table", T.StringType()),
        T.StructField("silver_current_table", T.StringType()),
        T.StructField("silver_history_table", T.StringType()),
        T.StructField("gold_table", T.StringType()),
        T.StructField("silver_transform_name", T.StringType()),
        T.StructField("gold_publish_name", T.StringType()),
        T.StructField("quality_rule_set", T.StringType()),
        T.StructField("replay_mode_default", T.StringType()),
        T.StructField("options_json", T.StringType()),
        T.StructField("last_successful_watermark", T.StringType()),
        T.StructField("last_batch_id", T.LongType()),
        T.StructField("created_ts", T.TimestampType()),
        T.StructField("updated_ts", T.TimestampType()),
    ]
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("run_mode", T.StringType()),
        T.StructField("run_status", T.StringType()),
        T.StructField("requested_by", T.StringType()),
        T.StructField("replay_request_id", T.LongType()),
        T.StructField("run_start_ts", T.TimestampType()),
        T.StructField("run_end_ts", T.TimestampType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("bronze_rows_written", T.LongType()),
        T.StructField("silver_rows_written", T.LongType()),
        T.StructField("gold_rows_written", T.LongType()),
        T.StructField("quality_status", T.StringType()),
        T.StructField("watermark_value", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

QUALITY_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("rule_status", T.StringType()),
        T.StructField("observed_value", T.StringType()),
        T.StructField("expected_value", T.StringType()),
        T.StructField("details", T.StringType()),
        T.StructField("evaluated_ts", T.TimestampType()),
    ]
)

REPLAY_SCHEMA = T.StructType(
    [
        T.StructField("replay_request_id", T.LongType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("replay_mode", T.StringType()),
        T.StructField("start_watermark", T.StringType()),
        T.StructField("end_watermark", T.StringType()),
        T.StructField("entity_predicate", T.StringType()),
        T.StructField("snapshot_id", T.LongType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("requested_by", T.StringType()),
        T.StructField("request_status", T.StringType()),
        T.StructField("requested_ts", T.TimestampType()),
        T.StructField("started_ts", T.TimestampType()),
        T.StructField("completed_ts", T.TimestampType()),
        T.StructField("notes", T.StringType()),
    ]
)

# Registry columns a re-registration overwrites; the others (mark, last batch,
# created_ts) are kept from the existing row.
REGISTRATION_CONFIG_COLUMNS = [
    "domain_name", "source_type", "source_object", "enabled", "load_mode", "base_extract_sql",
    "watermark_column", "watermark_type", "primary_keys", "sequence_column", "delete_indicator_column",
    "bronze_table", "silver_current_table", "silver_history_table", "gold_table", "silver_transform_name",
    "gold_publish_name", "quality_rule_set", "replay_mode_default", "options_json", "updated_ts",
]


def next_id(df: DataFrame, column: str, alias: str = "next_batch_id") -> DataFrame:
    """``COALESCE(MAX(column), 0) + 1`` as a one-row frame."""
    return df.agg((F.coalesce(F.max(F.col(column)), F.lit(0)) + F.lit(1)).cast("bigint").alias(alias))


def normalize_registrations(df: DataFrame) -> DataFrame:
    """Apply the registry defaults column-wise over a whole registry frame.

    Blank load mode -> FULL (upper-cased), ``primary_keys`` (array or csv
    text) -> array without blank items, blank transform/publish names ->
    defaults, ``options_json`` -> ``options`` struct (NULL when malformed).
    """
    out = df
    if "load_mode" in df.columns:
        lm = F.col("load_mode")
        out = out.withColumn(
            "load_mode", F.when(lm.isNull() | (lm == ""), F.lit("FULL")).otherwise(F.upper(lm))
        )
    if "primary_keys" in df.columns:
        is_array = isinstance(df.schema["primary_keys"].dataType, T.ArrayType)
        out = out.withColumn("primary_keys", normalize_list_col(F.col("primary_keys"), is_array))
    for name, default in (("silver_transform_name", DEFAULT_TRANSFORM), ("gold_publish_name", DEFAULT_PUBLISH)):
        if name in df.columns:
            c = F.col(name)
            out = out.withColumn(name, F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c))
    if "options_json" in df.columns:
        out = out.withColumn("options", options_col(F.col("options_json")))
    return out


def normalize_requests(df: DataFrame) -> DataFrame:
    """Replay requests with upper-cased mode and status (blank ones NULL)."""
    return df.withColumns({c: F.upper(F.nullif(F.col(c), F.lit(""))) for c in ("replay_mode", "request_status")})


def status_assignments(status: str, now: Column) -> dict[str, Column]:
    """Columns set by a replay-request status change: the status itself,
    ``started_ts`` when RUNNING, ``completed_ts`` when COMPLETED or FAILED."""
    out = {"request_status": F.lit(status)}
    if status == "RUNNING":
        out["started_ts"] = now
    if status in ("COMPLETED", "FAILED"):
        out["completed_ts"] = now
    return out


class ControlPlane:
    """The four control tables of one catalog inside a :class:`TableStore`."""

    def __init__(self, store: TableStore, catalog: str = CATALOG_DEFAULT):
        self.store = store
        self.spark: SparkSession = store.spark
        self.catalog = catalog

    def table(self, name: str) -> str:
        return f"{self.catalog}.ctl.{name}"

    @property
    def registry(self) -> str:
        return self.table("source_registration")

    @property
    def runs(self) -> str:
        return self.table("pipeline_run")

    @property
    def quality(self) -> str:
        return self.table("quality_result")

    @property
    def replays(self) -> str:
        return self.table("replay_request")

    # --------------------------------------------------------------- bootstrap
    def ensure_namespaces(self) -> None:
        """Create the layer namespaces of the catalog when absent."""
        for ns in NAMESPACES:
            self.store.create_namespace(f"{self.catalog}.{ns}")

    def bootstrap(self) -> None:
        """Create the namespaces and the empty control tables when absent."""
        self.ensure_namespaces()
        for name, schema in (
            (self.registry, REGISTRATION_SCHEMA),
            (self.runs, RUN_SCHEMA),
            (self.quality, QUALITY_SCHEMA),
            (self.replays, REPLAY_SCHEMA),
        ):
            self.store.create_empty(name, schema)

    def reset(self, extra_tables: Iterable[str] = ()) -> None:
        """Drop the control tables and any listed tables (if present)."""
        for name in [*extra_tables, self.registry, self.runs, self.quality, self.replays]:
            self.store.drop(name, if_exists=True)

    COMPACT_AFTER_PARTS = 32

    def _rewrite(self, table: str, change) -> None:
        """Read-modify-write of a control table with optimistic concurrency:
        ``change(current_rows)`` is recomputed from the latest version when
        another writer committed in between."""
        for _ in range(COMMIT_ATTEMPTS):
            head = self.store.head(table)
            try:
                self.store.replace(table, change(self.store.read(table)), expected_version=head.version)
                return
            except CommitConflict:
                continue
        raise CommitConflict(f"{table}: gave up after {COMMIT_ATTEMPTS} concurrent updates")

    def _insert(self, table: str, rows: DataFrame, n: int) -> None:
        """Append control rows; once a table has many small folders, fold
        them into one on the next insert."""
        head = self.store.head(table)
        if head is not None and head.op != "DROP" and len(head.parts) >= self.COMPACT_AFTER_PARTS:
            self._rewrite(table, lambda current: current.unionByName(rows))
        else:
            self.store.append(table, rows, row_count=n)

    # ---------------------------------------------------------------- registry
    def register_from(self, rows: DataFrame) -> None:
        """``register`` for rows that Spark derives; columns that ``rows`` lacks are NULL."""
        now = F.current_timestamp()
        have = {**{c: F.col(c) for c in rows.columns}, "updated_ts": now}
        have["created_ts"] = F.coalesce(have.get("created_ts", F.lit(None)), now)
        have["enabled"] = F.coalesce(have.get("enabled", F.lit(None)), F.lit(True))
        source = rows.select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in REGISTRATION_SCHEMA.fields])
        self._rewrite(self.registry, lambda target: upsert(target, source, ["source_name"], REGISTRATION_CONFIG_COLUMNS))

    def register(self, rows: Sequence[dict]) -> None:
        """Upsert registrations by ``source_name``.  A new source is inserted
        whole; a known one gets its configuration columns replaced while its
        mark, last batch id and ``created_ts`` are kept."""
        now = datetime.now()
        records = []
        for row in rows:
            rec = {f.name: row.get(f.name) for f in REGISTRATION_SCHEMA.fields}
            rec["created_ts"] = rec["created_ts"] or now
            rec["updated_ts"] = now
            if rec["enabled"] is None:
                rec["enabled"] = True
            records.append(tuple(rec[f.name] for f in REGISTRATION_SCHEMA.fields))
        source = self.spark.createDataFrame(records, REGISTRATION_SCHEMA)
        head = self.store.head(self.registry)
        if head is not None and head.op != "DROP" and head.row_count == 0 and \
                len({r[0] for r in records}) == len(records):
            self.store.append(self.registry, source, row_count=len(records))  # nothing to match yet
            return
        self._rewrite(self.registry, lambda target: upsert(target, source, ["source_name"], REGISTRATION_CONFIG_COLUMNS))

    def registrations(self) -> DataFrame:
        return self.store.read(self.registry)

    def get_registration(self, source_name: str) -> SourceRegistration:
        rows = (
            normalize_registrations(self.registrations())
            .where((F.col("source_name") == F.lit(source_name)) & F.col("enabled"))
            .limit(1)
            .collect()
        )
        if not rows:
            raise ValueError(f"No active source registration found for {source_name}.")
        return from_row(SourceRegistration, rows[0])

    def active_sources(self) -> DataFrame:
        """Names of the enabled sources, in the order runs take them."""
        return self.registrations().where(F.col("enabled")).select("source_name").orderBy("source_name")

    def list_active_sources(self) -> list[str]:
        return [str(r["source_name"]) for r in self.active_sources().collect()]

    def update_source_watermark(self, source_name: str, batch_id: int, watermark: str | None) -> None:
        self._rewrite(self.registry, lambda reg: keyed_update(
            reg,
            F.col("source_name") == F.lit(source_name),
            {
                "last_successful_watermark": F.lit(watermark).cast("string"),
                "last_batch_id": F.lit(int(batch_id)).cast("bigint"),
                "updated_ts": F.current_timestamp(),
            },
        ))

    # ----------------------------------------------------------------- run log
    def next_batch_id(self) -> int:
        return int(next_id(self.store.read(self.runs), "batch_id").first()["next_batch_id"])

    def create_batch_run(
        self,
        source_name: str,
        run_mode: str,
        requested_by: str,
        replay_request_id: int | None = None,
        forced_batch_id: int | None = None,
    ) -> int:
        """Insert a RUNNING row; the id is forced (0 counts as absent) or max+1."""
        batch_id = forced_batch_id or self.next_batch_id()
        row = (int(batch_id), source_name, run_mode, "RUNNING", requested_by, replay_request_id,
               None, None, None, None, None, None, None, None, None)
        df = self.spark.createDataFrame([row], RUN_SCHEMA).withColumn("run_start_ts", F.current_timestamp())
        self._insert(self.runs, df, 1)
        return int(batch_id)

    def finalize_batch_run(
        self,
        batch_id: int,
        source_name: str,
        status: str,
        rows_read: int = 0,
        bronze_rows_written: int = 0,
        silver_rows_written: int = 0,
        gold_rows_written: int = 0,
        quality_status: str | None = None,
        watermark_value: str | None = None,
        error_message: str | None = None,
    ) -> None:
        self._rewrite(self.runs, lambda runs: keyed_update(
            runs,
            (F.col("batch_id") == F.lit(int(batch_id))) & (F.col("source_name") == F.lit(source_name)),
            {
                "run_status": F.lit(status),
                "run_end_ts": F.current_timestamp(),
                "rows_read": F.lit(int(rows_read)),
                "bronze_rows_written": F.lit(int(bronze_rows_written)),
                "silver_rows_written": F.lit(int(silver_rows_written)),
                "gold_rows_written": F.lit(int(gold_rows_written)),
                "quality_status": F.lit(quality_status).cast("string"),
                "watermark_value": F.lit(watermark_value).cast("string"),
                "error_message": F.lit(error_message).cast("string"),
            },
        ))

    def run_log(self) -> DataFrame:
        return self.store.read(self.runs)

    # ----------------------------------------------------------------- quality
    def insert_quality_results(self, batch_id: int, source_name: str, results: Sequence[RuleResult]) -> None:
        rows = [(int(batch_id), source_name, *r.as_tuple(), None) for r in results]
        df = self.spark.createDataFrame(rows, QUALITY_SCHEMA).withColumn("evaluated_ts", F.current_timestamp())
        self._insert(self.quality, df, len(rows))

    def quality_results(self) -> DataFrame:
        return self.store.read(self.quality)

    # ----------------------------------------------------------------- replays
    def submit_replay(
        self,
        replay_request_id: int,
        source_name: str,
        replay_mode: str = "FULL_REBUILD",
        start_watermark: str | None = None,
        end_watermark: str | None = None,
        entity_predicate: str | None = None,
        snapshot_id: int | None = None,
        target_table: str | None = None,
        requested_by: str | None = None,
        notes: str | None = None,
    ) -> None:
        row = (int(replay_request_id), source_name, replay_mode, start_watermark, end_watermark, entity_predicate,
               snapshot_id, target_table, requested_by, "REQUESTED", None, None, None, notes)
        df = self.spark.createDataFrame([row], REPLAY_SCHEMA).withColumn("requested_ts", F.current_timestamp())
        self._insert(self.replays, df, 1)

    def submit_replays(self, rows: DataFrame) -> None:
        """Requests that Spark derives, as one append; columns that ``rows`` lacks are NULL."""
        have = {**{c: F.col(c) for c in rows.columns}, "request_status": F.lit("REQUESTED"), "requested_ts": F.current_timestamp()}
        stored = self.store.read(self.replays).schema
        self.store.append(self.replays, rows.select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in stored.fields]))

    def get_replay_request(self, replay_request_id: int) -> ReplayRequest:
        rows = (
            normalize_requests(self.store.read(self.replays))
            .where(F.col("replay_request_id") == F.lit(int(replay_request_id)))
            .limit(1)
            .collect()
        )
        if not rows:
            raise ValueError(f"Replay request {replay_request_id} was not found.")
        return from_row(ReplayRequest, rows[0])

    def requested_replays(self) -> DataFrame:
        """Ids of the open requests, in the order the runner takes them."""
        return (self.store.read(self.replays).where(F.upper(F.col("request_status")) == F.lit("REQUESTED"))
                .select("replay_request_id").orderBy("replay_request_id"))

    def list_requested_replays(self) -> list[int]:
        return [int(r["replay_request_id"]) for r in self.requested_replays().collect()]

    def mark_replay_requests(self, condition: Column, status: str) -> None:
        self._rewrite(self.replays, lambda df: keyed_update(df, condition, status_assignments(status, F.current_timestamp())))

    def mark_replay_request(self, replay_request_id: int, status: str) -> None:
        self.mark_replay_requests(F.col("replay_request_id") == F.lit(int(replay_request_id)), status)

    def replay_requests(self) -> DataFrame:
        return self.store.read(self.replays)
