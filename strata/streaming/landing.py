"""Land a streaming source through the batch pipeline, one micro-batch at a time.

For file or message sources the stream's own offsets replace the high-water
mark: ``readStream`` tracks what was read, and ``foreachBatch`` hands each
micro-batch to :func:`strata.plans.runs.run_source` as the extract, so every
micro-batch is landed in bronze, checked, folded into silver and published
exactly like a scheduled run.

A micro-batch may be delivered again after a failure.  Its landing in bronze
carries the query name and epoch: a batch whose run succeeded is skipped, and one
that was landed before its run failed is not landed again but folded and logged.
One query writes a source at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.plans.control import ControlPlane
from strata.plans.runs import run_source


def epoch_tag(query_name: str, epoch_id: int) -> str:
    return f"stream:{query_name}:{epoch_id}"


def stream_source(
    spark: SparkSession,
    control: ControlPlane,
    source_name: str,
    stream: DataFrame,
    checkpoint_location: str,
    query_name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that lands ``stream`` as runs of ``source_name``.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (for example
    ``{"availableNow": True}`` or ``{"processingTime": "1 minute"}``).
    """
    name = query_name or f"land_{source_name}"

    def land(batch: DataFrame, epoch_id: int) -> None:
        tag = epoch_tag(name, epoch_id)
        done = (
            control.run_log()
            .where((F.col("source_name") == source_name) & (F.col("requested_by") == tag)
                   & (F.col("run_status") == "SUCCESS"))
            .limit(1)
            .collect()
        )
        if done:
            return
        run_source(spark, control, source_name, requested_by=tag, extract=batch, landing_tag=tag)

    writer = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint_location).foreachBatch(land)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
