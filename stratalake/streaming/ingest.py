"""Raw events to the standardised table, file by file as they arrive.

The stream's checkpoint remembers which files were read; this is the incremental
counterpart of a batch publish and writes the same kind of table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import plain_path
from ..operators.lineage import Run
from ..operators.quality import breaks_any, broken_rules
from ..plans.events import publish_events, standardize_events
from ..plans.rules import EVENT_RULES
from ..schemas import RAW_EVENTS
from ..session import staged


def read_event_stream(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(RAW_EVENTS)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(root)
    )


def ingest_events(
    spark: SparkSession, root: str, target: str, rejected: str, checkpoint: str, run: Run | None = None
) -> StreamingQuery:
    """Append all new files: good rows to the table, the others to ``rejected``.

    Each micro-batch is staged once, and both parts go through the writer of the
    batch pipeline, which adds only what the table does not hold: a batch that is
    repeated after a failure changes nothing, and tables that batches have
    written go on growing. ``checkpoint`` must lie in storage all executors reach
    and stay the same from run to run.
    """
    silver = standardize_events(read_event_stream(spark, root), run or Run(), plain_path(F.col("_metadata.file_path"), encoded=True))

    def publish(batch: DataFrame, number: int) -> None:
        held = staged(batch, "stream-batch")
        publish_events(held.filter(~breaks_any(EVENT_RULES)), target)
        refused = held.filter(breaks_any(EVENT_RULES)).withColumn("broken_rules", broken_rules(EVENT_RULES))
        publish_events(refused, rejected)

    return (
        silver.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
