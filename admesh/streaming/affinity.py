"""Event affinity (W9) kept up to date from a stream of event files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admesh.functions.columns import ratio
from admesh.operators.affinity import event_counts
from admesh.sinks.store import Store
from admesh.sources import facts
from admesh.sources.tables import SCHEMAS
from admesh.storage import RunFolder

SCHEMA = "id bigint, ad bigint, taken bigint, shown bigint"
DELAY = "30 days"


def update_affinity(spark: SparkSession, source: str, store: Store, checkpoint: str, run: RunFolder,
                    pattern: str = "*", delay: str = DELAY, files: int | None = 100) -> None:
    """Count the events of all files under ``source`` that no run with this ``checkpoint`` has counted yet.

    Files whose name fits ``pattern`` are taken ``files`` at a time, all at once if
    that is None, and the call returns when there are none left. An event that comes again (same
    ``event_id``) within ``delay`` of event time is counted once; one that comes
    later than that after the latest event of an earlier batch is dropped. State
    holds the ids seen within the delay and two counts for each user and ad.
    Each batch writes the counts that changed in place of the stored ones, so
    a batch repeated after a failure changes nothing.
    """
    files_read = spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", pattern)
    if files is not None:
        files_read = files_read.option("maxFilesPerTrigger", files)
    events = files_read.parquet(source)
    once = (
        events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
        .dropDuplicatesWithinWatermark(["event_id"]))
    counts = event_counts(facts.exposures_of(once))

    def put(batch: DataFrame, _: int) -> None:
        store.upsert(run.write(batch.select("id", "ad", "taken", "shown"), "batch"), ["id", "ad"], run)
    query = (
        counts.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())
    query.awaitTermination()


def affinities(store: Store) -> DataFrame:
    """``id, ad, affinity`` of what has been counted so far."""
    return store.read().select("id", "ad", ratio(F.col("taken"), F.col("shown")).alias("affinity"))
