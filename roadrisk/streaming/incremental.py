"""Incremental ingest of landed incident pages with Structured Streaming.

The source pipeline re-fetched everything on every run. Here new pages land
as JSON lines; a file stream with the fixed all-string schema picks up only
files it has not seen, applies the same normalisation as the batch ingest
(missing -> '', date filter, ``crash_year``) and appends to the bronze table
partitioned by year. ``trigger(availableNow=True)`` processes what has landed
and stops, which suits a scheduled refresh. The checkpoint records finished
files and the file sink commits atomically per batch, so a run that dies
(or loses executors) and is restarted neither skips nor duplicates a page.

The checkpoint knows files, not contents: a page that lands again under another name would
be appended again. ``remember`` (a time such as "30 days") keeps a digest of each record
in the stream's state for so long after it was read and drops records that come again
within it (P7 on the stream). The state is keyed, so it is spread over the tasks and
checkpointed with the stream; records that differ in any field are different records. The
time counted is that of reading, so a record is never taken for late and dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.sources.ingest import good_records, incident_schema, normalise_incidents, rejected_lines


def forget_repeats(records: DataFrame, remember: str) -> DataFrame:
    """A stream without the records that it has passed on within ``remember``."""
    digest = F.md5(F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}))
    return (records.withColumn("_digest", digest).withColumn("_read", F.current_timestamp())
            .withWatermark("_read", remember).dropDuplicatesWithinWatermark(["_digest"]).drop("_digest", "_read"))


def incremental_ingest(spark: SparkSession, landing_path: str, bronze_path: str, checkpoint_path: str,
                       fields=C.INCIDENT_FIELDS, since: str | None = C.INGEST_SINCE,
                       max_files_per_trigger: int | None = None, rejects_path: str | None = None,
                       remember: str | None = None) -> str:
    """Appends the new pages' incidents to ``bronze_path`` and the lines that don't
    parse to ``rejects_path`` (by default ``<bronze_path>_rejects``). The two are
    streams with a checkpoint each, so either can be restarted alone. ``remember``: see above;
    it is part of the stream's state, so keep it or leave it out for the life of a checkpoint."""
    schema = incident_schema(fields)

    def lines():
        reader = spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.text(landing_path)

    def start(df, path, name, partition_by=()):
        w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{checkpoint_path}/{name}")
        return w.partitionBy(*partition_by).outputMode("append").trigger(availableNow=True).start()

    good = normalise_incidents(good_records(lines(), schema), fields, since)
    if remember is not None:
        good = forget_repeats(good, remember)
    for query in (start(good, bronze_path, "bronze", ["crash_year"]),
                  start(rejected_lines(lines(), schema), rejects_path or f"{bronze_path}_rejects", "rejects")):
        query.awaitTermination()
    return bronze_path
