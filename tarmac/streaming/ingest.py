"""Raw monthly files landing in a folder → the same tables as ``run_month``, as a stream.

A file-source Structured Streaming query watches a landing folder. Each micro-batch is the
list of files that arrived since the last one; only their paths are streamed, and inside
``foreachBatch`` every file is read as the batch run reads it, by header name, so wide files
and files with other column orders are accepted alike. A micro-batch's files are deliveries of
their own but go through :func:`tarmac.plans.monthly.process_deliveries` as one frame: their
months are rebuilt once and committed together, however many files a month comes in.

Delivery: the checkpoint records which files were processed, so each file is taken once. If
a micro-batch is retried after a failure, its files replace what they wrote before, so the
tables end up as if it had run once. A month may come in several files; a file that lands
again under its name replaces only its own rows. A file without a usable row is recorded in
the ``deliveries`` table and the stream goes on; one that is no readable delivery (a raw
column missing) is reported to ``on_error``, or fails the query if there is none.

Late data needs no watermark here: a late file's rows join their month when it lands.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tarmac.operators.deliveries import delivery_id
from tarmac.plans.monthly import process_deliveries
from tarmac.sources.archives import read_archives
from tarmac.sources.raw_csv import read_raw


# Fixed value: the columns of Spark's file listing source.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def landed_files(spark: SparkSession, landing_dir: str, pattern: str = "*.csv", max_files: int | None = None) -> DataFrame:
    """Stream of the paths of files appearing in ``landing_dir``; their contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(landing_dir).select("path")


def start_ingest(
    spark: SparkSession,
    landing_dir: str,
    root: str,
    *,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str = "1 hour",
    max_files_per_trigger: int | None = 100,
    archives: bool = False,
    as_of: _dt.date | str | None = None,
    dedupe_keys: bool = False,
    salt_buckets: int | None = None,
    dim: DataFrame | None = None,
    on_batch: Callable | None = None,
    on_error: Callable | None = None,
) -> StreamingQuery:
    """Start the ingest query; returns the running ``StreamingQuery``.

    ``available_now=True`` processes every file present and stops (a scheduled run);
    otherwise the query polls every ``processing_time``. The checkpoint defaults to a folder
    under ``root``: it belongs to these tables, survives the session and is shared by no
    other ingest. ``on_batch(epoch_id, RunResult)`` is called after each file,
    ``on_error(epoch_id, path, error)`` for a file that cannot be read.
    """
    location = checkpoint or f"{root.rstrip('/')}/_ingest_checkpoint"
    read = read_archives if archives else read_raw

    def handle(batch: DataFrame, epoch_id: int) -> None:
        raws = {}
        for path in sorted(r["path"] for r in batch.collect()):  # at most max_files_per_trigger paths
            try:
                raws[delivery_id(path)] = read(spark, path)
            except ValueError as error:
                if on_error is None:
                    raise
                on_error(epoch_id, path, error)
        if not raws:
            return
        results = process_deliveries(
            spark, raws, root, as_of=as_of, dedupe_keys=dedupe_keys, salt_buckets=salt_buckets, dim=dim
        )
        for result in results if on_batch is not None else []:
            on_batch(epoch_id, result)

    files = landed_files(spark, landing_dir, "*.zip" if archives else "*.csv", max_files_per_trigger)
    writer = files.writeStream.foreachBatch(handle).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
