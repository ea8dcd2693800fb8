"""New delivery files -> cleansed snapshot, incrementally.

Raw deliveries "gradually increase over time".  Instead of re-reading every
file each run, a file-source stream picks up only files not seen before (the
checkpoint remembers them), and ``Trigger.AvailableNow`` processes what is
there and stops, so the same job can run on a schedule.  Each micro-batch is
merged into the current snapshot with the keyed upsert of the batch pipeline;
late or re-delivered rows are handled by key and order column (an older row
never replaces a newer one), so no watermark is needed and the number of files
per batch does not change the result.  The stream's checkpoint lives in the
configured shared folder, named after the target, so a job restarted in a new
application continues where the last one stopped.  Lines that can't be parsed
are rejected with the batch's other rejects, which are kept by run time and batch.
Files may differ in their layout: columns are found by the names in each header,
and a batch's log record lists declared columns that were missing and extra ones.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from lendstar.plans.pipeline import run_table_etl
from lendstar.session import lasting_path
from lendstar.sources.files import delivery_layouts, read_layouts
from lendstar.specs import TableSpec


def ingest_deliveries(spark: SparkSession, source_dir: str, spec: TableSpec, target_base: str,
                      run_ts, checkpoint: str | None = None, sep: str = ";",
                      max_files_per_batch: int | None = None) -> list[dict]:
    """Process every delivery file under ``source_dir`` not processed before.

    Returns the per-batch log records (first load / no changes / changes
    merged), in batch order.
    """
    name = f"{spec.name}-{hashlib.sha256(target_base.rstrip('/').encode()).hexdigest()[:16]}"
    ckpt = checkpoint or lasting_path(spark, "streams", name)
    # The stream names the new files (their content isn't read here); each file's
    # columns are then found by its own header.
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    stream = reader.load(source_dir).select("path", "length")
    log: list[dict] = []

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r["path"] for r in batch.collect() if r["length"])
        layouts = delivery_layouts(spark, paths, spec.schema, sep)
        raw = read_layouts(spark, layouts, spec.schema, sep)
        if raw is None:
            return
        rec = run_table_etl(raw, spec, target_base, run_ts, batch_id)
        if rec["raw_rows"]:
            log.append({**rec, "batch_id": batch_id, "missing_columns": sorted({c for x in layouts for c in x.missing}),
                        "extra_columns": sorted({c for x in layouts for c in x.extra})})

    query = (stream.writeStream.foreachBatch(merge_batch)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    query.awaitTermination()
    return log
