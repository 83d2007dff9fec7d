"""G1: incremental ingestion of landed panel drops.

``readStream`` over the landing folder with a declared schema, trigger
``availableNow`` (process everything landed, then stop), and ``foreachBatch``:

* per batch and file: SHA-256, bytes and columns read from the file in a task (V15), rows, distinct
  entities and periods, duplicate keys inside the file (V3) and the schema check of the
  file's own footer (V4) -> the ledger (V18, the columns of ``validate.LEDGER``); a file that lacks a
  required column is in the ledger with ``schema_ok = false`` and stays out of the store;
* the batch against the panel it meets: types and null rates of each column (V17) -> the drift table;
* the batch merged into the store: only the periods that it holds are read, resolved to the row of the
  latest drop per key and written anew, as ``part=<period>/epoch=<batch id>``.

Nothing is ever rewritten in place. A reader takes, for each period, its highest epoch among those in the ledger
(``current_panel``), and the ledger is written last: a batch that died halfway is not seen, and its
replay writes the same folders again (exactly-once with the checkpoint). A late correction costs its own
period. Store, ledger and checkpoint belong together; superseded epochs may be removed at any time.

Defined results: a file without rows is not part of any batch and has no entry; equal keys of one file resolve to
one of their rows (the ledger counts them); a null period is a part of its own; without landed files the store does not exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from panelforge.operators import validate as va

PROVENANCE = ("drop_id", "drop_time")


def _put(df: DataFrame, path: str, *parts: str) -> None:
    """Write these partitions only, whole; a replay writes the same ones."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def _versions(spark: SparkSession, store: str, schema: T.StructType | None = None) -> DataFrame | None:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(store)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def _newest(versions: DataFrame) -> DataFrame:
    """The rows of each part's highest epoch; the list of parts (one row a period) is joined by size as AQE measures it."""
    heads = versions.groupBy("part").agg(F.max("epoch").alias("epoch"))
    return versions.join(heads, ["part", "epoch"], "left_semi")


def latest(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...] = ("drop_time", "drop_id")) -> DataFrame:
    """Per key, the row of the latest drop; a key has one row per drop, so window partitions stay small."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def ingest_drops(spark: SparkSession, landing: str, store: str, ledger: str, checkpoint: str,
                 schema: T.StructType | str, *, keys: tuple[str, ...] = ("entity", "period"),
                 required: tuple[str, ...] = (), role: str = "explanatory", drift: str | None = None,
                 files_per_batch: int = 256) -> int:
    """Process every landed file once; returns the number of micro-batches run."""
    va.check_role(role)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    period = keys[-1]
    stored = T.StructType([*schema.fields, T.StructField("drop_id", T.StringType()), T.StructField("drop_time", T.TimestampType()),
                           T.StructField("part", T.StringType()), T.StructField("epoch", T.LongType())])
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .option("recursiveFileLookup", "true").parquet(landing)
              .withColumn("drop_id", F.col("_metadata.file_path"))
              .withColumn("drop_time", F.col("_metadata.file_modification_time")))
    batches = []

    def entries(batch: DataFrame) -> DataFrame:
        cells = batch.groupBy("drop_id", "drop_time", *keys).agg(F.count(F.lit(1)).alias("n"))
        counts = cells.groupBy("drop_id", "drop_time").agg(
            F.sum("n").alias("n_rows"), F.countDistinct(keys[0]).alias("n_entities"), F.countDistinct(period).alias("n_periods"),
            F.sum((F.col("n") > 1).cast("long")).alias("n_duplicate_keys"))
        files = va.file_digests(batch.select("drop_id").distinct()).withColumnRenamed("file_path", "drop_id")
        return (counts.join(files, "drop_id")
                .withColumn("n_columns", F.size("columns"))
                .withColumn("schema_ok", F.size(F.array_except(F.array(*map(F.lit, required)).cast("array<string>"), "columns")) == 0)
                .withColumn("role", F.lit(role)))

    def handle(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        entry = va.ledger_rows(entries(batch)).withColumn("epoch", F.lit(epoch_id).cast("long")).persist()
        try:
            good = batch.join(entry.where("schema_ok").select("drop_id"), "drop_id", "left_semi").withColumn("part", F.col(period).cast("string"))
            parts = [r[0] for r in good.select("part").distinct().collect()]  # calendar periods
            before = _versions(spark, store, stored)
            old = None if before is None else _newest(before.where(F.col("epoch") < epoch_id))
            if drift and old is not None and parts:
                report = va.schema_drift(old.select(*schema.names), good.select(*schema.names))
                _put(report.withColumn("epoch", F.lit(epoch_id).cast("long")), drift, "epoch")
            merged = good.select(*schema.names, *PROVENANCE, "part")
            if old is not None:
                touched = F.col("part").isin([p for p in parts if p is not None])
                touched = touched | F.col("part").isNull() if None in parts else touched
                merged = merged.unionByName(old.where(touched).select(*merged.columns))
            if parts:
                merged = latest(merged, keys).withColumn("epoch", F.lit(epoch_id).cast("long"))
                _put(merged.hint("rebalance", "part"), store, "part", "epoch")
            _put(entry, ledger, "epoch")
            batches.append(epoch_id)
        finally:
            entry.unpersist()
            batch.unpersist()

    query = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return len(batches)


def current_panel(spark: SparkSession, store: str, ledger: str, *, provenance: bool = False) -> DataFrame:
    """The panel as of the last finished batch; with provenance each row names its drop, for ``fit_eligible``."""
    done = spark.read.parquet(ledger).select("epoch").distinct()
    rows = _newest(spark.read.parquet(store).join(F.broadcast(done), "epoch", "left_semi"))  # one number a batch
    return rows.drop("part", "epoch", *(() if provenance else PROVENANCE))
