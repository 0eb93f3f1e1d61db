"""Structured Streaming forms: windows with watermarks, and keyed snapshots kept by micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.scalars import text_hash
from tidemark.operators.merging import apply_changes, classify_changes, latest
from tidemark.session import discard, materialize


def event_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def tumbling(events: DataFrame, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts and sums per window and type; rows later than ``late`` behind the newest are left out."""
    e = events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type")
    return e.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("w.start", "w.end", "event_type", "n", "total")


def sliding(events: DataFrame, width: str = "3 days", step: str = "1 day", late: str = "1 day") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width, step).alias("w")).agg(F.count("*").alias("n")).select("w.start", "w.end", "n")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    return events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", "w.start", "w.end", "n")


def keep_versions(deliveries: DataFrame, keys: list[str], text: str, folder: str, checkpoint: str, parts: int = 16) -> StreamingQuery:
    """Versioned snapshot of delivered texts at ``folder``, by deltas.

    A micro-batch writes what it changes: closed versions to ``closed/batch=<n>``, and the open versions of those of the
    ``parts`` hash parts of the keys that it touches to ``open/batch=<n>``, with the list of these parts in
    ``touched/batch=<n>``. History is never rewritten, and a part that no row of the batch falls into is not read.
    Replaying a batch overwrites its own folders from the ones before, so it is idempotent. ``versions`` reads the result.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int").alias("part")
        new = latest(batch.filter(F.col(text).isNotNull()).withColumn("hash", text_hash(F.col(text))), keys, [F.desc("hash")])
        new = new.select(*keys, F.col(text).alias("text"), "hash", part)
        touched = new.select("part").distinct()
        write = lambda df, name: df.write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
        write(touched.coalesce(1), "touched")
        hit = [r["part"] for r in spark.read.schema("part int").parquet(f"{folder}/touched/batch={number}").collect()]  # at most ``parts``
        blank = new.limit(0).withColumns({c: F.lit(None).cast("timestamp") for c in ("first_seen", "last_seen", "superseded_at")})
        before = _open(spark, folder, blank, number, hit) if number else blank
        changes = classify_changes(before, new, keys, "text", "hash")
        after = apply_changes(before.drop("part"), changes, keys, F.current_timestamp()).withColumn("part", part)
        after = materialize(after.select(*blank.columns), "versions")
        write(after.filter("superseded_at is null"), "open")
        write(after.filter("superseded_at is not null"), "closed")
        discard(after)

    return deliveries.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _open(spark: SparkSession, folder: str, like: DataFrame, before: int, parts: list[int] | None = None) -> DataFrame:
    """Open versions after the batches below ``before``, of some parts only if given: each part as its last batch left it."""
    touched = spark.read.schema("part int, batch int").parquet(f"{folder}/touched").filter(F.col("batch") < before)
    touched = touched if parts is None else touched.filter(F.col("part").isin(parts))
    last = touched.groupBy("part").agg(F.max("batch").alias("batch"))
    rows = spark.read.schema(T.StructType([*like.schema.fields, T.StructField("batch", T.IntegerType())])).parquet(f"{folder}/open").filter(F.col("batch") < before)
    return rows.join(F.broadcast(last), ["part", "batch"], "left_semi").select(*like.columns)


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """All versions that ``keep_versions`` keeps at ``folder``: the closed ones and those open now."""
    closed = spark.read.parquet(f"{folder}/closed")
    like = closed.drop("batch").limit(0)
    return closed.drop("batch").unionByName(_open(spark, folder, like, 2**31 - 1)).drop("part")


def settled(stream: DataFrame, spark: SparkSession) -> DataFrame:
    """Runs an aggregation over all that is there now and returns its complete result."""
    import uuid

    from tidemark.session import scratch_dir, track

    out = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    track(spark, out)
    query = (
        stream.writeStream.outputMode("complete").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
        .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{out}/result")).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/result")
