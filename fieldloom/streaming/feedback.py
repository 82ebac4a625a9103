"""Corrections as a stream that adds to the dictionary of later micro-batches, and event-time windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldloom.functions.text import stripped
from fieldloom.operators.dictionary import aliases


def learn(spark: SparkSession, corrections: DataFrame, dictionary: DataFrame, overlay: str, checkpoint: str, then: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Writes each new phrasing of the stream corrections (field_name, learned_alias, created_at) to the table in folder overlay, once for a field in any case.

    A micro-batch sees the dictionary and all overlay rows of earlier batches, so what it learns holds from the next one on. Its rows go to a folder of its own number,
    which a repeated batch overwrites, so a restart after a failure adds nothing twice. then is called with the snapshot and the batch's number."""

    schema = "field string, vertical string, alias string"

    def batch(df: DataFrame, n: int) -> None:
        fs = spark._jvm.org.apache.hadoop.fs.Path(overlay).getFileSystem(spark._jsc.hadoopConfiguration())
        there = [s.getPath() for s in (fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(overlay)) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(overlay)) else [])]
        earlier = [str(p) for p in there if p.getName().startswith("batch=") and int(p.getName()[6:]) < n]
        known = aliases(dictionary).select("field", "vertical", "alias")
        if earlier:
            known = known.unionByName(spark.read.schema(schema).parquet(*earlier))
        if then:
            then(known, n)
        fields = dictionary.select(F.col("canonical_name").alias("field"), "vertical")
        c = df.select(F.lower(stripped(F.col("field_name"))).alias("field"), stripped(F.col("learned_alias")).alias("alias")).filter("alias <> ''")
        new = c.join(fields, "field").groupBy("field", "vertical", F.upper("alias").alias("u")).agg(F.min("alias").alias("alias"))
        new = new.join(known.select("field", "vertical", F.upper(stripped(F.col("alias"))).alias("u")).distinct(), ["field", "vertical", "u"], "left_anti")
        new.select("field", "vertical", "alias").write.mode("overwrite").parquet(f"{overlay}/batch={n}")

    return corrections.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, size: str = "1 hour", late: str = "10 minutes", time: str = "ts", by: str = "event_type") -> DataFrame:
    """Counts and sums of tumbling windows; on a stream, rows later than late are left out."""
    at = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    g = at.groupBy(F.window("_t", size).alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("window_start"), by, "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", time: str = "ts", by: str = "user_id") -> DataFrame:
    """Sessions of each key: runs of events less than gap apart."""
    g = events.withColumn("_t", F.col(time).cast("timestamp")).groupBy(F.session_window("_t", gap).alias("w"), by).agg(F.count("*").alias("n"))
    return g.select(by, F.col("w.start").alias("session_start"), "n")
