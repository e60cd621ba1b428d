"""Incremental bronze: new files as a stream, repeats dropped against what the table holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noticelake.operators.bronze import keep_first
from noticelake.sources.tables import append


def ingest_stream(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: str, order: list[str], by: list[str]) -> object:
    """Run the new Parquet files of ``source`` into ``target`` once: each micro-batch keeps the first row of a key that the table hasn't yet. Returns the finished query."""

    def write(batch: DataFrame, _: int) -> None:
        new = keep_first(batch, key, order)
        path = spark._jvm.org.apache.hadoop.fs.Path(target)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            new = new.join(spark.read.parquet(target).select(key).distinct(), key, "left_anti")
        append(new, target, by)

    q = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
