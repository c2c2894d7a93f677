"""Only the files that are new: the batch operators behind file streams."""

from __future__ import annotations

from uuid import NAMESPACE_URL, uuid5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.functions.text import clean_text
from feedlark.operators.mention import Catalog, attach_matches, map_texts
from feedlark.operators.texts import distinct_texts


def landed_files(
    spark: SparkSession, path: str, schema, pattern: str = "*.parquet", files_per_batch: int = 1_000
) -> DataFrame:
    """A stream of the parquet files that land in a folder."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def stream_clean(posts: DataFrame, out: str, checkpoint: str, profile: str = "social") -> None:
    """Clean what is new and append it to `out`; a second run adds nothing."""
    clean = posts.withColumn("clean_text", clean_text("text", profile))
    query = (
        clean.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_mention_map(
    posts: DataFrame, catalog: Catalog, out: str, checkpoint: str, text: str = "clean_text"
) -> None:
    """Map new posts against a fixed catalog, whose vocabulary and idf come from its last fit.

    A batch replaces its own folder, named after the stream (by the id that its checkpoint keeps) and
    the batch, so a batch that is run again leaves its rows once, and streams do not touch each
    other's rows. What a batch stores on the way is deleted after it.
    """

    spark = posts.sparkSession

    def map_batch(batch: DataFrame, batch_id: int) -> None:
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or uuid5(NAMESPACE_URL, checkpoint).hex
        with runtime.scratch_scope(spark):
            stored = runtime.materialise(batch, "batch")
            mapped = map_texts(distinct_texts(stored, text), catalog)
            rows = attach_matches(stored, mapped, text)
            rows = rows.withColumns({"stream": F.lit(stream), "batch": F.lit(batch_id)})
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("stream", "batch").parquet(out)

    query = (
        posts.writeStream.foreachBatch(map_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
