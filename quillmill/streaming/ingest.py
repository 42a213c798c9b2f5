"""Files that arrive while a stream runs: each batch of them goes through the pipeline and into the table of vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quillmill.operators.embedding import EmbeddingCache
from quillmill.operators.retrieval import VectorTable
from quillmill.pipeline import Pipeline


def stream_markdown(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """(doc_id, source, file_name, text) of .md files, those that come later included."""
    path = F.col("_metadata.file_path")
    files = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.md").option("maxFilesPerTrigger", files_per_batch).load(folder)
    return files.select(F.xxhash64(path).alias("doc_id"), path.alias("source"), F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))


def ingest(docs: DataFrame, pipeline: Pipeline, cache: EmbeddingCache, table: VectorTable, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Starts the stream. A batch that is repeated after a failure writes the same ids again, so nothing is doubled."""

    def write(batch: DataFrame, _: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                pipeline.run(batch, cache, table)
        finally:
            batch.unpersist()

    started = docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (started.trigger(availableNow=True) if once else started).start()
