"""Embeddings by a provider, behind a cache, in batches of tokens."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quillmill.operators.enrichment import text_to_embed

#: Takes texts and returns a vector for each.
Provider = Callable[[list[str]], list[list[float]]]
DIMENSION, BATCH, BATCH_TOKENS = 64, 100, 8000


def hash_embed(texts: list[str], dimension: int = DIMENSION) -> list[list[float]]:
    """The default provider, which needs no network: signed hashing of words, of length 1."""
    out = np.zeros((len(texts), dimension))
    for row, text in zip(out, texts):
        for word in re.findall(r"\w+", text.lower()):
            h = xxhash.xxh3_64_intdigest(word)
            row[h % dimension] += 1 if h >> 63 else -1
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return (out / np.where(norm > 0, norm, 1)).tolist()


def with_retry(provider: Callable, attempts: int = 3, first: float = 2.0, most: float = 30.0, base: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """The same provider, tried again after first, first * base, … seconds where it fails; the last failure is raised."""

    def run(*args):
        for k in range(attempts):
            try:
                return provider(*args)
            except Exception:  # noqa: BLE001 - a provider may fail in any way
                if k + 1 == attempts:
                    raise
                sleep(min(most, first * base**k))

    return run


# --- batches --------------------------------------------------------------------------------------------------------


def smart_batches(chunks: DataFrame, most: int = BATCH_TOKENS, key: str | None = None, order: tuple[str, ...] = ("chunk_index",), tokens: str = "token_count") -> DataFrame:
    """chunks with batch: rows in order fill a batch up to `most` tokens; a longer row is a batch of its own.

    A fold over the counts of a group, which alone are gathered; a group is a value of `key`, or a task's rows if there is
    none, since batches of several tasks needn't be full.
    """

    def fold(counts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in counts:
            yield pd.Series(batch_numbers(series.fillna(0).tolist(), most), dtype="int64")

    if key is None:
        part = F.spark_partition_id()
        return chunks.withColumn("batch", F.concat_ws("-", part, F.pandas_udf(fold, "long")(F.col(tokens))))
    row = F.struct(*order, F.coalesce(tokens, F.lit(0)).cast("long").alias("n"))
    groups = chunks.groupBy(key).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    numbers = F.udf(lambda ns: batch_numbers(ns, most), "array<long>")(F.col("rows.n"))
    numbered = groups.select(key, F.posexplode(F.arrays_zip("rows", numbers.alias("batch"))).alias("i", "x")).select(key, *(F.col(f"x.rows.{c}").alias(c) for c in order), "x.batch")
    return chunks.join(numbered, [key, *order])


def batch_numbers(counts: list[int], most: int) -> list[int]:
    out, batch, held = [], -1, None  # held: tokens of the batch at hand; None if it takes no more
    for n in counts:
        if n > most:
            batch, held = batch + 1, None
        elif held is None or held + n > most:
            batch, held = batch + 1, n
        else:
            held += n
        out.append(batch)
    return out


def batch_statistics(batched: DataFrame, *keys: str, tokens: str = "token_count") -> DataFrame:
    """One row: how many batches there are, and how many rows and tokens they hold."""
    per = batched.groupBy(*keys, "batch").agg(F.count("*").alias("n"), F.sum(F.coalesce(tokens, F.lit(0))).alias("t"))
    return per.agg(
        F.count("*").alias("num_batches"), F.avg("n").alias("avg_batch_size"), F.min("n").alias("min_batch_size"), F.max("n").alias("max_batch_size"),
        F.avg("t").alias("avg_tokens_per_batch"), F.min("t").alias("min_tokens_per_batch"), F.max("t").alias("max_tokens_per_batch"),
    )


# --- cache ----------------------------------------------------------------------------------------------------------


def cache_key(model: str, text: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{model}:"), text), 256)


class EmbeddingCache:
    """Vectors by the hash of model and text, in Parquet by the first two digits of the hash.

    Entries are (hash, model, embedding, dimension); one whose dimension isn't that of its vector doesn't count.
    """

    SCHEMA = "hash string, model string, embedding array<float>, dimension int"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _files(self):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def read(self, model: str | None = None) -> DataFrame:
        system, at = self._files()
        if not system.exists(at):
            return self.spark.createDataFrame([], self.SCHEMA)
        df = self.spark.read.schema(f"{self.SCHEMA}, prefix string").parquet(self.path).drop("prefix")
        good = df.where("hash IS NOT NULL AND dimension > 0 AND size(embedding) = dimension")
        good = good if model is None else good.where(F.col("model") == model)
        return good.dropDuplicates(["hash", "model"])

    def add(self, entries: DataFrame) -> None:
        rows = entries.select("hash", "model", F.col("embedding").cast("array<float>").alias("embedding"), F.size("embedding").alias("dimension"))
        rows.withColumn("prefix", F.substring("hash", 1, 2)).write.mode("append").partitionBy("prefix").parquet(self.path)

    def clear(self) -> None:
        system, at = self._files()
        system.delete(at, True)

    def stats(self) -> DataFrame:
        """One row: (n_entries, megabytes)."""
        system, at = self._files()
        size = system.getContentSummary(at).getLength() if system.exists(at) else 0
        return self.read().agg(F.count("*").alias("n_entries")).select("n_entries", F.lit(round(size / 1048576, 2)).alias("megabytes"))


def embed_texts(texts: DataFrame, provider: Provider, batch: int = BATCH, col: str = "text") -> DataFrame:
    """texts with embedding; the provider takes up to `batch` texts at once, and as many tasks call it as there are."""

    def run(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in column:
            given = series.tolist()
            yield pd.Series([v for k in range(0, len(given), batch) for v in provider(given[k : k + batch])], dtype=object)

    return texts.withColumn("embedding", F.pandas_udf(run, "array<float>")(F.col(col)))


def create_embeddings(texts: DataFrame, cache: EmbeddingCache, model: str, provider: Provider = hash_embed, batch: int = BATCH, attempts: int = 3, col: str = "embedding_text") -> DataFrame:
    """texts with embedding. Each distinct text that the cache lacks goes to the provider once and into the cache, from
    which all vectors are then read; so a run that is repeated pays nothing twice. Null texts have a null vector."""
    keyed = texts.withColumn("__hash", cache_key(model, F.col(col)))
    missing = keyed.select(F.col("__hash").alias("hash"), F.col(col).alias("text")).dropna().dropDuplicates(["hash"]).join(cache.read(model).select("hash"), "hash", "left_anti")
    cache.add(embed_texts(missing, with_retry(provider, attempts), batch).withColumn("model", F.lit(model)))
    known = cache.read(model).select(F.col("hash").alias("__hash"), "embedding")
    return keyed.join(known, "__hash", "left").drop("__hash")


def embed_chunks(chunks: DataFrame, cache: EmbeddingCache, model: str = "default", provider: Provider = hash_embed, with_context: bool = True, batch: int = BATCH) -> DataFrame:
    """chunks with embedding_text, embedding and embedding_dimension. An empty table gives an empty one."""
    texts = chunks.withColumn("embedding_text", text_to_embed(chunks, with_context))
    return create_embeddings(texts, cache, model, provider, batch).withColumn("embedding_dimension", F.coalesce(F.size("embedding"), F.lit(0)))


def order_in(chunks: DataFrame, *keys: str) -> DataFrame:
    """chunks with seq, their place in the order of keys within each document."""
    return chunks.withColumn("seq", F.row_number().over(Window.partitionBy(keys[0]).orderBy(*keys[1:])) - 1)
