"""Functions for SQL: split_text(text, size, overlap) as a table, ascii_slug, count_tokens and embed_text."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import SparkSession, functions as F

from quillmill.functions import ids, splitting
from quillmill.functions.batches import mapped
from quillmill.functions.splitting import Tokenizer, plain_tokens


class SplitText:
    """(chunk_index, content) of a text by the recursive splitter; a null or empty text gives no row."""

    def eval(self, text: str, size: int, overlap: int):
        yield from enumerate(splitting.split_text(text or "", size, overlap))


def register(spark: SparkSession, tokenizer: Tokenizer = plain_tokens, embedder=None) -> None:
    """Registers the functions in a session. embedder takes a list of texts and returns a vector for each."""
    if embedder is None:
        from quillmill.operators.embedding import hash_embed as embedder

    def over(f, kind, sql):
        return F.arrow_udf(lambda texts: mapped(texts, lambda t: None if t is None else f(t), kind), sql)

    spark.udtf.register("split_text", F.udtf(SplitText, returnType="chunk_index int, content string"))
    spark.udf.register("ascii_slug", over(ids.slug, pa.string(), "string"))
    spark.udf.register("count_tokens", over(lambda t: len(tokenizer(t)), pa.int32(), "int"))
    spark.udf.register("embed_text", over(lambda t: embedder([t])[0], pa.list_(pa.float32()), "array<float>"))
