"""From texts to a table of vectors, and questions to it. Each stage takes and returns DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.functions.splitting import Sizes
from quillmill.operators import chunking, cleaning, curation, embedding, enrichment, retrieval, structure
from quillmill.settings import Chunking, NamespaceStrategy, Settings
from quillmill.sources.state import State


def advanced_chunks(docs: DataFrame, settings: Settings = Settings(), boundaries: Callable | None = None, provider: Callable | None = None, key: str = "doc_id") -> DataFrame:
    """Cleaned documents, cut by sections and types, each chunk with its section, its metadata and display_content.

    docs has columns key, text and source, and may have file_name. Texts of which under 50 characters are left give no
    chunk. With settings.boundary_fallback, texts with hardly a heading are cut where `boundaries` says. `provider` adds
    what it knows of chunks of good quality.
    """
    # Texts that give no chunk are null from here on, not filtered: a filter would be pushed through the whole chain.
    clean = cleaning.clean_for_chunking(docs, corrupted=settings.drop_corrupted_lines)
    sizes = Sizes(settings.chunk_size, settings.chunk_overlap, settings.chunk_min_size, settings.chunk_max_size)
    carry = tuple(c for c in ("source", "file_name") if c in docs.columns)
    if boundaries is not None and settings.boundary_fallback:
        weak = structure.needs_boundaries(structure.structure_score(clean), True, settings.boundary_threshold)
        scored = structure.structure_score(clean).withColumn("__weak", weak)
        of = lambda c: scored.withColumn("text", F.when(c, F.col("text")))
        cut = chunking.hybrid_chunks(of(~F.col("__weak")), sizes, settings.use_sentence_windows, key, carry, True)
        cut = cut.unionByName(chunking.boundary_chunks(of(F.col("__weak")), boundaries, settings.chunk_max_size, key=key, carry=carry, with_sections=True))
    else:
        cut = chunking.hybrid_chunks(clean, sizes, settings.use_sentence_windows, key, carry, True)
    chunks = enrichment.enrich(cut)
    if provider is not None:
        chunks = enrichment.enrich_by_provider(chunks, provider, batch=settings.provider_batch_size)
    return chunks.withColumn("display_content", F.concat(enrichment.context_header(chunks), F.col("content")))


class Pipeline:
    """The stages with one set of parameters. With a state, chunks and embeddings are kept, and can be gone on with."""

    def __init__(self, spark: SparkSession, settings: Settings = Settings(), state: State | None = None, embed_provider: embedding.Provider = embedding.hash_embed, metadata_provider: Callable | None = None, boundary_provider: Callable | None = None, label_provider: Callable | None = None, tokenizer: Callable | None = None):
        self.spark, self.settings, self.state = spark, settings, state
        self.embed_provider, self.metadata_provider, self.boundary_provider, self.label_provider, self.tokenizer = embed_provider, metadata_provider, boundary_provider, label_provider, tokenizer

    def chunk(self, docs: DataFrame, key: str = "doc_id") -> DataFrame:
        s = self.settings
        if s.chunking == Chunking.ADVANCED:
            chunks = advanced_chunks(docs, s, self.boundary_provider, self.metadata_provider, key)
        else:
            chunks = chunking.standard_chunks(docs, s.chunk_size, s.chunk_overlap, key, tuple(c for c in ("source", "file_name") if c in docs.columns))
        chunks = curation.curate(chunks, s.chunk_max_tokens, s.chunk_min_size, s.chunk_max_size, s.chunk_overlap, s.min_chunk_quality, s.merge_strategy, s.use_tokens, s.filter_quality, s.merge_small, s.prioritize, self.tokenizer, key)
        if self.state:
            self.state.save_chunks(chunks, key)
            chunks = self.state.load_chunks()
        return chunks

    def embed(self, chunks: DataFrame, cache: embedding.EmbeddingCache, namespace: str = "") -> DataFrame:
        s = self.settings
        got = embedding.embed_chunks(chunks, cache, s.embedding_model, self.embed_provider, s.embed_with_context, s.embedding_batch_size)
        if self.state:
            self.state.save_embeddings(got, namespace)
            got = self.state.load_embeddings(namespace)
        return got

    def store(self, embedded: DataFrame, table: retrieval.VectorTable, reset: bool = False, key: str = "doc_id") -> DataFrame:
        """Writes vectors and what is stored beside them; returns (namespace, accepted, rejected)."""
        s = self.settings
        name = F.col("file_name") if "file_name" in embedded.columns else F.col(key).cast("string")
        source = F.col("source") if "source" in embedded.columns else name
        numbered = embedded.withColumn("vec_id", retrieval.vector_id(name, F.xxhash64(key), F.col("seq")))
        if s.namespace_strategy == NamespaceStrategy.BY_PROVIDER:
            config = retrieval.namespace_config(s.namespace_definitions or None)
            if self.label_provider:
                numbered = retrieval.classify(numbered, self.label_provider, config)
            else:
                numbered = numbered.withColumn("namespace", retrieval.classify_offline(F.col("rag_label")))
        else:
            by_file = s.namespace_strategy == NamespaceStrategy.BY_FILE
            numbered = numbered.withColumn("namespace", retrieval.namespace(name if by_file else source, s.namespace_strategy.value, s.namespace_prefix))
        fixed = numbered.withColumn("chunk_index", F.col("orig_chunk_index"))
        return table.upsert(retrieval.record_metadata(fixed, s.embedding_model, "namespace", "vec_id", "seq", "embedding"), reset)

    def run(self, docs: DataFrame, cache: embedding.EmbeddingCache, table: retrieval.VectorTable, reset: bool = False, key: str = "doc_id") -> DataFrame:
        return self.store(self.embed(self.chunk(docs, key), cache), table, reset, key)

    def ask(self, question: str, table: retrieval.VectorTable, namespace: str | None = None, where=None, k: int | None = None) -> DataFrame:
        """The best vectors for a question, in one namespace or in all."""
        return self.ask_all(self.spark.createDataFrame([(0, question)], "qid int, question string"), table, namespace, where, k).drop("qid")

    def ask_all(self, questions: DataFrame, table: retrieval.VectorTable, namespace: str | None = None, where=None, k: int | None = None) -> DataFrame:
        asked = embedding.embed_texts(questions.select("qid", F.col("question").alias("text")), self.embed_provider).select("qid", F.col("embedding").alias("question_embedding"))
        return retrieval.top_k(asked, table.read(namespace), k or self.settings.top_k, self.settings.metric, where=where)
