"""Keywords, tags, labels, features and headers of chunks, from their text alone. No shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from quillmill.functions import patterns as P, vocabulary

def keywords(text: Column, most: int = 5) -> Column:
    """The commonest words of four letters or more, stop words excepted; of equally common ones the first comes first."""
    return vocabulary.only_keywords(text, most)


def entities(text: Column, most: int = 5) -> Column:
    """Struct of dates, numbers, emails and organizations: up to `most` of each, in order of first occurrence."""

    def found(*patterns: str) -> Column:
        every = [F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in patterns]
        return F.slice(F.array_distinct(F.concat(*every)), 1, most)

    return F.struct(found(*P.DATES).alias("dates"), found(P.AMOUNT).alias("numbers"), found(P.EMAIL).alias("emails"), found(P.CAPITALS).alias("organizations"))


def domain_tags(text: Column, most: int = 8) -> Column:
    return vocabulary.only_tags_and_label(text, most)["tags"]


def label(text: Column) -> Column:
    """Struct (label, confidence): the label with most matches, the first of equals; "general" without a match."""
    found = vocabulary.only_tags_and_label(text)
    return F.struct(found["label"].alias("label"), found["confidence"].alias("confidence"))


def normalize_label(name: Column) -> Column:
    """A known label in lower case with underscores, else "general"."""
    clean = F.regexp_replace(F.trim(F.lower(name)), "[ -]", "_")
    return F.when(clean.isin(*P.LABELS, "general"), clean).otherwise("general")


FEATURES = {
    "has_table": r"\|.*\|.*\||\t.*\t.*\t",
    "has_list": r"(?m)^\s*(?:[-*+]|[0-9]+\.)\s+",
    "has_code": "```|`[^`]+`",
    "has_math": r"\$.*\$|[≈≤≥∑∫]|\\(?:frac|sum|int)",
    "has_citations": r"""\[?[0-9]+\]|".*"|'.*'|«.*»""",
    "has_footnotes": r"(?m)\[\^[0-9]+\]|^[0-9]+\.\s*[A-Z]",
}


def features(text: Column) -> dict[str, Column]:
    return {name: F.coalesce(text.rlike(f"(?d){p}"), F.lit(False)) for name, p in FEATURES.items()}


def enricher_quality(text: Column, has_keywords: Column) -> Column:
    n = F.length(text)
    alpha = n - F.length(F.regexp_replace(text, r"\p{L}", ""))
    score = F.lit(1.0) - F.when(n < 100, 0.3).when(n > 3000, 0.2).otherwise(0.0) - F.when((n > 0) & (alpha / n < 0.5), 0.3).otherwise(0.0)
    score = score - F.when(~F.rtrim(text).rlike(r"[.!?]\z"), 0.1).otherwise(0.0) + F.when(has_keywords, 0.1).otherwise(0.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))


def text_stats(text: Column) -> dict[str, Column]:
    return {"char_count": F.length(text), "word_count": F.regexp_count(text, F.lit(r"\S+")), "sentence_count": F.regexp_count(text, F.lit("[.!?]+"))}


def enrich(chunks: DataFrame, col: str = "content") -> DataFrame:
    """chunks with keywords, entities_basic, rag_label, its confidence, domain_tags, features, statistics and score."""
    c = F.col(col)
    chunks = chunks.withColumns({"__facts": vocabulary.text_facts(c), "entities_basic": entities(c), **features(c), **text_stats(c)})
    chunks = chunks.withColumns({"keywords": F.col("__facts.keywords"), "rag_label": F.col("__facts.label"), "rag_label_confidence": F.col("__facts.confidence"), "domain_tags": F.col("__facts.tags")})
    chunks = chunks.withColumns({"chunk_quality_score": enricher_quality(c, F.size("keywords") > 0)})
    return chunks.drop("__facts")


def _of(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def context_header(df: DataFrame, markdown: bool = True) -> Column:
    """Name, section, type and topics, whichever the row has; "" if it has none."""
    name = F.replace(F.replace(_of(df, "file_name"), F.lit(".md"), F.lit("")), F.lit("_"), F.lit(" "))
    kind = F.nullif(_of(df, "document_type"), F.lit("unknown"))
    topics = F.array_join(F.slice(_of(df, "topics", "array<string>"), 1, 3), ", ")
    parts = [F.when(F.length(v) > 0, F.concat(F.lit(f"{k}: "), v)) for k, v in (("Document", name), ("Section", _of(df, "section_hierarchy_string")), ("Type", kind), ("Sujets", topics))]
    joined = F.concat_ws("\n" if markdown else " | ", *parts)
    shown = F.concat(F.lit("---\n"), joined, F.lit("\n---\n\n")) if markdown else F.concat(F.lit("["), joined, F.lit("]\n\n"))
    return F.when(F.length(joined) > 0, shown).otherwise("")


def augment(df: DataFrame, col: str = "content", markdown: bool = True, keep_original: bool = False) -> DataFrame:
    if keep_original:
        df = df.withColumn("original_content", F.col(col))
    return df.withColumn(col, F.concat(context_header(df, markdown), F.col(col)))


# --- metadata by a provider -----------------------------------------------------------------------------------------

#: What a provider may say about a chunk.
METADATA = "keywords array<string>, topics array<string>, document_type string, language string, summary string, entities array<string>, rag_label string, rag_label_confidence double, domain_tags array<string>"


def parse_json(answer: Column, schema: str = METADATA) -> Column:
    """The object in a provider's answer, null if there is none: as it is, then without a fence and commas before a bracket
    that closes, then what lies between the outermost braces."""

    def strict(text: Column) -> Column:
        return F.when(F.get_json_object(text, "$").startswith("{"), F.from_json(text, schema, {"allowUnquotedControlChars": "true"}))

    bare = F.regexp_replace(F.regexp_replace(answer, r"\A```(?:json)?\s*", ""), r"\s*```\z", "")
    clean = F.regexp_replace(bare, r",\s*([}\]])", "$1")
    inner = F.nullif(F.regexp_extract(clean, r"(?s)(\{.*\})", 1), F.lit(""))
    return F.coalesce(strict(answer), strict(clean), strict(inner))


def merge_tags(existing: Column, more: Column, most: int = 8) -> Column:
    """Both lists one after the other, each tag once, up to `most`."""
    none = F.array().cast("array<string>")
    return F.slice(F.array_distinct(F.concat(F.coalesce(existing, none), F.coalesce(more, none))), 1, most)


def ask(chunks: DataFrame, provider: Callable[[list[str]], list[str | None]], batch: int = 15, most_chars: int = 1500, col: str = "content", attempts: int = 2) -> DataFrame:
    """chunks with answer, a provider's raw answer to the first `most_chars` characters of each, null where it failed.

    provider takes up to `batch` texts and returns as many answers. Where it fails, or returns another number, each text
    is tried alone; a text that fails `attempts` times has no answer, and the others keep theirs.
    """

    def several(texts: list[str]) -> list[str | None]:
        for _ in range(attempts):
            try:
                got = provider(texts)
            except Exception:  # noqa: BLE001 - a provider may fail in any way
                continue
            if len(got) == len(texts):
                return got
        return [None] if len(texts) == 1 else [x for t in texts for x in several([t])]

    def run(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in column:
            given = texts.fillna("").tolist()
            yield pd.Series([x for k in range(0, len(given), batch) for x in several(given[k : k + batch])], dtype=object)

    return chunks.withColumn("answer", F.pandas_udf(run, "string")(F.substring(F.coalesce(F.col(col), F.lit("")), 1, most_chars)))


def enrich_by_provider(chunks: DataFrame, provider: Callable[[list[str]], list[str | None]], least_quality: float = 0.5, **options) -> DataFrame:
    """chunks, those of chunk_quality_score `least_quality` and more with what a provider says of them.

    keywords_ai, topics, document_type, language, summary and entities_ai are its own; a known label replaces rag_label,
    and its tags follow those found already. The others are never sent.
    """
    good = F.coalesce(F.col("chunk_quality_score"), F.lit(0.0)) >= least_quality
    asked = ask(chunks.where(good), provider, **options).withColumn("__m", parse_json(F.col("answer"))).drop("answer")
    told = F.col("__m.rag_label").isNotNull()
    asked = asked.withColumns({
        "keywords_ai": F.col("__m.keywords"), "topics": F.col("__m.topics"), "document_type": F.col("__m.document_type"), "language": F.col("__m.language"), "summary": F.col("__m.summary"), "entities_ai": F.col("__m.entities"),
        "rag_label": F.when(told, normalize_label(F.col("__m.rag_label"))).otherwise(F.col("rag_label")),
        "rag_label_confidence": F.when(told, F.coalesce("__m.rag_label_confidence", "rag_label_confidence")).otherwise(F.col("rag_label_confidence")),
        "domain_tags": merge_tags(F.col("domain_tags"), F.col("__m.domain_tags")),
    })
    return asked.drop("__m").unionByName(chunks.where(~good), allowMissingColumns=True)


# --- texts to embed -------------------------------------------------------------------------------------------------


def _listed(df: DataFrame, name: str, most: int | None = None) -> Column:
    """A list as text, null if it is missing or empty."""
    values = _of(df, name, "array<string>")
    return F.nullif(F.array_join(values if most is None else F.slice(values, 1, most), ", "), F.lit(""))


def _keywords(df: DataFrame, most: int | None = None) -> Column:
    return F.coalesce(_listed(df, "keywords_ai", most), _listed(df, "keywords", most))


def _tagged(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"[{name}: "), value, F.lit("]"))


def embedding_text(df: DataFrame, col: str = "content") -> Column:
    """The content behind a line of what is known about it, in brackets."""
    path = F.nullif(F.array_join(_of(df, "section_hierarchy", "array<string>"), " > "), F.lit(""))
    kind = F.nullif(F.nullif(_of(df, "document_type"), F.lit("unknown")), F.lit(""))
    known = (("Section", path), ("Mots-clés", _keywords(df, 5)), ("Sujets", _listed(df, "topics", 3)), ("Type", kind), ("Résumé", F.nullif(_of(df, "summary"), F.lit(""))))
    front = F.concat_ws(" ", *(_tagged(k, v) for k, v in known))
    return F.when(F.length(front) > 0, F.concat(front, F.lit("\n\n"), F.col(col))).otherwise(F.col(col))


def text_to_embed(df: DataFrame, with_context: bool = True, col: str = "content") -> Column:
    """The content as it is, or the stored embedding_text, or one made now."""
    if not with_context:
        return F.col(col)
    return F.coalesce(F.nullif(_of(df, "embedding_text"), F.lit("")), embedding_text(df, col))


def text_variants(df: DataFrame, *keys: str, col: str = "content") -> DataFrame:
    """(*keys, variant, text): raw, with_context, keywords_focused and semantic_enriched of every row."""
    content = F.col(col)
    words = _keywords(df)
    known = (("Résumé", F.nullif(_of(df, "summary"), F.lit(""))), ("Section", F.nullif(_of(df, "section_hierarchy_string"), F.lit(""))), ("Sujets", _listed(df, "topics")))
    front = F.concat_ws("\n", *(F.concat(F.lit(f"{k}: "), v) for k, v in known))
    texts = {
        "raw": content, "with_context": F.concat(context_header(df), content),
        "keywords_focused": F.when(words.isNotNull(), F.concat(F.lit("Mots-clés: "), words, F.lit("\n\n"), content)).otherwise(content),
        "semantic_enriched": F.when(F.length(front) > 0, F.concat(front, F.lit("\n\n"), content)).otherwise(content),
    }
    return df.select(*keys, F.inline(F.array(*(F.struct(F.lit(k).alias("variant"), v.alias("text")) for k, v in texts.items()))))
