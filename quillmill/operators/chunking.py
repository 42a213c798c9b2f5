"""Splitting texts into chunks. A text is cut within its row, so nothing here shuffles."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillmill.functions import lines as L, patterns as P, splitting as S
from quillmill.functions.batches import mapped, spans
from quillmill.functions.splitting import Sizes, Tokenizer, plain_tokens, split_text

SIZE, OVERLAP = 1000, 200
WINDOW_TOKENS, TOKEN_OVERLAP = 600, 100

__all__ = ["Sizes", "split_text"]

Cutter = Callable[..., Iterable[tuple[str | None, str]]]


_CHUNK = {"chunk_title": "string", "start_char": "int", "content": "string"}
_SECTION = {"section_title": "string", "section_level": "int", "section_hierarchy": "array<string>"}


def _cut(docs: DataFrame, cutter: Cutter, overlap: int, key: str, carry: tuple[str, ...] = (), extra: Column | None = None, with_sections: bool = False) -> DataFrame:
    """(key, *carry, chunk_index, total_chunks, chunk_size, chunk_title, start_char, content) of what cutter yields.

    start_char is where the chunk was found in its text: see splitting.positions. `extra` is handed to cutter as well.
    With with_sections, section_title, section_level, section_hierarchy and section_hierarchy_string of the section that a
    chunk begins in go along. Null texts and texts without a character give no chunk. Columns named in carry stay.
    """
    kept = [key, *carry]
    fields = _CHUNK | (_SECTION if with_sections else {})
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    arrow = pa.list_(pa.struct([(k, {"string": pa.string(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}[v]) for k, v in fields.items()]))
    told = extra is not None

    def one(text: str | None, more) -> list[dict]:
        pieces = list(cutter(text, more) if told else cutter(text)) if text else []
        places = S.positions(text or "", [c for _, c in pieces], overlap)
        out = [{"chunk_title": t, "start_char": at, "content": c} for (t, c), at in zip(pieces, places)]
        if with_sections and pieces:
            starts, found = S.sections(text)
            for chunk in out:
                k = bisect_right(starts, chunk["start_char"]) - 1
                chunk.update(zip(_SECTION, found[k] if k >= 0 else (None, None, None)))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns
            for span in spans(batch.column(n - 2)):
                part = batch.slice(*span)
                chunks = pa.array([one(t, m) for t, m in zip(part.column(n - 2).to_pylist(), part.column(n - 1).to_pylist())], arrow)
                yield pa.RecordBatch.from_arrays([*part.columns[: n - 2], chunks], names=[*kept, "chunks"])

    given = docs.select(*kept, F.col("text").alias("__text"), (extra if told else F.lit(None).cast("boolean")).alias("__extra"))
    split = given.mapInArrow(run, f"{schema}, chunks array<struct<{','.join(f'{k}:{v}' for k, v in fields.items())}>>")
    rows = split.select(*kept, F.size("chunks").alias("total_chunks"), F.posexplode("chunks").alias("chunk_index", "c"))
    got = rows.select(*kept, "chunk_index", "total_chunks", F.length("c.content").alias("chunk_size"), *(f"c.{k}" for k in fields))
    return got.withColumn("section_hierarchy_string", F.array_join("section_hierarchy", " > ")) if with_sections else got


def _untitled(f: Callable[..., Iterable[str]]) -> Cutter:
    return lambda *args: ((None, c) for c in f(*args))


def standard_chunks(docs: DataFrame, size: int = SIZE, overlap: int = OVERLAP, key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, *carry, chunk_index, total_chunks, chunk_size, content) by the recursive splitter, of texts as they are."""
    return _cut(docs, _untitled(lambda t: split_text(t, size, overlap)), overlap, key, carry).drop("chunk_title", "start_char")


def adaptive_chunks(docs: DataFrame, sizes: Sizes = Sizes(), key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Chunks by the type of a text's content, with start_char."""
    return _cut(docs, _untitled(lambda t: S.adaptive(t, sizes)), sizes.overlap, key, carry).drop("chunk_title")


def section_chunks(docs: DataFrame, sizes: Sizes = Sizes(), level: int | None = None, key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Chunks by sections, with chunk_title and start_char."""
    return _cut(docs, lambda t: S.by_sections(t, sizes, level), sizes.overlap, key, carry)


def is_procedural(file_name: Column) -> Column:
    """Whether a name says that the document tells how to do or to repair something."""
    low = F.lower(F.coalesce(file_name, F.lit("")))
    out = F.lit(False)
    for word in P.PROCEDURE_NAMES:
        out = out | low.contains(word)
    return out


def hybrid_chunks(docs: DataFrame, sizes: Sizes = Sizes(), by_sentences: bool = False, key: str = "doc_id", carry: tuple[str, ...] = (), with_sections: bool = False) -> DataFrame:
    """Chunks by sections, and within them by type; by sentences in procedures, or everywhere if so asked."""
    procedural = F.lit(True) if by_sentences else is_procedural(F.col("file_name")) if "file_name" in docs.columns else F.lit(False)
    return _cut(docs, lambda t, p: S.hybrid(t, sizes, bool(p)), sizes.overlap, key, carry, procedural, with_sections)


def boundary_chunks(docs: DataFrame, provider: Callable[[list[str]], list[list[tuple[str, str]]]], most: int = 2000, sample: int = 12_000, key: str = "doc_id", carry: tuple[str, ...] = (), with_sections: bool = False) -> DataFrame:
    """Chunks where a provider says that sections begin.

    provider takes texts, cut to `sample` characters, and returns a list of (title, first characters) for each; what it
    names must occur in the text. Where it fails or finds nothing the text is one chunk. Cuts are made in the whole text.
    """

    def cutter(text: str) -> list[tuple[str, str]]:
        try:
            (found,) = provider([text[:sample]])
        except Exception:  # noqa: BLE001 - a provider may fail in any way, and the text must not be lost
            found = []
        return S.split_by_excerpts(text, found, most)

    return _cut(docs, cutter, 0, key, carry, with_sections=with_sections)


def sentences(text: Column, longer_than: int = 15) -> Column:
    """Stripped sentences of more than so many characters; the whole text, if it has none."""
    parts = F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+"), L.strip), lambda s: F.length(s) > longer_than)
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(text))


def sentence_windows(docs: DataFrame, reach: int = 2, key: str = "doc_id") -> DataFrame:
    """(key, sentence_index, sentence, context): each sentence with `reach` sentences on either side."""
    rows = docs.where(F.length("text") > 0).select(key, sentences(F.col("text")).alias("s"))
    one = rows.select(key, "s", F.posexplode("s").alias("sentence_index", "sentence"))
    begin = F.greatest(F.col("sentence_index") - reach, F.lit(0))
    context = F.array_join(F.slice("s", begin + 1, F.col("sentence_index") + reach - begin + 1), " ")
    return one.select(key, "sentence_index", "sentence", context.alias("context"))


def tokens(text: Column) -> Column:
    """The simplest tokens: runs of characters that aren't white space."""
    return F.regexp_extract_all(text, F.lit(r"(\S+)"), F.lit(1))


def token_windows(docs: DataFrame, size: int = WINDOW_TOKENS, overlap: int = TOKEN_OVERLAP, key: str = "doc_id") -> DataFrame:
    """(key, window, n_tokens, content): windows of `size` tokens, each beginning `overlap` before the last one's end."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be less than size")
    rows = docs.select(key, tokens(F.col("text")).alias("t")).where(F.size("t") > 0)
    begins = F.sequence(F.lit(0), F.size("t") - 1, F.lit(size - overlap))
    one = rows.select(key, "t", F.posexplode(begins).alias("window", "begin")).withColumn("part", F.slice("t", F.col("begin") + 1, F.lit(size)))
    return one.select(key, "window", F.size("part").alias("n_tokens"), F.array_join("part", " ").alias("content"))


def table_blocks(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, block, is_table, content): tables and what lies between them, in turn; a blank line goes with a table before it.

    One letter per line: t table, b blank, o other; runs are matched in that string, within the row.
    """
    lines = F.col("__lines")
    codes = L.letter_per_line(lines, lambda x, i: F.when(L.is_table_line(x), "t").when(L.is_blank(x), "b").otherwise("o"))
    rows = docs.where("text IS NOT NULL").select(key, L.lines_of(F.col("text")).alias("__lines")).withColumn("__runs", F.regexp_extract_all(codes, F.lit("(t[tb]*|[ob]+)"), F.lit(1)))
    ends = F.transform("__runs", lambda r, i: F.struct(r.startswith("t").alias("is_table"), F.length(F.array_join(F.slice("__runs", 1, i), "")).alias("begin"), F.length(r).alias("n")))
    cut = F.transform(ends, lambda e: F.struct(e["is_table"].alias("is_table"), L.strip(L.joined(F.slice(lines, e["begin"] + 1, e["n"]))).alias("content")))
    rows = rows.select(key, F.posexplode(F.filter(cut, lambda b: F.length(b["content"]) > 0)).alias("block", "b"))
    return rows.select(key, "block", "b.*")


def token_count(text: Column, tokenizer: Tokenizer | None = None) -> Column:
    """Tokens of a text, 0 for null. The default tokenizer's are counted without Python."""
    if tokenizer is None:
        return F.coalesce(F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")), F.lit(0))
    count = F.arrow_udf(lambda texts: mapped(texts, lambda t: len(tokenizer(t)) if t else 0, pa.int32()), "int")
    return count(text)


def rechunk(chunks: DataFrame, most: int = WINDOW_TOKENS, overlap: int = TOKEN_OVERLAP, tokenizer: Tokenizer | None = None, col: str = "content") -> DataFrame:
    """chunks with token_count and sub_index: those of more than `most` tokens are cut, tables that fit stay whole.

    sub_index counts the parts of a chunk from 0 and is null where it wasn't cut. Other columns go along.
    """
    cutter = tokenizer or plain_tokens
    parts = F.arrow_udf(lambda texts: mapped(texts, lambda t: list(S.token_chunks(t, most, overlap, cutter)), pa.list_(pa.string())), "array<string>")
    counted = chunks.withColumn("token_count", token_count(F.col(col), tokenizer))
    fine = counted.where(F.col("token_count") <= most).withColumn("sub_index", F.lit(None).cast("int"))
    long = counted.where(F.col("token_count") > most)
    others = [c for c in counted.columns if c not in (col, "token_count")]
    cut = long.withColumn("__parts", parts(F.col(col))).select(*others, F.posexplode("__parts").alias("sub_index", col))
    cut = cut.withColumn("token_count", token_count(F.col(col), tokenizer))
    return fine.unionByName(cut)
