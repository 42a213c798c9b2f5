"""Text out of PDF files. What reads a file's bytes is a provider, a plain function; the rest is relational.

No PDF library comes with this package. A provider may import one on the executors; a file on which it fails keeps its row,
with the failure in the column error.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillmill.functions import lines as L
from quillmill.operators import cleaning
from quillmill.operators.embedding import with_retry

#: (bytes, pages at most) -> (number of pages, [(characters, whether an image covers most of it) of each page read])
PageStatistics = Callable[[bytes, int], tuple[int, list[tuple[int, bool]]]]
#: bytes -> text
ToText = Callable[[bytes], str]
#: bytes -> (page, block, line, span, size, text)
Spans = Callable[[bytes], Iterable[tuple[int, int, int, int, float, str]]]

SAMPLE_PAGES = 5
KINDS = ("all", "text", "scan")


def _each(files: DataFrame, f: Callable[[bytes], list[tuple]], schema: str) -> DataFrame:
    """(path, …, error): the rows that f makes of each file's bytes; a file on which it fails gives one row of nulls."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch.path, batch.content):
                try:
                    rows = [(path, *r, None) for r in f(bytes(content))]
                except Exception as e:  # noqa: BLE001 - a provider may fail in any way, and other files must not suffer
                    rows = [(path, *[None] * len(names), f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=["path", *names, "error"]).astype(object)

    return files.select("path", "content").mapInPandas(run, f"path string, {schema}, error string")


def inventory(files: DataFrame, provider: PageStatistics, sample: int = SAMPLE_PAGES, least_chars: int = 80, image_share: float = 0.5) -> DataFrame:
    """(path, size_mb, num_pages, avg_chars_per_page, image_page_ratio, page_type, error) of files (path, size_mb, content).

    The averages are those of the first `sample` pages, which are all that a provider reads.
    """

    def facts(content: bytes) -> list[tuple]:
        n, pages = provider(content, sample)
        return [(n, len(pages), sum(c for c, _ in pages), sum(bool(i) for _, i in pages))]

    got = _each(files, facts, "num_pages int, n_read int, chars long, images int")
    averages = got.withColumn("__c", F.try_divide("chars", "n_read")).withColumn("__i", F.try_divide("images", "n_read"))
    kind = F.when((F.col("__c") < least_chars) | (F.col("__i") >= image_share), "scan").when(F.col("__c").isNotNull(), "text")
    error = F.coalesce("error", F.when(F.col("n_read") == 0, F.lit("no page")))
    shown = averages.select("path", "num_pages", F.round("__c", 1).alias("avg_chars_per_page"), F.round("__i", 2).alias("image_page_ratio"), kind.alias("page_type"), error.alias("error"))
    return files.select("path", "size_mb").join(shown, "path")


def of_kind(found: DataFrame, kind: str = "all") -> DataFrame:
    """Of an inventory the files of one type; put it before what reads them."""
    if kind not in KINDS:
        raise ValueError(f"no such kind: {kind}")
    return found.where("page_type IS NOT NULL") if kind == "all" else found.where(F.col("page_type") == kind)


def extract(files: DataFrame, provider: ToText) -> DataFrame:
    """(path, text, error); files are read in as many tasks as they lie in, each by itself."""
    return _each(files, lambda content: [(provider(content),)], "text string")


def failures(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(extracted, failed)."""
    return extracted.where("error IS NULL"), extracted.where("error IS NOT NULL")


def basic_text(files: DataFrame, provider: Callable[[bytes], list[str]], is_ocr: bool = False) -> DataFrame:
    """(path, text, error): the pages' texts with a blank line between them, cleaned by the default profile."""
    return cleaning.clean_default(extract(files, lambda content: "\n\n".join(provider(content))), is_ocr)


def markdown_text(files: DataFrame, provider: ToText, is_ocr: bool = False) -> DataFrame:
    """(path, text, error): a provider's Markdown, cleaned by the profile for manuals."""
    return cleaning.clean_technical_manual(extract(files, provider), is_ocr)


def scanned_text(files: DataFrame, *providers: ToText) -> DataFrame:
    """(path, text, error): the first provider that succeeds, its text cleaned as OCR."""
    return cleaning.clean_default(extract(files, first_of(*providers)), True)


def first_of(*providers: ToText) -> ToText:
    """Providers in order; the next one is tried where one fails. If all fail, the last failure is raised."""
    *others, last = providers

    def run(content: bytes) -> str:
        for provider in others:
            try:
                return provider(content)
            except Exception:  # noqa: BLE001 - a provider may fail in any way
                continue
        return last(content)

    return run


PROMPTS = {"fr": "Transcris ce document en Markdown, avec ses titres, ses listes et ses tableaux.", "en": "Transcribe this document as Markdown, with its headings, lists and tables."}


def remote_ocr(post: Callable[[dict, float], dict], model: str = "ocr", language: str = "fr", timeout: float = 180.0, attempts: int = 3) -> ToText:
    """A provider that sends files to a chat service. post takes a payload and seconds, and returns the service's answer."""

    def run(content: bytes) -> str:
        document = "data:application/pdf;base64," + base64.b64encode(content).decode()
        parts = [{"type": "text", "text": PROMPTS.get(language, PROMPTS["en"])}, {"type": "document_url", "document_url": document}]
        answer = with_retry(post, attempts)({"model": model, "messages": [{"role": "user", "content": parts}]}, timeout)
        text = answer["choices"][0]["message"]["content"]
        if not text:
            raise ValueError("the service returned no text")
        return text

    return run


# --- structure by sizes of fonts ------------------------------------------------------------------------------------


def spans_of(files: DataFrame, provider: Spans) -> DataFrame:
    """(path, page, block, line, span, size, text, error)."""
    return _each(files, lambda content: list(provider(content)), "page int, block int, line int, span int, size double, text string")


def font_sizes(spans: DataFrame, key: str = "path") -> DataFrame:
    """(key, size, n_chars): the characters set in each size, which is rounded to one decimal."""
    rounded = spans.select(key, F.round("size", 1).alias("size"), F.length("text").alias("n"))
    return rounded.where("size > 0").groupBy(key, "size").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_chars"))


def heading_prefixes(sizes: DataFrame, key: str = "path") -> DataFrame:
    """(key, size, prefix): # to #### for sizes well above the body's, "" for others.

    The body's size is the commonest one, the larger of equals; if that is below 8, the commonest of at least 10.
    """
    common = F.struct("n_chars", "size")
    body = sizes.groupBy(key).agg(F.max_by("size", common).alias("__b"), F.max_by("size", F.when(F.col("size") >= 10, common)).alias("__large"))
    body = body.select(key, F.when(F.col("__b") < 8, F.coalesce("__large", "__b")).otherwise(F.col("__b")).alias("__body"))
    ratio = F.col("size") / F.col("__body")
    prefix = F.when(ratio >= 2.0, "#").when(ratio >= 1.6, "##").when(ratio >= 1.3, "###").when(ratio >= 1.15, "####").otherwise("")
    return sizes.join(body, key).select(key, "size", prefix.alias("prefix"))


def structured_markdown(spans: DataFrame, key: str = "path") -> DataFrame:
    """(key, text): spans put together to lines, and lines to paragraphs and headings, by the size of their first span."""
    clean = spans.select(key, "page", "block", "line", F.struct("span", F.round("size", 1).alias("size"), L.strip(F.col("text")).alias("text")).alias("s")).where(F.length("s.text") > 0)
    lines = clean.groupBy(key, "page", "block", "line").agg(F.array_sort(F.collect_list("s")).alias("s"))
    lines = lines.select(key, "page", "block", "line", F.col("s")[0]["size"].alias("size"), F.array_join("s.text", " ").alias("text"))
    prefixes = heading_prefixes(font_sizes(spans, key), key)
    lines = lines.join(prefixes, [key, "size"], "left").withColumn("prefix", F.coalesce("prefix", F.lit("")))
    # Lines of a block form paragraphs, which headings break.
    w = Window.partitionBy(key, "page", "block").orderBy("line")
    heading = F.col("prefix") != ""
    begins = (heading | F.coalesce(F.lag(heading).over(w), F.lit(True))).cast("int")
    lines = lines.withColumn("__p", F.sum(begins).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    paragraphs = lines.groupBy(key, "page", "block", "__p").agg(F.first("prefix").alias("prefix"), F.array_sort(F.collect_list(F.struct("line", "text"))).alias("r"))
    text = F.concat(F.when(F.col("prefix") != "", F.concat("prefix", F.lit(" "))).otherwise(""), F.array_join("r.text", " "))
    whole = paragraphs.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("page", "block", "__p", text.alias("x")))).alias("r"))
    return whole.select(key, F.concat(F.array_join("r.x", "\n\n"), F.lit("\n")).alias("text"))


def structured_text(files: DataFrame, provider: Spans, is_ocr: bool = False) -> DataFrame:
    """(path, text, error): see structured_markdown, cleaned by the default profile."""
    spans = spans_of(files, provider)
    texts = cleaning.clean_default(structured_markdown(spans.where("error IS NULL")), is_ocr)
    errors: Column = F.col("error")
    return files.select("path").join(texts, "path", "left").join(spans.where("error IS NOT NULL").select("path", errors).distinct(), "path", "left")
