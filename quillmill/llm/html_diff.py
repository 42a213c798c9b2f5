"""HTML extraction by page differencing: lines that a page shares with its nearest page on the same host are deleted.

Pages of a host are sorted by URL path; the nearest page is the neighbour, before or after, whose path has more leading
segments, then more leading characters, in common (the one before, if both have as many). No page further on in either
direction has more in common. The text lines of the two are aligned by a longest common subsequence, and the aligned lines
are what the site's template put there.

Pages with the same lines as the page itself are passed over when neighbours are sought: a copy would delete all of a page.
Each page, copies included, is paired by its own path; pages whose lines and partner's lines agree are aligned once.

Alignment needs only hashes of lines, so a page's text moves once, compressed, to meet the list of the lines to delete. For
that it is taken out of the HTML a second time: kept from the first, all texts would lie on disk beside their shuffle.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quillmill.llm.scratch import Scratch

_DROPPED = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!doctype[^>]*>", re.S | re.I)
_BLOCK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|caption|center|dd|details|dialog|div|dl|dt|fieldset|figcaption|figure|footer|form|frame|h[1-6]|head|header|hr|html|iframe|legend|li|main|menu|nav|ol|option|p|pre|section|select|summary|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>",
    re.I,
)
_TAG = re.compile(r"<[a-zA-Z/!?][^>]*>")
_BLANKS = re.compile(r"[ \t\r\f\v ]+")
#: Bits of the alignment that are kept at once; beyond, rows are worked out again from every so many.
_STORED_BITS = 1 << 28
#: Entries of a range of paths, and ranges up to which their ends are sent to every executor.
PART_ENTRIES, BROADCAST_PARTS = 50_000, 50_000


def text_lines(page: str | None) -> list[str]:
    """The text of a page by lines: blocks of HTML and line breaks end a line, blank lines are left out."""
    if not page:
        return []
    text = _TAG.sub("", _BLOCK.sub("\n", _DROPPED.sub(" ", page)))
    return [t for line in html.unescape(text).split("\n") if (t := _BLANKS.sub(" ", line).strip())]


def common_subsequence(a: list[int], b: list[int]) -> list[int]:
    """Positions in a of a longest common subsequence of a and b, bit-parallel over b.

    Where several are longest, the one whose last line comes first in b, then in a, is taken, from the end on.
    """
    both = set(a) & set(b)
    left = [i for i, x in enumerate(a) if x in both]
    right = [x for x in b if x in both]
    # Ends that agree need no table.
    head = 0
    while head < min(len(left), len(right)) and a[left[head]] == right[head]:
        head += 1
    tail = 0
    while tail < min(len(left), len(right)) - head and a[left[-1 - tail]] == right[-1 - tail]:
        tail += 1
    middle, other = left[head : len(left) - tail], right[head : len(right) - tail]
    found: list[int] = []
    n = len(other)
    if middle and n:
        masks: dict[int, int] = {}
        for j, x in enumerate(other):
            masks[x] = masks.get(x, 0) | 1 << j
        full = (1 << n) - 1

        def step(row: int, i: int) -> int:
            u = row & masks.get(a[middle[i]], 0)
            return ((row + u) | (row - u)) & full

        m = len(middle)
        every = max(1, int(np.sqrt(m))) if m * n > _STORED_BITS else 1
        marks, row = [full], full
        for i in range(m):
            row = step(row, i)
            if (i + 1) % every == 0:
                marks.append(row)
        j = n
        for begin in range((m - 1) // every * every, -1, -every):
            rows = [marks[begin // every]]
            for i in range(begin, min(begin + every, m)):
                rows.append(step(rows[-1], i))
            # rows[i] has a zero bit at each j where the length of the subsequence grows.
            for i in range(min(begin + every, m), begin, -1):
                while j and (rows[i - begin] >> (j - 1)) & 1:
                    j -= 1
                if not j:
                    break
                if (rows[i - begin - 1] >> (j - 1)) & 1:  # grew there only with this line
                    found.append(middle[i - 1])
                    j -= 1
            if not j:
                break
    return left[:head] + found[::-1] + (left[len(left) - tail :] if tail else [])


def _hashes(lines: list[str]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63) for x in lines]


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_hashes(text_lines(x)) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["row_key", "hashes"])


def _align_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = [common_subsequence(a, b or []) for a, b in zip(batch.column("hashes").to_pylist(), batch.column("other").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("content"), batch.column("other_content"), pa.array(shared, pa.list_(pa.int32()))], names=["host", "content", "other_content", "shared"])


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = ["\n".join(text_lines(x)) for x in batch.column(1).to_pylist()]
        blobs = [pack.compress(t.encode("utf-8", "surrogatepass")) if t else None for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], names=["row_key", "blob"])


def _kept_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        sizes, texts = [], []
        for blob, shared in zip(batch.column("blob").to_pylist(), batch.column("shared").to_pylist()):
            lines = unpack.decompress(blob).decode("utf-8", "surrogatepass").split("\n") if blob else []
            gone = set(shared or ())
            sizes.append((len(lines), len(gone)))
            texts.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
        counts = [pa.array([x[k] for x in sizes], pa.int32()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "partner_path")), *counts, pa.array(texts, pa.string())], names=["page_id", "url", "partner_path", "n_lines", "n_shared", "text"])


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def _path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


_ORDER = ["host", "path", "content"]


def _across_runs(order: Window, at: Column) -> Column:
    """The last row before the run that the row lies in, in an order; a run is of rows with one host and content.

    Null within the first run. `at` is the row as a struct of _ORDER.
    """
    previous = F.lag(at).over(order)
    begins = F.when((previous["host"] != F.col("host")) | (previous["content"] != F.col("content")), previous)
    return F.last(begins, True).over(order.rowsBetween(Window.unboundedPreceding, 0))


def neighbours(entries: DataFrame, scratch: Scratch, parts: int) -> DataFrame:
    """entries (host, path, content) with the nearest one before and after, in this order, that has other content.

    The rows are range partitioned, so a host of any size is spread over partitions. Runs of equal content may go on
    over partitions: the ends of each, four rows at most, are put in order and looked through in the same way.
    """
    row, down = F.struct(*_ORDER), [F.desc(c) for c in _ORDER]
    placed = scratch.write(entries.repartitionByRange(parts, *_ORDER).sortWithinPartitions(*_ORDER).withColumn("part", F.spark_partition_id()), "sorted")
    forth, back = Window.partitionBy("part").orderBy(*_ORDER), Window.partitionBy("part").orderBy(*down)
    inside = placed.withColumn("before", _across_runs(forth, row)).withColumn("after", _across_runs(back, row))
    ends = inside.groupBy("part").agg(F.min(row).alias("first"), F.max(row).alias("last"), F.max_by("before", row).alias("b"), F.min_by("after", row).alias("a"))
    ends = ends.select("part", "first", "last", F.explode(F.array_distinct(F.filter(F.array("first", "a", "b", "last"), lambda x: x.isNotNull()))).alias("x"))
    ends = ends.select("part", "first", "last", "x.*")
    ends = ends.withColumn("before", _across_runs(Window.orderBy(*_ORDER), row)).withColumn("after", _across_runs(Window.orderBy(*down), row))
    ends = ends.groupBy("part").agg(F.max(F.when(row == F.col("first"), F.col("before"))).alias("carried_before"), F.max(F.when(row == F.col("last"), F.col("after"))).alias("carried_after"))
    got = inside.join(F.broadcast(ends) if parts <= BROADCAST_PARTS else ends, "part")
    same = lambda c: F.when(c["host"] == F.col("host"), c)
    return got.select(*_ORDER, same(F.coalesce("before", "carried_before")).alias("before"), same(F.coalesce("after", "carried_after")).alias("after"))


def _closeness(a: Column, b: Column) -> Column:
    """Leading segments, then leading characters, in common."""

    def shared(x: Column, y: Column) -> Column:
        pairs = F.zip_with(x, y, lambda p, q: p.eqNullSafe(q) & p.isNotNull())
        first_difference = F.array_position(pairs, False)
        return F.when(first_difference > 0, first_difference - 1).otherwise(F.size(pairs))

    return F.struct(shared(F.split(a, "/"), F.split(b, "/")).cast("long").alias("s"), shared(F.split(a, ""), F.split(b, "")).cast("long").alias("c"))


def page_differences(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(page_id, url, partner_path, n_lines, n_shared, text) of every row of pages.

    text is the page's lines without the shared ones, joined by line breaks: "" if none is left, or if html is null or
    empty. partner_path is null, and nothing is deleted, if the page's host has no other page with other lines or the
    URL is null or has no host. Of pages with one path, the one with the least content counts as nearest before. Repeated
    rows give repeated results. Pages of any length are aligned whole. An empty table gives an empty one. Other columns
    aren't read.
    """
    scratch = Scratch(spark, "pages")
    key = F.struct("page_id", "url", F.xxhash64("html").alias("h"))
    key_type = "row_key struct<page_id:long,url:string,h:long>"
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), F.col("html").alias("html"))
    hashed = rows.select(key.alias("row_key"), "html").mapInArrow(_hash_batches, f"{key_type}, hashes array<long>")
    # Keys with nulls must meet as well, so they are compared by the hash of their text.
    name = F.unhex(F.md5(F.to_json("row_key"))).alias("name")
    hashed = hashed.select(name, "hashes", F.coalesce(_host(F.col("row_key.url")), F.lit("")).alias("host"), F.coalesce(_path(F.col("row_key.url")), F.lit("")).alias("path"))
    hashed = hashed.withColumn("content", F.unhex(F.md5(F.array_join(F.col("hashes").cast("array<string>"), ","))))
    hashed = scratch.write(hashed.where("host <> '' AND size(hashes) > 0"), "hashed")
    entries = scratch.write(hashed.select(*_ORDER).distinct(), "entries")
    parts = max(1, -(-entries.count() // PART_ENTRIES))
    near = neighbours(entries, scratch, parts)
    choice = F.when(F.col("after").isNull(), F.col("before")).when(F.col("before").isNull(), F.col("after"))
    choice = choice.otherwise(F.when(_closeness(F.col("path"), F.col("after.path")) > _closeness(F.col("path"), F.col("before.path")), F.col("after")).otherwise(F.col("before")))
    pairs = near.select(*_ORDER, choice.alias("x")).where("x IS NOT NULL").select(*_ORDER, F.col("x.path").alias("partner"), F.col("x.content").alias("other_content"))
    pairs = scratch.write(pairs, "pairs")
    lists = hashed.groupBy("host", "content").agg(F.first("hashes").alias("hashes"))  # equal content has equal hashes
    lists = scratch.write(lists, "lists")
    others = lists.select("host", F.col("content").alias("other_content"), F.col("hashes").alias("other"))
    aligned = pairs.select("host", "content", "other_content").distinct().join(lists, ["host", "content"]).join(others, ["host", "other_content"])
    shared = scratch.write(aligned.mapInArrow(_align_batches, "host string, content binary, other_content binary, shared array<int>"), "shared")
    scratch.drop("sorted", "entries", "lists")
    met = pairs.join(shared, ["host", "content", "other_content"]).select(*_ORDER, "partner", "shared")
    by_row = hashed.select("name", *_ORDER).distinct().join(met, _ORDER).select("name", F.col("partner").alias("partner_path"), "shared")
    texts = rows.select(key.alias("row_key"), "html").mapInArrow(_text_batches, f"{key_type}, blob binary")
    joined = texts.select(name, "row_key.page_id", "row_key.url", "blob").join(by_row, "name", "left").select("page_id", "url", "partner_path", "blob", "shared")
    return joined.mapInArrow(_kept_batches, "page_id long, url string, partner_path string, n_lines int, n_shared int, text string")
