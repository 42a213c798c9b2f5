"""Compression bands: zstandard ratios reject text that repeats itself or doesn't compress.

Ratio: bytes of UTF-8 over bytes compressed. A whole document must lie within the band of its length; of its chunks of
a fixed size, at most a share may lie outside the band of chunks. The last chunk is a full one that ends where the text
ends, over part of the one before, so that no byte goes unjudged and no chunk is judged by a band for another length.
Texts too short for a chunk have smaller ones, with a band of their own; what is shorter than those is judged as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Bands:
    #: (bytes from, least ratio, greatest ratio). A frame alone takes some 12 bytes, so the ratios of the shortest are low.
    whole: tuple[tuple[int, float, float], ...] = field(
        default=((1, 0.05, 1.2), (16, 0.50, 1.3), (32, 0.65, 1.6), (64, 0.70, 2.2), (256, 1.10, 2.8), (1024, 1.30, 3.3), (4096, 1.40, 3.9), (16384, 1.45, 4.8), (65536, 1.50, 6.0), (1 << 20, 1.50, 8.0))
    )
    chunk_bytes: int = 2048
    chunk: tuple[float, float] = (1.25, 3.5)
    #: The same for documents under chunk_bytes.
    small_bytes: int = 256
    small: tuple[float, float] = (1.10, 2.8)
    #: Share of chunks outside their band from which a document is rejected: of the chunks side by side, or of all bytes.
    chunk_share: float = 0.25
    level: int = 3

    def of(self, size: int) -> tuple[float, float] | None:
        return next(((low, high) for least, low, high in reversed(self.whole) if size >= least), None)


def measure(text: str | None, bands: Bands, compress) -> tuple[bool, str | None, int, float | None, int, int]:
    """(keep, reason, bytes, ratio, chunks, chunks outside the band) of one text."""
    raw = memoryview((text or "").encode("utf-8", "surrogatepass"))
    size = len(raw)
    if not size:
        return False, "empty", 0, None, 0, 0
    ratio = size / len(compress(raw))
    step, (low, high) = (bands.chunk_bytes, bands.chunk) if size >= bands.chunk_bytes else (bands.small_bytes, bands.small)
    full, rest = divmod(size, step)
    starts = [*range(0, full * step, step), *([size - step] if full and rest else [])]
    chunks, outside, repeated, covered, upto = len(starts), 0, 0, 0, 0
    rejected = False
    for k, at in enumerate(starts):
        r = step / len(compress(raw[at : at + step]))
        if not low <= r <= high:
            outside += 1
            repeated += r > high
            covered += at + step - max(at, upto)  # what two chunks share counts once
            upto = at + step
        if k == full - 1:
            rejected = outside >= bands.chunk_share * full
    rejected |= covered >= bands.chunk_share * size
    reason, band = None, bands.of(size)
    if band and ratio > band[1]:
        reason = "repetitive"
    elif band and ratio < band[0]:
        reason = "incompressible"
    elif outside and rejected:
        reason = "repetitive chunks" if 2 * repeated >= outside else "incompressible chunks"
    return reason is None, reason, size, round(ratio, 6), chunks, outside


def _compress(bands: Bands):
    return zstandard.ZstdCompressor(level=bands.level, write_content_size=False).compress


def quality_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """(doc_id, keep, reason, n_bytes, ratio, chunks, chunks_outside) for every row of docs.

    Null and empty texts are rejected as "empty"; every other text is judged, from one byte on. Repeated rows and rows
    with a null doc_id are measured like any other. Whole texts count, however long; other columns aren't read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = _compress(bands)
        kinds = (pa.bool_(), pa.string(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
        for batch in batches:
            found = list(zip(*(measure(t, bands, compress) for t in batch.column(1).to_pylist()))) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(found, kinds))], names=names)

    names = ["doc_id", "keep", "reason", "n_bytes", "ratio", "chunks", "chunks_outside"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, keep boolean, reason string, n_bytes long, ratio double, chunks int, chunks_outside int")


def drop_low_quality(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """docs without the rejected rows, all columns as they were. Null and empty texts go; an empty table stays empty.

    The text is the column that Spark resolves as "text", in whatever case it is spelt.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = _compress(bands)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            kept = batch.filter(pa.array([measure(t, bands, compress)[0] for t in texts], pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns[:-1], names=kept.schema.names[:-1])

    return docs.where(F.length("text") > 0).select("*", F.col("text").alias("__text")).mapInArrow(run, docs.schema)
