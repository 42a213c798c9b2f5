"""Toxicity by compression distance: two zstandard dictionaries, one of ordinary and one of toxic text.

Recoding. Before compression each letter of a word becomes four bytes that depend on all letters of the word up to
it. Zstandard can only save a string it has seen at the same place of a word, so an offensive stem costs many bytes
under the ordinary dictionary and few under the toxic one, while its endings, and chance syllables, cost both the same.

Training. Both dictionaries come from zstandard's trainer: the ordinary one from windows of ordinary documents, the
toxic one from the words of toxic documents that start with a stem that is far commoner in toxic than in ordinary ones.
The toxic side compresses with the ordinary dictionary followed by its own, so that common text costs the same on
both sides. Distance of a window: bytes under the ordinary dictionary less bytes under the toxic one.

Decision. A document is toxic if at least one window, and at least a given share of its windows, reach a distance.
Both numbers are calibrated on labelled documents that training hasn't seen.
"""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.llm.ragged import LETTER, U64, char_classes, code_points, cut_text, mix64, powers, slices_of, word_spans

#: Labelled documents that are used at most, of each class: half to train, half to calibrate. The only bound here.
SAMPLE_PER_CLASS = 6000
WINDOW_WORDS = 16
LEVEL = 3
ORDINARY_BYTES, TOXIC_BYTES = 32_768, 4_096
#: A stem is told apart by its log ratio of document frequencies and by G, the log-likelihood ratio.
STEM_LOG_RATIO, STEM_G, STEM_DOCUMENTS = 3.0, 15.0, 3
#: Characters recoded at a time; longer texts are recoded in parts.
SLICE_CHARS = 1 << 18
#: Shares of windows that calibration tries.
SHARES = (0.0, 0.01, 0.02, 0.03, 0.045, 0.06, 0.08, 0.1, 0.12, 0.15, 0.2)


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    distance: int
    share: float


def recode(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, offsets, bounds): a code per letter, where each word starts among them, each text's first word."""
    if len(texts) == 1 and len(texts[0]) > 2 * SLICE_CHARS:  # memory must not grow tenfold with a long text
        parts = [_recode([p])[:2] for p in cut_text(texts[0], SLICE_CHARS)]
        lengths = np.concatenate([np.diff(o) for _, o in parts])
        return np.concatenate([c for c, _ in parts]), np.concatenate([[0], np.cumsum(lengths)]), np.array([0, len(lengths)])
    return _recode(texts)


def _recode(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cps, starts = code_points([t.lower() for t in texts])
    first, last = word_spans(char_classes()[cps] == LETTER)
    lengths = last - first
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    bounds = np.searchsorted(first, starts)
    if not len(first):
        return np.zeros(0, "<u4"), offsets, bounds
    at = np.repeat(first - offsets[:-1], lengths) + np.arange(offsets[-1])
    forward, backward = powers(len(at))
    sums = np.cumsum(mix64(cps[at].astype(U64) + U64(1)) * forward, dtype=U64)
    before = np.concatenate([np.zeros(1, U64), sums[offsets[1:-1] - 1]])
    prefix = (sums - np.repeat(before, lengths)) * np.repeat(backward[offsets[:-1]], lengths)
    return (mix64(prefix) >> U64(32)).astype("<u4"), offsets, bounds


def _windows(codes: np.ndarray, offsets: np.ndarray, begin: int, end: int, words: int) -> list[bytes]:
    cuts = [*offsets[begin:end:words].tolist(), int(offsets[end])]
    raw = memoryview(codes.view(np.uint8))
    return [bytes(raw[4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:])]


def windows_of(text: str, words: int = WINDOW_WORDS) -> list[bytes]:
    codes, offsets, bounds = recode([text])
    return _windows(codes, offsets, int(bounds[0]), int(bounds[1]), words)


def _compressors(ordinary: bytes, toxic: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
    def one(content: bytes) -> zstandard.ZstdCompressor:
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False)

    return one(ordinary), one(ordinary + toxic)


def _distances(pair, windows: list[bytes]) -> np.ndarray:
    plain, toxic = (c.compress for c in pair)
    return np.fromiter((len(plain(w)) - len(toxic(w)) for w in windows), np.int32, len(windows))


def _content(samples: list[bytes], size: int) -> bytes:
    """What zstandard's trainer picks from the samples; all of them, if they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]


def _distinct_documents(texts: list[str]) -> list[str]:
    """Without copies, also those that differ in a few words: they would pass for frequent passages.

    Texts whose three least word hashes agree count as copies. Now and then that takes different texts that share most
    of their words for copies too; it costs the sample a few rows (3,395 distinct ordinary texts of sf0.1 become 3,239).
    """
    seen: set[tuple] = set()
    out = []
    for text in texts:
        key = tuple(sorted({zlib.crc32(w) for w in text.lower().encode().split()})[:3])
        if key not in seen:
            seen.add(key)
            out.append(text)
    return out


def _stems(toxic: list[str], ordinary: list[str]) -> np.ndarray:
    counts = []
    for texts in (toxic, ordinary):
        c: Counter[int] = Counter()
        for text in texts:
            codes, offsets, _ = recode([text])
            long_enough = np.arange(len(codes)) - np.repeat(offsets[:-1], np.diff(offsets)) >= 2
            c.update(np.unique(codes[long_enough]).tolist())
        counts.append(c)
    nt, no = len(toxic), len(ordinary)
    out = []
    for code, k in counts[0].items():
        j = counts[1].get(code, 0)
        if k < STEM_DOCUMENTS or math.log((k + 0.5) / (nt + 1) * (no + 1) / (j + 0.5)) < STEM_LOG_RATIO:
            continue
        share = (k + j) / (nt + no)
        if 2 * (k * math.log(k / (share * nt)) + (j * math.log(j / (share * no)) if j else 0)) >= STEM_G:
            out.append(code)
    return np.array(out, "<u4")


def fit(toxic: list[str], ordinary: list[str], seed: int = 7) -> ToxicityModel | None:
    """A model from labelled texts; None if a class is empty or nothing tells the classes apart."""
    rng = random.Random(seed)
    toxic, ordinary = sorted(toxic), sorted(ordinary)
    rng.shuffle(toxic), rng.shuffle(ordinary)
    cut = [max(1, len(x) // 2) for x in (toxic, ordinary)]
    train_t, train_o = _distinct_documents(toxic[: cut[0]]), _distinct_documents(ordinary[: cut[1]])
    stems = _stems(train_t, train_o) if train_t and train_o else ()
    if not len(stems):
        return None
    plain = [w for t in train_o for w in windows_of(t, 8) if w]
    rng.shuffle(plain)
    marked = []
    for text in train_t:
        codes, offsets, _ = recode([text])
        hit = np.concatenate([[0], np.cumsum(np.isin(codes, stems))])
        for k in np.flatnonzero(hit[offsets[1:]] > hit[offsets[:-1]]):
            marked.append(codes[offsets[k] : offsets[k + 1]].tobytes())
    rng.shuffle(marked)
    dictionaries = _content(plain, ORDINARY_BYTES), _content(marked, TOXIC_BYTES)
    pair = _compressors(*dictionaries)
    held_out = [(y, _distances(pair, windows_of(t))) for y, texts, n in ((True, toxic, cut[0]), (False, ordinary, cut[1])) for t in texts[n:] or texts]
    truth = np.array([y for y, _ in held_out])
    weight = np.where(truth, 1 / max(1, truth.sum()), 1 / max(1, (~truth).sum()))
    sizes = np.array([len(d) for _, d in held_out])
    owner, values = np.repeat(np.arange(len(held_out)), sizes), np.concatenate([d for _, d in held_out])
    tried = []
    for distance in range(3, 41):
        hits = np.bincount(owner[values >= distance], minlength=len(held_out))
        for share in SHARES:
            wrong = truth != (hits >= np.maximum(1, np.ceil(share * sizes)))
            tried.append((round(float(weight[wrong].sum()), 9), share, distance))
    least = min(t[0] for t in tried)
    share = min(t[1] for t in tried if t[0] == least)
    best = sorted(t[2] for t in tried if t[0] == least and t[1] == share)
    return ToxicityModel(*dictionaries, best[len(best) // 2], share)


def _is_toxic(distances: np.ndarray, distance: int, share: float) -> bool:
    return int((distances >= distance).sum()) >= max(1, math.ceil(share * len(distances)))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(toxic, text) of at most per_class documents of each class, picked by a hash of doc_id.

    A document that any label calls toxic counts as toxic. Labels with nulls, or without a document, are left out. Of
    documents that share an id the least text counts, so the bound holds however often one is repeated.
    """
    by_id = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = None
    for value in (0, 1):
        one = by_id.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = one if picked is None else picked.unionByName(one)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").dropna()
    return texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")).select("toxic", "text")


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel | None:
    """Fits the model in one task, on a bounded sample of labelled rows; only the model comes to the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [x for x in batches if len(x)]
        if rows:
            table = pd.concat(rows)
            model = fit(table.text[table.toxic > 0].tolist(), table.text[table.toxic <= 0].tolist())
            if model:
                yield pd.DataFrame([vars(model)])

    got = labelled_sample(docs, labels, per_class).repartition(1).mapInPandas(run, "ordinary binary, toxic binary, distance int, share double").collect()
    return ToxicityModel(bytes(got[0].ordinary), bytes(got[0].toxic), got[0].distance, got[0].share) if got else None


def scorer(model: ToxicityModel | None):
    """An Arrow function from texts to (toxic, distance, hits, windows)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _compressors(model.ordinary, model.toxic) if model else None
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            out: list[tuple[bool, int, int, int]] = []
            for a, b in slices_of([len(t) for t in texts], SLICE_CHARS):
                if not pair:
                    out += [(False, 0, 0, 0)] * (b - a)
                    continue
                codes, offsets, bounds = recode(texts[a:b])
                for i in range(b - a):
                    d = _distances(pair, _windows(codes, offsets, int(bounds[i]), int(bounds[i + 1]), WINDOW_WORDS)) if bounds[i + 1] > bounds[i] else np.zeros(0, np.int32)
                    out.append((_is_toxic(d, model.distance, model.share), int(d.max(initial=0)), int((d >= model.distance).sum()), len(d)))
            columns = list(zip(*out)) or [(), (), (), ()]
            kinds = (pa.bool_(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", "toxic", "distance", "hits", "windows"])

    return score


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, distance, hits, windows) for every row of docs.

    distance is the largest of the row's windows. Null, empty and wordless texts have no window and aren't toxic. Rows
    with a null doc_id, and repeated rows, are scored like any other. Without labels of both classes nothing is toxic.
    Other columns aren't read. All windows of a text count, however long it is.
    """
    model = train(spark, docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(scorer(model), "doc_id long, toxic boolean, distance int, hits int, windows int")


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the toxic rows, all columns as they were; rows without a text stay, and an empty table stays empty.

    The text is the column that Spark resolves as "text", in whatever case it is spelt.
    """
    score = scorer(train(spark, docs, labels))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            (scored,) = score([pa.RecordBatch.from_arrays([texts, texts], names=["a", "b"])])
            kept = batch.filter(pc.invert(scored.column(1)))
            yield pa.RecordBatch.from_arrays(kept.columns[:-1], names=kept.schema.names[:-1])

    return docs.select("*", F.col("text").alias("__text")).mapInArrow(keep, docs.schema)
