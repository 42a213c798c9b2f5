"""Toxicity, quality rules and licences over tables, against plain versions that go through one text at a time."""

import math
import random
import re

import numpy as np
import zstandard

from quillmill.llm import licenses, quality, toxicity
from quillmill.llm.ragged import mix64

SCHEMA = "doc_id long, text string, toxic boolean, keep boolean, start int, bin string"
MASK = (1 << 64) - 1


def table(spark, texts):
    """Rows with columns named like those of the results."""
    return spark.createDataFrame([(i, t, True, False, 1, "b") for i, t in texts], SCHEMA)


def words(rng, n):
    return ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randrange(3, 9))) for _ in range(n)]


def mixed(x):
    return int(mix64(np.array([x & MASK], np.uint64))[0])


def plain_windows(text, size):
    """Letters of each word as four bytes of a hash of the word up to there; words by `size`."""
    out = []
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        total, codes = 0, b""
        for k, letter in enumerate(word):
            total = (total + mixed(ord(letter) + 1) * pow(0x9E3779B97F4A7C15, k, 1 << 64)) & MASK
            codes += (mixed(total) >> 32).to_bytes(4, "little")
        out.append(codes)
    return [b"".join(out[k : k + size]) for k in range(0, len(out), size)]


def test_toxicity_of_a_table(spark):
    rng = random.Random(6)
    known = words(rng, 600)

    def text(toxic):
        body = [rng.choice(known) for _ in range(120)]
        for _ in range(10 * toxic):
            body[rng.randrange(120)] = rng.choice(("idiotzk", "scumqux", "moronwy"))
        return " ".join(body)

    texts = [(i, text(i % 4 == 0)) for i in range(160)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)] + [(7, None), (None, 1), (999, 1), (8, 0)], "doc_id long, toxic int")
    more = [(200, None), (201, ""), (202, "1 2 3 !"), (None, texts[0][1]), texts[0], (203, ("Ein Wort für uns. " * 40_000) + texts[4][1]), (204, texts[4][1].upper())]
    got = sorted(((r.doc_id or -1, r.toxic, r.distance, r.hits, r.windows) for r in toxicity.toxicity(spark, table(spark, texts + more), labels).collect()), key=repr)
    # The table's own documents train it; the repeated one counts once.
    model = toxicity.fit([t for i, t in texts if i % 4 == 0], [t for i, t in texts if i % 4])
    raw = lambda content: zstandard.ZstdCompressor(level=3, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
    ordinary, both = raw(model.ordinary), raw(model.ordinary + model.toxic)
    want = []
    for i, t in texts + more:
        distances = [len(ordinary.compress(w)) - len(both.compress(w)) for w in plain_windows(t or "", 16)] if i != 203 else None
        if distances is None:
            continue
        hits = sum(d >= model.distance for d in distances)
        want.append((-1 if i is None else i or -1, hits >= max(1, math.ceil(model.share * len(distances))), max([0, *distances]), hits, len(distances)))
    assert [g for g in got if g[0] != 203] == sorted(want, key=repr)
    assert sum(g[1] for g in got) >= 40 and any(g[0] == 203 and g[4] > 9000 for g in got)


def plain_judgement(text, bands):
    """Keep or not, by the rules as they are written down."""
    size = lambda raw: len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(raw))
    raw = (text or "").encode()
    if not raw:
        return False
    low, high = [(a, b) for least, a, b in bands.whole if len(raw) >= least][-1]
    if not low <= len(raw) / size(raw) <= high:
        return False
    step, (low, high) = (bands.chunk_bytes, bands.chunk) if len(raw) >= bands.chunk_bytes else (bands.small_bytes, bands.small)
    if len(raw) < step:
        return True
    outside = lambda at: not low <= step / size(raw[at : at + step]) <= high
    full = [k for k in range(0, len(raw) - step + 1, step)]
    bad = [at for at in full if outside(at)]
    if bad and len(bad) >= bands.chunk_share * len(full):
        return False
    if len(raw) % step and outside(len(raw) - step):
        bad.append(len(raw) - step)
    covered = {b for at in bad for b in range(at, at + step)}
    return not bad or len(covered) < bands.chunk_share * len(raw)


def test_quality_of_a_table(spark):
    rng = random.Random(8)
    known = words(rng, 500)
    texts = [(-1, None), (-2, ""), (None, "some words"), (-3, "a" * 400_000)]
    for i in range(250):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            n = rng.choice((3, 40, 300, 1500))
            parts.append(rng.choice((" ".join(rng.choice(known) for _ in range(n // 5 + 1)), rng.choice(known) * (n // 5), "".join(chr(rng.randrange(33, 127)) for _ in range(n)), " ".join(rng.choice(known) for _ in range(n // 5 + 1)))))
        texts.append((i, " ".join(parts)))
    texts += texts[10:13]
    bands = quality.Bands()
    docs = table(spark, texts)
    want = sorted((i or 0, plain_judgement(t, bands)) for i, t in texts)
    assert sorted((r.doc_id or 0, r.keep) for r in quality.quality_rules(docs).collect()) == want
    assert 40 < sum(k for _, k in want) < 240
    kept = quality.drop_low_quality(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == sorted(i for i, k in want if k)


def test_licences_of_a_table(spark):
    end = "Licensed under the Apache License, Version 2.0."
    long = "plain words and nothing else here " * 40_000
    tie = "Apache License, Version 2.0 and Apache License, Version 2.0"
    texts = [(1, end), (1, end), (None, end), (2, long + end), (3, tie), (4, "é" * 50 + end), (5, None), (6, ""), (7, "no licence of any kind")]
    got = sorted(((r.doc_id or 0, r.license, r.start, r.end, r.matched) for r in licenses.license_scan(table(spark, texts)).collect()))
    want = sorted((i or 0, name, a, b, text) for i, t in texts for _, name, _, a, b, text in licenses.scan(t))
    assert got == want
    found = {i: [x for x in got if x[0] == i] for i in (0, 1, 2, 3, 4, 5, 6)}
    assert len(found[1]) == 2 * len(found[0]) and found[2][0][2] == len(long) + found[0][0][2] and found[4][0][2] == 50 + found[0][0][2]
    assert [x[1] for x in found[3]] == ["Apache-2.0"] * 2 and not found[5] and not found[6]
