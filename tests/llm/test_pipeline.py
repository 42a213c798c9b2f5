"""The pipeline against a version in plain Python, and on odd and empty tables."""

import random

import numpy as np
import pytest

import corpus_pipeline
from quillmill.llm import packing, quality, simhash, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bin string, toxic int, h0 string"


def tables(spark, folder, docs, labels):
    """documents with columns that the operators use themselves, and labels, as Parquet."""
    spark.createDataFrame([(i, t, "en", "s", 1, "b", 1, "h") for i, t in docs], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def corpus():
    rng = random.Random(21)
    words = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randrange(3, 9))) for _ in range(900)]
    docs, labels = [], []
    for i in range(240):
        body = [rng.choice(words) for _ in range(rng.randrange(60, 300))]
        if toxic := i % 4 == 0:
            for _ in range(14):
                body[rng.randrange(len(body))] = rng.choice(("idiotzk", "scumqux", "moronwy"))
        docs.append((i, " ".join(body)))
        labels.append((i, 1, int(toxic)))
    docs += [(300 + i, docs[i][1]) for i in (1, 2, 3)]  # exact copies
    docs += [(310 + i, docs[i][1] + " tail") for i in (5, 6, 7, 9)]  # near copies
    docs += [(330, "same words again " * 300), (331, "".join(map(chr, np.random.default_rng(3).integers(33, 126, 3000)))), (332, None), (333, ""), (None, docs[1][1]), docs[10], docs[10], (340, " ".join(rng.choice(words) for _ in range(3000)))]
    return docs, labels


def packed(rows):
    """Best fit of the lengths of one group, in plain Python."""
    items, bins = [], []
    for i, t in rows:
        n = len(t.split())
        bins += [[(i, k * packing.CAPACITY, packing.CAPACITY)] for k in range(n // packing.CAPACITY)]
        if n % packing.CAPACITY:
            items.append((n % packing.CAPACITY, i, n - n % packing.CAPACITY))
    open_bins = []
    for t, (n, i, start) in enumerate(sorted(items, key=lambda x: (-x[0], x[1]))):
        fitting = [b for b in open_bins if b[0] >= n]
        if fitting:
            best = min(fitting, key=lambda b: (b[0], -b[1]))
            best[0], best[1] = best[0] - n, t
            best[2].append((i, start, n))
        else:
            open_bins.append([packing.CAPACITY - n, t, [(i, start, n)]])
    return sorted(sorted(b) for b in bins + [b[2] for b in open_bins])


def test_run_equals_plain_python(spark, tmp_path):
    docs, labels = corpus()
    got = corpus_pipeline.run(spark, tables(spark, tmp_path, docs, labels)).collect()
    by_id = dict((i, t) for i, t in docs if i is not None)
    model = toxicity.fit([by_id[i] for i, _, y in labels if y], [by_id[i] for i, _, y in labels if not y])
    pair = toxicity._compressors(model.ordinary, model.toxic)
    left = [(i, t) for i, t in docs if not t or not toxicity._is_toxic(toxicity._distances(pair, toxicity.windows_of(t)), model.distance, model.share)]
    assert 40 < len(docs) - len(left) < 80
    bands = quality.Bands()
    left = [(i, t) for i, t in left if quality.measure(t, bands, quality._compress(bands))[0]]
    assert not {330, 331, 332, 333} & {i for i, _ in left} and len(left) > 150
    named = sorted(x for x in left if x[0] is not None)
    prints = simhash.fingerprint_texts([t for _, t in named])[0]
    near = np.bitwise_count(prints[:, None] ^ prints[None]).sum(2) <= simhash.BUDGET
    group = list(range(len(named)))
    for i, j in zip(*np.nonzero(near)):
        old, new = max(group[i], group[j]), min(group[i], group[j])
        group = [new if g == old else g for g in group]
    kept = [x for k, x in enumerate(named) if group[k] == k]
    assert not {301, 302, 303, 315} & {i for i, _ in kept}
    assert sorted(sorted((x["doc_id"], x["start"], x["length"]) for x in r["items"]) for r in got) == packed(kept)


@pytest.mark.parametrize("docs", [[], [(1, None), (2, ""), (None, "a b"), (3, "\n ")]])
def test_odd_tables(spark, tmp_path, docs):
    folder = tables(spark, tmp_path, docs, [])
    table = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, table, folder).columns == table.columns
    assert corpus_pipeline.run(spark, folder).count() == 0
