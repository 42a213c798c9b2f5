"""The ten operators against brute force, round trips and odd tables."""

import hashlib
import random

import numpy as np
import pytest

from quillmill.llm import bpe, html_diff, licenses, packing, quality, shards, simhash, topk, toxicity, warc

DOCS = "doc_id long, text string, n_chars int, g long, h0 string, label string, bin string"


def docs_of(spark, texts):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 1, 2, "x", "y", "z") for i, t in texts], DOCS)


ODD = [(1, "one two three"), (1, "one two three"), (2, None), (3, ""), (None, "no id here"), (4, "word " * 60_000), (5, "   \n")]


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_packing_covers_every_token_once(spark):
    rng = random.Random(1)
    texts = [(i, "a " * rng.choice((0, 1, 5, 30, 99, 100, 101, 350))) for i in range(300)]
    got = rows(packing.pack(spark, docs_of(spark, texts), capacity=100, group_items=40))
    seen = {}
    for b in got:
        assert b["n_tokens"] == sum(x["length"] for x in b["items"]) <= 100
        for x in b["items"]:
            seen.setdefault(x["doc_id"], []).extend(range(x["start"], x["start"] + x["length"]))
    assert {i: sorted(v) for i, v in seen.items()} == {i: list(range(t.count("a"))) for i, t in texts if t}
    total = sum(t.count("a") for _, t in texts)
    assert len(got) <= -(-total // 100) * 1.05 + 1


def test_best_fit_is_best_fit():
    lengths = np.array([60, 50, 40, 40, 10])
    assert packing.best_fit(lengths, 100).tolist() == [0, 1, 0, 1, 1]


def nearest_by_scanning(pages):
    """Every page's partner by trying all pages of its host: the closest path on either side, then the closer side."""
    lines = [html_diff.text_lines(h) for _, _, h in pages]
    content = [hashlib.md5(",".join(map(str, html_diff._hashes(x))).encode()).digest() for x in lines]
    split = [u.split("://", 1)[1].partition("/") for _, u, _ in pages]
    place = [(host, slash + path, c) for (host, slash, path), c in zip(split, content)]

    def common(x, y):
        k = 0
        while k < min(len(x), len(y)) and x[k] == y[k]:
            k += 1
        return k

    out = []
    for me in place:
        others = [p for p in place if p[0] == me[0] and p[2] != me[2]]
        before, after = max((p for p in others if p < me), default=None), min((p for p in others if p > me), default=None)
        close = lambda p: (common(me[1].split("/"), p[1].split("/")), common(me[1], p[1]))  # noqa: B023, E731
        out.append(before if after is None else after if before is None else after if close(after) > close(before) else before)
    return lines, place, out


def test_every_page_meets_its_nearest(spark, monkeypatch):
    monkeypatch.setattr(html_diff, "PART_ENTRIES", 7)
    rng = random.Random(11)
    bodies = [f"<p>Home</p><p>{' '.join(rng.choice('abcdefgh') for _ in range(3))}</p><p>Legal</p><p>End</p>" for _ in range(8)]
    pages = []
    for i in range(150):
        host = rng.choice(("a.org", "a.org", "b.org"))
        # A run of copies over several ranges lies in the middle of a host.
        path = "/".join(rng.choice(("x", "y", "long-name", "m")) for _ in range(rng.randrange(1, 4)))
        pages.append((i, f"http://{host}/{path}/{rng.randrange(30)}", rng.choice(bodies)))
    pages += [(200 + i, f"http://a.org/m/{i:03d}", bodies[0]) for i in range(60)] + [pages[0], pages[0]]
    got = sorted((r["page_id"], r["partner_path"], r["text"]) for r in rows(html_diff.page_differences(spark, spark.createDataFrame(pages, "page_id long, url string, html string"))))
    lines, place, partners = nearest_by_scanning(pages)
    by_content = dict(zip((p[2] for p in place), lines))
    want = []
    for (i, _, _), mine, partner in zip(pages, lines, partners):
        shared = set(html_diff.common_subsequence(html_diff._hashes(mine), html_diff._hashes(by_content[partner[2]]))) if partner else ()
        want.append((i, partner and partner[1], "\n".join(x for k, x in enumerate(mine) if k not in shared)))
    assert got == sorted(want)


def test_pages_with_odd_columns(spark):
    page = lambda body: f"<nav>Home</nav><p>{body}</p>"
    odd = [(1, "http://a.org/1", page("one"), "h", "n"), (2, "http://a.org/2", page("two " * 200_000), "h", "n"), (3, "http://a.org/3", "", "h", "n")]
    df = spark.createDataFrame(odd, "page_id long, url string, html string, host string, name string")
    assert {r["page_id"]: r["text"] for r in rows(html_diff.page_differences(spark, df))} == {1: "one", 2: ("two " * 200_000).strip(), 3: ""}


def naive_best_fit(items, capacity):
    """Items (length, name) longest first; each goes where the least room remains, the bin opened or filled last of equals."""
    bins = []  # (room, time of the last change, content)
    for t, (n, name) in enumerate(items):
        fitting = [b for b in bins if b[0] >= n]
        if fitting:
            best = min(fitting, key=lambda b: (b[0], -b[1]))
            best[0] -= n
            best[1] = t
            best[2].append(name)
        else:
            bins.append([capacity - n, t, [name]])
    return [b[2] for b in bins]


def test_best_fit_equals_the_naive_one():
    rng = random.Random(8)
    for _ in range(60):
        lengths = [rng.randrange(1, 101) for _ in range(rng.randrange(1, 60))]
        order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
        got = packing.best_fit(np.array(lengths), 100)
        want = naive_best_fit([(lengths[i], i) for i in order], 100)
        assert sorted(sorted(np.flatnonzero(got == b).tolist()) for b in set(got.tolist())) == sorted(map(sorted, want))


@pytest.mark.parametrize("group_items", [1000, 30])
def test_packing_equals_the_naive_rounds(spark, group_items):
    from pyspark.sql import functions as F

    rng = random.Random(12)
    lengths = [(i % 90, rng.choice((3, 20, 45, 55, 70, 100, 130))) for i in range(120)] + [(7, 20)] * 15
    docs = docs_of(spark, [(i, "a " * n) for i, n in lengths])
    got = sorted(tuple((x["doc_id"], x["start"], x["length"]) for x in b["items"]) for b in rows(packing.pack(spark, docs, capacity=100, group_items=group_items)))
    copies, items, want = {}, [], []
    for i, n in lengths:
        want += [((i, k * 100, 100),) for k in range(n // 100)]
        copies[i, n] = copies.get((i, n), 0) + 1
        if n % 100:
            items.append((i, n, copies[i, n]))
    groups = -(-len(items) // group_items)
    hashed = spark.createDataFrame(items, "i long, n long, c long").select("i", "n", "c", F.pmod(F.xxhash64("i", "n", "c"), F.lit(groups)))
    current = [(g, i, n % 100, ((i, n - n % 100, n % 100),)) for i, n, c, g in map(tuple, hashed.collect())]
    while True:
        left = []
        for g in sorted({x[0] for x in current}):
            mine = sorted((x for x in current if x[0] == g), key=lambda x: (-x[2], x[1], x[3][0][1], len(x[3])))
            for content in naive_best_fit([(x[2], x) for x in mine], 100):
                joined = tuple(p for x in content for p in x[3])
                size = sum(x[2] for x in content)
                if groups == 1 or size > 99:
                    want.append(joined)
                else:
                    left.append((g, min(x[1] for x in content), size, joined))
        merged = max(1, -(-len(left) // group_items))
        if groups == 1 or not left or merged == groups:
            want += [x[3] for x in left]
            break
        current = [(g * merged // groups, *rest) for g, *rest in left]
        groups = merged
    assert [sorted(x) for x in got] == [sorted(x) for x in sorted(want)] or sorted(map(sorted, got)) == sorted(map(sorted, want))


def hamming(a, b):
    return int(np.bitwise_count(a ^ b).sum())


def test_trie_join_finds_what_brute_force_finds():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, (60, 2), dtype=np.uint64)
    codes = [b for b in base]
    for b in base:
        for flips in (1, 5, 12, 20, 21, 30):
            c = b.copy()
            for bit in rng.choice(128, flips, replace=False):
                c[bit // 64] ^= np.uint64(1 << int(bit % 64))
            codes.append(c)
    codes = np.unique(np.array(codes), axis=0)
    expected = {(i, j) for i in range(len(codes)) for j in range(i) if hamming(codes[i], codes[j]) <= simhash.BUDGET}
    parent = list(range(len(codes)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for block in range(simhash.BLOCKS):
        shift = simhash.BITS * block // simhash.BLOCKS
        turned = [((int(h) << 64 | int(l)) << shift | (int(h) << 64 | int(l)) >> (128 - shift)) & (1 << 128) - 1 for h, l in codes]
        order = sorted(range(len(codes)), key=turned.__getitem__)
        words = np.array([[turned[i] >> 64, turned[i] & (1 << 64) - 1] for i in order], np.uint64)
        for i, j in zip(*simhash.trie_join(words, None, block, 0)[:2]):
            assert root(order[i]) is not None
            parent[root(order[i])] = root(order[j])
    want = list(range(len(codes)))

    def want_root(x):
        while want[x] != x:
            x = want[x]
        return x

    for i, j in expected:
        want[want_root(i)] = want_root(j)
    assert [[root(i) == root(j) for j in range(i)] for i in range(len(codes))] == [[want_root(i) == want_root(j) for j in range(i)] for i in range(len(codes))]


def test_near_dedup_over_several_nodes(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(500)]
    texts = []
    for d in range(60):
        body = [rng.choice(words) for _ in range(200)]
        texts.append((d, " ".join(body)))
        if d % 3 == 0:
            texts.append((100 + d, " ".join([*body[:-1], "changed"])))
        if d % 10 == 0:
            texts.append((200 + d, " ".join(body)))
    docs = docs_of(spark, texts)
    one, many = (sorted(map(tuple, simhash.near_duplicate_members(spark, docs, node_size=n).collect())) for n in (1 << 20, 60))
    assert one == many
    # Brute force over all pairs: classes and links.
    prints = simhash.fingerprint_texts([t for _, t in texts])[0]
    near = np.bitwise_count(prints[:, None] ^ prints[None]).sum(2) <= simhash.BUDGET
    links = {i: int(n) - 1 for (i, _), n in zip(texts, near.sum(1)) if n > 1}
    assert {r[0]: r[5] for r in one} == links
    ids = [i for i, _ in texts]
    classes = {i: min(ids[j] for j in np.flatnonzero(near[k])) for k, i in enumerate(ids)}
    assert all(r[3] == classes[r[0]] for r in one) and len(one) == 50
    kept = {r["doc_id"] for r in rows(simhash.drop_near_duplicates(spark, docs))}
    assert kept == set(range(60))


def test_near_dedup_keeps_distinct_texts_of_a_repeated_id(spark):
    a, b, c = "alpha beta gamma delta", "one two three four", "x y z w q"
    docs = docs_of(spark, [(3, a), (5, a), (5, b), (7, b), (9, c), (9, c), (9, None), (None, c)])
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in rows(simhash.drop_near_duplicates(spark, docs)))
    assert kept == [(0, c), (3, a), (5, b), (9, ""), (9, c)]
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in rows(simhash.near_duplicate_groups(spark, docs)))
    assert got == [(3, 3, 1), (5, 3, 1), (5, 5, 1), (7, 5, 1)]


def test_feistel_is_a_permutation():
    for size in (1, 2, 5, 64, 1000):
        assert sorted(shards.permute(np.arange(size), size).tolist()) == list(range(size))


def test_shards_hold_all_tokens_in_the_keyed_order(spark, tmp_path):
    texts = [(i, "hello world " * (i % 7)) for i in range(40)] + [(3, "again"), (3, "again"), (4, None), (None, "x")]
    encoder = bpe.Encoder(bpe.load())
    source = str(tmp_path / "docs")
    docs_of(spark, texts).repartition(5).write.parquet(source)
    docs = spark.read.parquet(source)
    manifest = shards.write_shards(spark, docs, str(tmp_path / "out"), seq_len=8, shard_rows=20)
    got = {r["slot"]: (r["doc_id"], r["seq"], r["token_ids"]) for r in rows(shards.read_shards(manifest, 8))}
    # The order recomputed in plain Python: documents as they are read, cut into sequences, slots by the permutation.
    flat = []
    for r in docs.select("doc_id", "text").dropna().collect():
        tokens = [*encoder.encode([r.text])[0].tolist(), shards.END_TOKEN]
        flat += [(r.doc_id, k // 8, tokens[k : k + 8]) for k in range(0, len(tokens), 8)]

    def slot(x):
        half, keys = max(1, ((len(flat) - 1).bit_length() + 1) // 2), shards.round_keys(shards.KEY)
        while True:
            left, right = x >> half, x & (1 << half) - 1
            for k in keys:
                mixed = int(shards.mix64(np.array([(right + k) % (1 << 64)], np.uint64))[0])
                left, right = right, left ^ mixed & (1 << half) - 1
            x = left << half | right
            if x < len(flat):
                return x

    assert got == {slot(i): x for i, x in enumerate(flat)}
    assert manifest.count() == -(-len(flat) // 20)
    assert all(r["first_slot"] == 20 * r["shard"] and r["rows"] == min(20, len(flat) - r["first_slot"]) for r in rows(manifest))
    assert sorted(r["slot"] for r in rows(shards.read_shards(manifest, 8, from_slot=17))) == list(range(17, len(flat)))


def test_shards_of_a_table_that_does_not_hold_still(spark, tmp_path):
    import os

    from pyspark.sql import functions as F

    changing = F.udf(lambda: "word " * (os.urandom(1)[0] % 40)).asNondeterministic()
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), changing().alias("text"))
    manifest = shards.write_shards(spark, docs, str(tmp_path), seq_len=8, shard_rows=100)
    got = rows(shards.read_shards(manifest, 8))
    assert sorted(r["slot"] for r in got) == list(range(len(got))) and {r["doc_id"] for r in got} == set(range(2000))


def test_long_texts_are_encoded_in_parts():
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdefg é") for _ in range(6)) for _ in range(100_000))
    assert len(text) > bpe.SLICE_CHARS
    encoder = bpe.Encoder(bpe.load())
    (_, _, tokens, _), = bpe.encoded_slices(encoder, [text])
    assert tokens.tolist() == encoder.encode([text])[0].tolist()
    assert bpe.token_counts(encoder, [text, "", text[:50]]).tolist() == [len(tokens), 0, len(encoder.encode([text[:50]])[0])]
    assert encoder.vocabulary.decode(tokens).tobytes().decode() == text


def test_bpe_agrees_with_the_plain_algorithm():
    import base64

    import tiktoken

    with open(bpe.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab é'sstl  \n\t19.,!ñ語🎉") for _ in range(rng.randrange(60))) for _ in range(500)] + ["x" * 5000, ""]
    tokens, at = bpe.Encoder(bpe.load()).encode(texts)
    for t, a, b in zip(texts, at, at[1:]):
        assert tokens[a:b].tolist() == plain.encode_ordinary(t)


def test_bpe_round_trip(spark):
    got = rows(bpe.encode_decode(docs_of(spark, ODD)))
    assert all(r["exact"] for r in got if r["token_ids"] is not None) and sum(r["token_ids"] is None for r in got) == 1
    back = rows(bpe.decode(bpe.encode(docs_of(spark, ODD))))
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in back) == sorted((i or 0, t or "") for i, t in ODD)


def test_top_k_over_blocks(spark):
    rng = np.random.default_rng(0)
    m = np.round(rng.normal(size=(150, 6)), 1)
    m[20:40] = m[0]
    m[50] = 0
    v = [(i, x.tolist()) for i, x in enumerate(m)] + [(900, None), (None, m[1].tolist()), (901, [1.0])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows(topk.top_k(spark, df, 5, every=4, block_rows=32, query_rows=16))}
    f = m.astype("f4").astype(float)
    u = f / np.sqrt((f * f).sum(1, keepdims=True) + 1e-300)
    whole = np.rint(u @ u.T * 1e6).astype(int)
    expected = {}
    for q in range(0, 150, 4):
        best = sorted((-whole[q, j], j) for j in range(150) if j not in (q, 50))[:5]
        expected |= {(q, k + 1): (j, -score / 1e6) for k, (score, j) in enumerate(best)}
    assert got == expected  # ties go to the least id


def test_toxicity_on_held_out_documents():
    rng = random.Random(4)
    words = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randrange(3, 9))) for _ in range(800)]
    bad = ["idiotzk", "scumqux", "moronwy"]

    def text(toxic):
        body = [rng.choice(words) for _ in range(150)]
        for _ in range(12 * toxic):
            body[rng.randrange(150)] = rng.choice(bad)
        return " ".join(body)

    model = toxicity.fit([text(1) for _ in range(80)], [text(0) for _ in range(300)])
    score = [toxicity._is_toxic(toxicity._distances(toxicity._compressors(model.ordinary, model.toxic), toxicity.windows_of(text(k % 2))), model.distance, model.share) == bool(k % 2) for k in range(200)]
    assert sum(score) >= 190


def test_quality_bands():
    bands = quality.Bands()
    compress = quality._compress(bands)
    rng = random.Random(1)
    words = ["".join(rng.choice("aeiounrstlm") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    prose = " ".join(rng.choice(words) for _ in range(150))
    assert quality.measure("same words again " * 100, bands, compress)[1] == "repetitive"
    assert quality.measure(prose, bands, compress)[0] and quality.measure("", bands, compress)[:2] == (False, "empty")
    noise = "".join(map(chr, np.random.default_rng(1).integers(33, 126, 4000)))
    assert quality.measure(noise, bands, compress)[1] == "incompressible"
    # No length is exempt: a run of one letter falls from the size on at which a frame shows it.
    assert [quality.measure("a" * n, bands, compress)[0] for n in (1, 24, 40, 63, 64, 300)] == [True, False, False, False, False, False]
    assert all(quality.measure(prose[:n], bands, compress)[0] for n in range(1, 64))


def test_columns_spelt_otherwise(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("aeiounrstlm") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    good = " ".join(rng.choice(words) for _ in range(150))
    docs = spark.createDataFrame([(1, good, "x"), (2, "a" * 5000, "x"), (3, None, "x")], "doc_id long, TEXT string, note string")
    assert [r["doc_id"] for r in rows(quality.drop_low_quality(docs))] == [1]
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.drop_toxic(spark, docs, labels).columns == ["doc_id", "TEXT", "note"] and toxicity.drop_toxic(spark, docs, labels).count() == 3


def test_licences():
    found = licenses.scan("// Licensed under the Apache License,\n// Version 2.0. Also SPDX-License-Identifier: MIT here.")
    assert {x[1] for x in found} == {"Apache-2.0", "MIT"}
    assert licenses.scan(None) == licenses.scan("") == licenses.scan("nothing of the kind") == []
    spans = [(0, 10), (2, 5), (8, 12), (9, 11), (0, 10)]
    assert licenses.contained(spans) == [False, True, False, True, True]


def test_line_subsequence_is_longest():
    rng = random.Random(6)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        got = html_diff.common_subsequence(a, b)
        assert len(got) == table[-1][-1] and got == sorted(set(got))
        it = iter(b)
        assert all(a[i] in it for i in got)


def test_page_differences(spark):
    page = lambda body: f"<html><nav>Home</nav><p>{body}</p><footer>Legal</footer></html>"
    df = spark.createDataFrame([(1, "http://a.org/x/1", page("one")), (2, "http://a.org/x/2", page("two")), (3, "http://b.org/", page("alone")), (4, None, page("lost")), (5, "http://a.org/y", None), (None, "http://a.org/x/3", "")], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in rows(html_diff.page_differences(spark, df))}
    assert got == {1: "one", 2: "two", 3: "Home\nalone\nLegal", 4: "Home\nlost\nLegal", 5: "", None: ""}


def test_captures(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "<p>é</p>", "c"), (2, None, None, "c"), (None, "http://b.org", "x", "c")], "page_id long, url string, html string, label string")
    got = {r["page_id"]: r for r in rows(warc.captures(spark, pages))}
    assert set(got) == {1, 2}
    assert bytes(got[1]["response"]["body"]).decode() == "<p>é</p>" and got[1]["request"]["start_line"] == "GET /x HTTP/1.1"
    assert len(got[1]["metadata"]) == 1 and got[1]["others"] == []
    alone = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 2\r\n\r\nhi"
    extra = warc.assemble(spark, spark.createDataFrame([(alone,), (alone,), (b"junk",), (None,)], "raw binary"))
    assert [r["capture_id"] for r in rows(extra)] == ["<urn:x>"]


def test_repeated_pages_give_captures_of_their_own(spark):
    pages = [(1, "http://a.org", "one"), (1, "http://a.org", "two"), (1, "http://a.org", "two"), (2, "http://a.org", "two"), (3, "u", "x" * 3_000_000)]
    got = rows(warc.captures(spark, spark.createDataFrame(pages, "page_id long, url string, html string")))
    assert sorted((r["page_id"], bytes(r["response"]["body"]).decode()) for r in got) == sorted((p, h) for p, _, h in pages)
    assert all(len(r["metadata"]) == 1 and r["request"] and r["others"] == [] for r in got) and len({r["capture_id"] for r in got}) == 5


def record(kind, name, to=(), body=b"b"):
    head = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: <urn:%d>" % name, *(b"WARC-Concurrent-To: <urn:%d>" % t for t in to), b"Content-Length: %d" % len(body)]
    return b"\r\n".join(head) + b"\r\n\r\n" + body + b"\r\n\r\n"


def test_captures_are_the_components_of_the_links(spark):
    rng = random.Random(9)
    n = 300
    kinds = [rng.choice((b"response", b"request", b"metadata", b"resource")) for _ in range(n)]
    # Chains, cycles, several targets, targets that no record has, and records that name themselves.
    to = [[rng.randrange(max(0, i - 4), i + 3) if rng.random() < 0.9 else 1000 + rng.randrange(4) for _ in range(rng.choice((0, 0, 1, 1, 2)))] if i % 5 else [] for i in range(n)]
    raw = spark.createDataFrame([(record(k, i, t),) for i, (k, t) in enumerate(zip(kinds, to))], "raw binary")
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, ts in enumerate(to):
        root(i)
        for t in ts:
            parent[root(i)] = root(t)
    want = {}
    for i in range(n):
        want.setdefault(root(i), set()).add(f"<urn:{i}>")

    def ids(r):
        return {x["record_id"] for x in [r["response"], r["request"], *r["metadata"], *r["others"]] if x}

    assert sorted(map(sorted, map(ids, rows(warc.assemble(spark, raw))))) == sorted(map(sorted, want.values()))


def test_warc_files_are_read_as_streams(spark, tmp_path, monkeypatch):
    import gzip

    records = [record(b"response", i, body=bytes([65 + i]) * size) for i, size in enumerate((0, 10, 3_000_000, 5))]
    plain = [r.rstrip(b"\r\n") for r in records]
    whole = b"\r\n".join(records)
    members = b"".join(gzip.compress(r) for r in records)
    (tmp_path / "a.warc").write_bytes(b"junk WAR" + whole)
    (tmp_path / "b.warc.gz").write_bytes(members)
    (tmp_path / "cut.warc.gz").write_bytes(members[:-9])
    (tmp_path / "cut.warc").write_bytes(whole[:-6])
    (tmp_path / "empty.warc").write_bytes(b"")
    ids = sorted(warc.parse_record(bytes(r["raw"]))[0] for r in rows(warc.read_warc(spark, str(tmp_path))))
    assert ids == sorted([f"<urn:{k}>" for k in range(4)] * 2 + [f"<urn:{k}>" for k in range(3)] + [f"<urn:{k}>" for k in (0, 1, 2)] + ["<urn:3>"] * (ids.count("<urn:3>") - 2))
    for data in (whole, members):
        for step in (1000, len(data)):
            got = list(warc.split_warc(data[k : k + step] for k in range(0, len(data), step)))
            assert [g.rstrip(b"\r\n") for g in got] == plain
    assert list(warc.split_warc([whole[:-6]])) == [r[:-4] for r in records[:3]]
    assert list(warc.split_warc([gzip.compress(records[0]), b"damaged"])) == [records[0][:-4]]


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_odd_tables(spark, kind):
    docs = docs_of(spark, ODD if kind == "odd" else [])
    n = docs.count()
    labels = spark.createDataFrame([(1, 1, 1), (None, 0, None)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(spark, docs, labels).count() == n == toxicity.drop_toxic(spark, docs, labels).count()
    assert quality.quality_rules(docs).count() == n
    assert quality.drop_low_quality(docs).columns == docs.columns
    assert licenses.license_scan(docs).count() == 0
    packed = rows(packing.pack(spark, docs))
    assert sum(b["n_tokens"] for b in packed) == (60_006 if n else 0)
    assert simhash.near_duplicate_groups(spark, docs).count() == 0
    assert simhash.drop_near_duplicates(spark, docs).count() == (n - 1 if n else 0)
    assert shards.training_order(spark, docs).count() == (60_000 // 512 + 1 + 2 + 2 if n else 0)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(spark, vectors).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_diff.page_differences(spark, pages).count() == 0 and warc.captures(spark, pages).count() == 0
