"""Near duplicates by SimHash: a binary trie of fingerprints is joined with itself.

Fingerprint: 128 bits, each the majority vote over the distinct words of a text (runs of letters and digits, lower
case). Two texts are near duplicates if their fingerprints differ in at most `budget` bits; groups are the connected
components of that relation.

Join: the bits are cut into `blocks` blocks. If two fingerprints differ in at most `budget` bits, then some block holds
at most budget // blocks of them, so the trie is built once per block with that block's bits on top. A traversal starts
with the pair (root, root), goes down in both nodes at once, adds up the bits in which the two paths differ, and drops
a pair of nodes as soon as the sum exceeds what the block, or below the block the whole fingerprint, allows. Where the
two nodes hold few fingerprints, these are compared directly. Every pair within the budget is met; nothing is capped.

Distribution: the top levels of the traversal are unrolled into keys (block, node, node), so that each task gets the
fingerprints below one pair of nodes. Bits of fingerprints are biased, so the depth of the nodes follows from counted
sizes, and nodes that are too large even so are cut into chunks, every two of which meet in a task. Tasks return a spanning forest of the pairs that they find, and how
many links each fingerprint has; a pair met in several blocks counts in the first. So their output is linear however
large a group is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quillmill.llm.components import connected_components
from quillmill.llm.joins import with_ids
from quillmill.llm.ragged import LETTER, NUMBER, U64, char_classes, code_points, cut_text, mix64, slices_of, span_hashes, word_spans
from quillmill.llm.scratch import Scratch

BITS, BUDGET, BLOCKS = 128, 20, 7
#: Distinct fingerprints below one node of the top levels, or in one chunk of a larger one; a task holds two of them.
NODE_SIZE = 1 << 17
#: Characters hashed at a time, and words voting at a time.
SLICE_CHARS, VOTE_WORDS = 1 << 18, 1 << 14
LEAF_PAIRS = 16
#: Pairs of nodes, and twice as many pairs of fingerprints, held at a time; the rest wait their turn.
FRONTIER = 1 << 17


def _votes(words: np.ndarray) -> np.ndarray:
    """Bits set among the 128 of each word's hash."""
    total = np.zeros(BITS, np.int64)
    for k in range(0, len(words), VOTE_WORDS):
        part = words[k : k + VOTE_WORDS]
        pair = np.stack([mix64(part ^ U64(0x243F6A8885A308D3)), mix64(part ^ U64(0x13198A2E03707344))], 1)
        total += np.unpackbits(pair.view(np.uint8).reshape(-1, 16), axis=1).sum(0, dtype=np.int64)
    return total


def fingerprint_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints as (n, 2) words of 64 bits, and which texts have one. Blank texts have none.

    A text with characters but no word counts as one feature, so that its exact copies still agree. Long texts are
    hashed in parts, so memory doesn't grow with them but for the hashes of their words.
    """
    owners, parts = [], []
    for i, text in enumerate(texts):
        for part in cut_text(text.lower(), SLICE_CHARS):
            owners.append(i)
            parts.append(part)
    words: list[list[np.ndarray]] = [[] for _ in texts]
    for a, b in slices_of([len(p) for p in parts], SLICE_CHARS):
        cps, bounds = code_points(parts[a:b])
        kinds = char_classes()[cps]
        starts, ends = word_spans((kinds == LETTER) | (kinds == NUMBER))
        hashes = span_hashes(cps, starts, ends)
        at = np.searchsorted(starts, bounds)
        for k in np.flatnonzero(at[1:] > at[:-1]).tolist():
            words[owners[a + k]].append(np.unique(hashes[at[k] : at[k + 1]]))
    out, has = np.zeros((len(texts), 2), U64), np.zeros(len(texts), bool)
    for i, (text, found) in enumerate(zip(texts, words)):
        if not found:
            if not text.strip():
                continue
            found = [np.array([xxhash.xxh3_64_intdigest(text.lower().encode("utf-8", "surrogatepass"))], U64)]
        features = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        out[i] = np.packbits(_votes(features) * 2 > len(features)).view(U64)
        has[i] = True
    return out, has


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for a, b in slices_of(pc.utf8_length(texts).to_pylist(), 4 * SLICE_CHARS):
            prints, has = fingerprint_texts(texts.slice(a, b - a).to_pylist())
            keep = np.flatnonzero(has)
            words = prints[keep].view(np.int64)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(keep + a)), pa.array(words[:, 0]), pa.array(words[:, 1])], names=["doc_id", "h0", "h1"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h0, h1) of every row that has an id and a text that isn't blank."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).dropna()
    return rows.mapInArrow(_fingerprint_batches, "doc_id long, h0 long, h1 long")


def _masks(depth: int, most: int) -> list[int]:
    return [m for m in range(1 << depth) if m.bit_count() <= most]


def _rotations(prints: DataFrame, blocks: int) -> DataFrame:
    """One row per block, with that block's bits first in (hi, lo)."""
    turned = []
    for r in range(blocks):
        shift = BITS * r // blocks
        a, b = (F.col("h0"), F.col("h1")) if shift < 64 else (F.col("h1"), F.col("h0"))
        s = shift % 64
        hi, lo = (a, b) if not s else (F.shiftleft(a, s).bitwiseOR(F.shiftrightunsigned(b, 64 - s)), F.shiftleft(b, s).bitwiseOR(F.shiftrightunsigned(a, 64 - s)))
        turned.append(F.struct(F.lit(r).alias("r"), hi.alias("hi"), lo.alias("lo")))
    return prints.select("node", "n", F.explode(F.array(*turned)).alias("x")).select("node", "n", "x.*")


class _Forest:
    """Union-find over positions, for many pairs at once."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        p = self.parent
        while len(a):
            a, b = p[a], p[b]
            different = a != b
            a, b = a[different], b[different]
            np.minimum.at(p, np.maximum(a, b), np.minimum(a, b))
            while True:
                shorter = p[p]
                if np.array_equal(shorter, p):
                    break
                p[:] = shorter


def _earlier_blocks(block: int, blocks: int) -> list[tuple[np.uint64, np.uint64]]:
    """Where the bits of the blocks before this one lie in codes with this block on top, as masks of both words."""
    out = []
    for k in range(block):
        begin, end = (BITS * j // blocks - BITS * block // blocks + BITS for j in (k, k + 1))
        mask = sum(1 << (BITS - 1 - i) for i in range(begin, end))
        out.append((U64(mask >> 64), U64(mask & (1 << 64) - 1)))
    return out


def trie_join(a: np.ndarray, b: np.ndarray | None, block: int, depth: int, blocks: int = BLOCKS, budget: int = BUDGET, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forest of the pairs within the budget, as (position, root), among codes or between two sorted sets of codes; and
    the links of every position: the weights of its partners in pairs that no earlier block meets.

    Codes are (n, 2) words, sorted, with the block on top. a and b are the codes below two nodes at `depth`; b is None
    if it is one node. Positions in b count on from those in a. A weight is 1 unless given.
    """
    width = BITS * (block + 1) // blocks - BITS * block // blocks
    allowed = budget // blocks
    earlier = _earlier_blocks(block, blocks)
    codes = a if b is None else np.concatenate([a, b])
    hi, lo = codes[:, 0].copy(), codes[:, 1].copy()
    forest, n = _Forest(len(codes)), len(a)
    links = np.zeros(len(codes), np.int64)
    weight = np.ones(len(codes), np.int64) if weight is None else weight
    if not n or len(codes) == n and b is not None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), links
    start = (np.array([0]), np.array([n]), np.array([0 if b is None else n]), np.array([n if b is None else len(codes)]))
    begun = int(np.bitwise_count((hi[0] ^ hi[n]) >> U64(64 - depth))) if depth and b is not None else 0
    ones: dict[int, np.ndarray] = {}

    def split(level: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if level not in ones:
            word, at = (hi, 63 - level) if level < 64 else (lo, 127 - level)
            ones[level] = np.concatenate([[0], np.cumsum((word >> U64(at)) & U64(1), dtype=np.int64)])
        return high - (ones[level][high] - ones[level][low])

    def compare(al, ah, bl, bh) -> None:
        size = (ah - al) * (bh - bl)
        total = np.cumsum(size)
        cut = 0
        while cut < len(size):
            upto = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + FRONTIER * 2, "right")))
            part = slice(cut, upto)
            rows = np.repeat(np.arange(cut, upto), size[part])
            k = np.arange(len(rows)) - np.repeat(total[part] - size[part] - (total[cut - 1] if cut else 0), size[part])
            wide = (bh - bl)[rows]
            i, j = al[rows] + k // wide, bl[rows] + k % wide
            good = i < j
            i, j = i[good], j[good]
            x, y = hi[i] ^ hi[j], lo[i] ^ lo[j]
            near = np.bitwise_count(x) + np.bitwise_count(y) <= budget
            i, j, x, y = i[near], j[near], x[near], y[near]
            forest.add(i, j)
            new = np.bitwise_count(x >> U64(64 - width)) <= allowed  # fingerprints compared early may differ more in this block
            for high, low in earlier:
                new &= np.bitwise_count(x & high) + np.bitwise_count(y & low) > allowed
            np.add.at(links, i[new], weight[j[new]])
            np.add.at(links, j[new], weight[i[new]])
            cut = upto

    stack = [(depth, *start, np.array([begun]))]
    while stack:
        level, al, ah, bl, bh, err = stack.pop()
        if len(al) > FRONTIER:
            half = len(al) // 2
            stack += [(level, *(x[:half] for x in (al, ah, bl, bh, err))), (level, *(x[half:] for x in (al, ah, bl, bh, err)))]
            continue
        few = ((ah - al) * (bh - bl) <= LEAF_PAIRS) | (level >= BITS)
        if few.any():
            compare(al[few], ah[few], bl[few], bh[few])
            rest = ~few
            al, ah, bl, bh, err = (x[rest] for x in (al, ah, bl, bh, err))
        if not len(al):
            continue
        am, bm = split(level, al, ah), split(level, bl, bh)
        other = al != bl  # below one and the same node, (1, 0) mirrors (0, 1)
        al, ah, bl, bh, err = (
            np.concatenate(x)
            for x in (
                (al, am, al, am[other]), (am, ah, am, ah[other]), (bl, bm, bm, bl[other]), (bm, bh, bh, bm[other]), (err, err, err + 1, err[other] + 1),
            )
        )
        good = (ah > al) & (bh > bl) & (err <= (allowed if level < width else budget))
        stack.append((level + 1, *(x[good] for x in (al, ah, bl, bh, err))))
    member = np.flatnonzero(forest.parent != np.arange(len(codes)))
    return member, forest.parent[member], links


def _join_task(block: int, depth: int, itself: bool, node: np.ndarray, n_docs: np.ndarray, side: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> pd.DataFrame:
    """Rows (u, v, null) of the forest and rows (u, null, links)."""
    hi, lo = hi.view(U64), lo.view(U64)
    order = np.lexsort([lo, hi, side])
    node, weight, codes, n = node[order], n_docs[order], np.stack([hi[order], lo[order]], 1), int((side == 0).sum())
    member, root, links = trie_join(codes[:n], None if itself else codes[n:], block, depth, weight=weight)
    linked = np.flatnonzero(links)
    edge = np.arange(len(member) + len(linked)) < len(member)
    u, v = np.concatenate([node[member], node[linked]]), np.concatenate([node[root], np.zeros(len(linked), np.int64)])
    n_links = np.concatenate([np.zeros(len(member), np.int64), links[linked]])
    return pd.DataFrame({"u": u, "v": pd.arrays.IntegerArray(v, ~edge), "links": pd.arrays.IntegerArray(n_links, edge)})


def _top_bits(depth: int) -> Column:
    return F.shiftrightunsigned("hi", 64 - depth).cast("int") if depth else F.lit(0)


def node_sizes(turned: DataFrame, n: int, node_size: int) -> tuple[int, list[tuple[int, int, int]]]:
    """The depth of nodes, and (block, node, chunks) of those that hold more than node_size of the n fingerprints there.

    The depth is the least at which at most a tenth of the fingerprints of any block lie in such nodes. Sizes are
    counted, since bits are biased, down to 64 times as many nodes as even bits would call for. That many counts, and at most
    BLOCKS * 2**18, come to the driver.
    """
    if n <= node_size:
        return 0, []
    least = min(((n - 1) // node_size).bit_length() + 6, *(BITS * (r + 1) // BLOCKS - BITS * r // BLOCKS for r in range(BLOCKS)))
    counts = turned.groupBy("r", _top_bits(least).alias("at")).count().toArrow()
    key = counts["r"].to_numpy().astype(np.int64) << least | counts["at"].to_numpy()
    for depth in range(least + 1):
        of, at = np.unique(key >> (least - depth), return_inverse=True)
        sizes = np.bincount(at, weights=counts["count"].to_numpy(), minlength=len(of)).astype(np.int64)
        large = sizes > node_size
        share = np.bincount(of >> depth, weights=sizes * large, minlength=BLOCKS) / n
        if share.max() <= 0.1 or depth == least:
            break
    return depth, [(int(k >> depth), int(k & (1 << depth) - 1), int(-(-m // node_size))) for k, m in zip(of[large], sizes[large])]


def near_duplicate_pairs(distinct: DataFrame, n: int, node_size: int = NODE_SIZE) -> DataFrame:
    """Rows (u, v, null), a forest per task, and (u, null, links), over distinct fingerprints (node, n, h0, h1), of which there are n."""
    allowed = BUDGET // BLOCKS
    turned = _rotations(distinct, BLOCKS)
    depth, large = node_sizes(turned, n, node_size)
    masks = F.array(*map(F.lit, _masks(depth, allowed)))
    keyed = turned.withColumn("at", _top_bits(depth))
    keyed = keyed.withColumn("other", F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("at")))))
    tasks = BLOCKS * (1 << depth) * (len(_masks(depth, allowed)) + 1) // 2
    one = F.lit(1)
    if large:
        # Fewer than n / node_size rows, known here: a large node is cut into chunks, and every two chunks meet in a task.
        sizes = distinct.sparkSession.createDataFrame(large, "r int, at int, c int")
        keyed = keyed.join(F.broadcast(sizes.withColumnRenamed("c", "c_own")), ["r", "at"], "left")
        keyed = keyed.join(F.broadcast(sizes.select("r", F.col("at").alias("other"), F.col("c").alias("c_other"))), ["r", "other"], "left")
        own, other = F.coalesce("c_own", one), F.coalesce("c_other", one)
        tasks += sum(c * c for _, _, c in large)
    else:
        own = other = one
    chunk = F.pmod(F.xxhash64("node"), own).cast("int")
    partners = F.when(F.col("at") == F.col("other"), F.sequence(F.lit(0), own - 1)).otherwise(F.sequence(F.lit(0), other - 1))
    keyed = keyed.select("r", "at", "other", chunk.alias("i"), F.explode(partners).alias("j"), "node", "n", "hi", "lo")
    second = (F.col("at") > F.col("other")) | ((F.col("at") == F.col("other")) & (F.col("i") > F.col("j")))
    first = lambda x, y: F.when(second, F.col(y)).otherwise(F.col(x))
    keyed = keyed.select("r", first("at", "other").alias("a"), first("other", "at").alias("b"), first("i", "j").alias("i"), first("j", "i").alias("j"), second.cast("int").alias("side"), "node", "n", "hi", "lo")

    def run(key, rows):
        r, a, b, i, j = map(int, key)
        return _join_task(r, depth, (a, i) == (b, j), *(rows[c].to_numpy() for c in ("node", "n", "side", "hi", "lo")))

    # A number given by hand keeps the tasks apart: they are short of bytes, but not of work.
    spread = keyed.repartition(min(max(tasks, min(4 * tasks, 512)), 100_000), "r", "a", "b", "i", "j")
    return spread.groupBy("r", "a", "b", "i", "j").applyInPandas(run, "u long, v long, links long")


def near_duplicate_members(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", node_size: int = NODE_SIZE) -> DataFrame:
    """(doc_id, h0, h1, class_id, class_key, n_links, kept): a row per document and fingerprint that has a near duplicate.

    class_id is the least doc_id of the class and class_key its least fingerprint in hexadecimal digits, which tells
    classes apart even where a doc_id occurs in two. n_links is the number of other documents within the budget. kept
    marks one row of each class. Rows with a null id, a null text or a blank text are in no class. A doc_id with several
    texts gives a row per fingerprint, and repeated rows count once. An empty table gives an empty one. Ties between
    votes for a bit count as 0. Other columns aren't read.
    """
    scratch = Scratch(spark, "simhash")
    prints = scratch.write(fingerprints(docs, id_col, text_col).distinct(), "prints")
    # The numbers of nodes are settled by writing them.
    counted = prints.groupBy("h0", "h1").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).withColumn("node", F.monotonically_increasing_id())
    distinct = scratch.write(counted, "distinct")
    found = scratch.write(near_duplicate_pairs(distinct, distinct.count(), node_size), "pairs")
    labels = connected_components(found.where("v IS NOT NULL").select("u", "v"), scratch)
    links = found.where("v IS NULL").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    nodes = distinct.join(labels.withColumnRenamed("id", "node"), "node", "left").join(links, "node", "left").where("n > 1 OR label IS NOT NULL")
    nodes = scratch.write(nodes.select("h0", "h1", "rep", F.coalesce("label", "node").alias("label"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "nodes")
    classes = nodes.groupBy("label").agg(F.min("rep").alias("class_id"), F.min(F.struct("h0", "h1")).alias("k"), F.min(F.struct("rep", "h0", "h1")).alias("keep"))
    key = F.lower(F.concat(*(F.lpad(F.hex(f"k.{c}"), 16, "0") for c in ("h0", "h1"))))
    kept = F.col("keep") == F.struct(F.col("doc_id").alias("rep"), "h0", "h1")
    joined = prints.join(nodes.drop("rep").join(classes, "label"), ["h0", "h1"])
    members = scratch.write(joined.select("doc_id", "h0", "h1", "class_id", key.alias("class_key"), "n_links", kept.alias("kept")), "members")
    scratch.drop("prints", "distinct", "pairs", "nodes")
    return members


def near_duplicate_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_key, n_links) of every document that has a near duplicate: see near_duplicate_members."""
    return near_duplicate_members(spark, docs).select("doc_id", "class_id", "class_key", "n_links")


def _with_fingerprint(docs: DataFrame) -> DataFrame:
    """docs with __h0 and __h1, null for texts without a fingerprint."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            prints, has = fingerprint_texts(texts)
            words = prints.view(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(words[:, k], mask=~has) for k in (0, 1))], names=[*batch.schema.names[:-1], "__h0", "__h1"])

    return docs.select("*", F.col("text").alias("__text")).mapInArrow(run, f"{kinds}, __h0 long, __h1 long")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs without all but one row of each class of near duplicates; one with the least doc_id stays.

    Rows with a null id, a null text or a blank text all stay. Rows are told apart by doc_id and fingerprint: of rows
    that agree in both, the one with the least text stays, and a doc_id with two different texts keeps both unless
    other rows are near to them. Columns are returned as they were.
    """
    scratch = Scratch(spark, "dedup")
    gone = scratch.write(near_duplicate_members(spark, docs).where("NOT kept").select("doc_id", "h0", "h1"), "gone")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    again = scratch.write(ids.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    if again.isEmpty():
        return with_ids(docs, gone.select("doc_id"), "left_anti")
    once, more = with_ids(docs, again, "left_anti"), with_ids(docs, again, "left_semi")
    once = with_ids(once, gone.select("doc_id"), "left_anti")
    named = gone.select(F.col("doc_id").alias("__id"), F.col("h0").alias("__g0"), F.col("h1").alias("__g1"))
    more = _with_fingerprint(more.select(*docs.columns))
    more = more.join(named, (more["doc_id"] == named["__id"]) & (more["__h0"] == named["__g0"]) & (more["__h1"] == named["__g1"]), "left_anti")
    # Partial limits within the window leave a row per task, however often one is repeated.
    first = Window.partitionBy("doc_id", "__h0", "__h1").orderBy("text")
    whole = more.where("__h0 IS NOT NULL").withColumn("__r", F.row_number().over(first)).where("__r = 1")
    kept = whole.select(*docs.columns).unionByName(more.where("__h0 IS NULL").select(*docs.columns))
    return once.select(*docs.columns).unionByName(kept)
