"""Best-fit packing of documents into bins of a fixed number of tokens, by rounds over a tree of groups.

Round 0: the documents are split into groups by a hash of their id, length and number among equal rows, and each group is
packed best fit, longest first. Bins that are nearly full are done. The others become items themselves; in each later
round neighbouring groups are merged, as many as keep a group at `group_items` items, and packed again, until one group
is left. Where so few bins are done that no two groups fit into one task, the tree ends: each group then holds a great
many bins, and merging them would save about one bin per group.

A document longer than a bin gives as many full bins as it fills; what remains is an item. Nothing is cut off: the
pieces of a document cover all its tokens.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillmill.llm.scratch import Scratch

CAPACITY = 2048
#: A bin with at most this share of free tokens is done.
FREE_SHARE = 0.01
#: Items of a group, on average. A task holds one group at a time, whatever the table holds.
GROUP_ITEMS = 20_000
#: Tasks of a round at most; a task packs several groups, one after the other.
MOST_TASKS = 20_000
#: Equal rows that one task writes out in one go.
COPIES_AT_ONCE = 1 << 20

_ITEM = "bin long, n_tokens int, items array<struct<doc_id:long,start:long,length:int>>"


def token_count(text: Column) -> Column:
    """Words and punctuation marks: the pieces of the tokenizer that needs no vocabulary."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{M}]+|\p{N}+|[^\s\p{L}\p{M}\p{N}]"))


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of every item, items taken longest first, each put where the least room remains.

    Bins with equal room are taken last in, first out. Free space is a bitmap of the amounts of room that occur.
    """
    order = np.argsort(-lengths, kind="stable")
    out = np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = bins = 0
    for i in order.tolist():
        n = int(lengths[i])
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            found = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, found = capacity, bins
            bins += 1
        out[i] = found
        left = room - n
        if left:
            by_room[left].append(found)
            rooms |= 1 << left
    return out


def _pack_group(rows: pd.DataFrame, capacity: int, limit: int, last: bool) -> pd.DataFrame:
    """Packs the items of a group; bins with more than `limit` tokens are done."""
    rows = rows.assign(first=[x[0]["start"] for x in rows["items"]], size=rows["items"].str.len())
    rows = rows.sort_values(["n_tokens", "bin", "first", "size"], ascending=[False, True, True, True], kind="stable")
    at = best_fit(rows.n_tokens.to_numpy(), capacity)
    order = np.argsort(at, kind="stable")
    cuts = np.flatnonzero(np.diff(at[order], prepend=-1)).tolist() + [len(at)]
    names, lengths, items = rows.bin.to_numpy()[order], rows.n_tokens.to_numpy()[order], rows["items"].to_numpy()[order]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        n = int(lengths[a:b].sum())
        out.append((int(names[a:b].min()), n, [x for one in items[a:b] for x in one], last or n > limit))
    return pd.DataFrame(out, columns=["bin", "n_tokens", "items", "done"])


def _packer(capacity: int, limit: int, last: bool):
    def run(key, rows):
        return _pack_group(rows, capacity, limit, last).assign(g=int(key[0]))

    return run


def _each_copy(rows: DataFrame, most: int) -> DataFrame:
    """rows (…, copies) as often as copies says, with the number of the copy; most is the greatest of copies.

    Long runs are made in pieces, which tasks share.
    """
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES_AT_ONCE}"))))
    if most > COPIES_AT_ONCE:
        pieces = pieces.repartition("doc_id", "n", "piece")
    begin, end = F.col("piece") * COPIES_AT_ONCE + 1, F.least("copies", (F.col("piece") + 1) * COPIES_AT_ONCE)
    return pieces.withColumn("copy", F.explode(F.sequence(begin, end))).drop("piece", "copies")


def pack(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, length: Column | None = None, group_items: int = GROUP_ITEMS) -> DataFrame:
    """One row per bin: (n_tokens, doc_ids, items); items are (doc_id, start, length) in tokens, in the order of the bin.

    Rows with a null doc_id, and texts that are null, empty or without a token, have nothing to pack and are left out.
    Repeated rows are packed as often as they occur, and texts of any length. No document gives no bin. Of items of equal
    length the one with the least doc_id is placed first. Other columns aren't read. The result depends on ids and lengths
    alone, not on how the table is laid out.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    scratch = Scratch(spark, "packing")
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (token_count(F.col("text")) if length is None else length).cast("long").alias("n")).where("doc_id IS NOT NULL AND n > 0")
    # Equal rows are numbered, so that a document that is repeated very often is spread over groups as well.
    counted = scratch.write(counted.groupBy("doc_id", "n").agg(F.count("*").alias("copies")), "lengths")
    most = counted.agg(F.coalesce(F.max("copies"), F.lit(0))).first()[0]
    pieces = _each_copy(counted.where(f"n >= {capacity}"), most).select("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), F.expr(f"n div {capacity}"))).alias("k"))
    full = pieces.select(
        F.lit(capacity).alias("n_tokens"),
        F.array(F.struct(F.col("doc_id"), ((F.col("k") - 1) * capacity).alias("start"), F.lit(capacity).alias("length"))).alias("items"),
    )
    rest = counted.where(f"n % {capacity} > 0")
    left = int(rest.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0])
    groups = max(1, -(-left // group_items))
    item = F.struct(F.col("doc_id"), F.expr(f"n - n % {capacity}").alias("start"), F.expr(f"cast(n % {capacity} as int)").alias("length"))
    one = _each_copy(rest, most)
    # An item is named after its least doc_id; names only settle ties of length.
    current = one.select(F.pmod(F.xxhash64("doc_id", "n", "copy"), F.lit(groups)).alias("g"), F.col("doc_id").alias("bin"), F.expr(f"cast(n % {capacity} as int)").alias("n_tokens"), F.array(item).alias("items"))
    limit = int(capacity * (1 - FREE_SHARE))
    out, k = full, 0
    while True:
        last = groups == 1
        packed = current.repartition(min(groups, MOST_TASKS), "g").groupBy("g").applyInPandas(_packer(capacity, limit, last), f"{_ITEM}, done boolean, g long")
        packed = scratch.write(packed, f"round{k}", ["done"])
        out = out.unionByName(packed.where("done").select("n_tokens", "items"))
        if last:
            break
        rest = packed.where("NOT done")
        left = rest.count()
        merged = max(1, -(-left // group_items))
        if not left or merged == groups:
            out = out.unionByName(rest.select("n_tokens", "items"))
            break
        current = rest.select(F.expr(f"g * {merged}L div {groups}L").alias("g"), "bin", "n_tokens", "items")
        groups, k = merged, k + 1
    return out.select("n_tokens", F.col("items.doc_id").alias("doc_ids"), "items")
