"""Exact top-k search by histogram selection: a stated set of queries, in blocks, against all rows.

Cosine scores are rounded to six decimals, so that a score is one of 2,000,001 whole numbers and equal scores are
equal on every machine. Vectors are held in blocks; each pass scores every pair of blocks anew:

1. coarse histogram: per query, the counts of scores in bins of 1024 values. A pair of blocks reports only bins from
   its own k-th score up, since the k-th score overall can't be lower. Added up, they show the bin of the k-th score.
2. fine histogram: the counts of single values within that bin show the k-th score itself.
3. filter: scores above the k-th score, and as many of those equal to it as are missing, least ids first.

Work is the product of queries and rows, which an exact search can't avoid; what is shuffled is linear in queries times
blocks of rows, never the scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quillmill.llm.scratch import Scratch

K, BLOCK_ROWS, QUERY_ROWS = 10, 4096, 1024
#: Rows whose id is divisible by this are queries.
QUERY_EVERY = 20
SCALE, SHIFT = 1_000_000, 10
_LEAST = -2 * SCALE
#: Rows of a block that are scored at a time.
STRIP = 256


def valid_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int | None = None) -> DataFrame:
    """(vec_id, embedding) of rows that can be compared, one per id.

    Left out: null ids and vectors, vectors with a null, NaN or infinite entry, vectors of length zero, and those of
    another dimension than `dim` (by default the commonest one, the least of several). Of rows that share an id, the
    one with the least vector counts.
    """
    v = F.col("embedding")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("embedding")).dropna()
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.where(good)
    if dim is None:
        commonest = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
        dim = commonest.dim if commonest else 0
    return rows.where(F.size("embedding") == dim).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _packed(key, rows):
    rows = rows.sort_values("vec_id")
    matrix = np.stack(rows.embedding.to_numpy()).astype("<f4") if len(rows) else np.zeros((0, 0), "<f4")
    return pd.DataFrame({"block": [int(key[0])], "ids": [rows.vec_id.to_numpy("<i8").tobytes()], "matrix": [matrix.tobytes()]})


def _unit(ids: bytes, matrix: bytes) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, "<i8")
    m = np.frombuffer(matrix, "<f4").reshape(len(names), -1).astype(np.float64)
    return names, m / np.sqrt((m * m).sum(1, keepdims=True))


def _scores(q: np.ndarray, q_ids: np.ndarray, v: np.ndarray, v_ids: np.ndarray) -> np.ndarray:
    got = q @ v.T
    got *= SCALE
    np.rint(got, out=got)
    whole = got.astype(np.int32)
    at = np.minimum(np.searchsorted(v_ids, q_ids), len(v_ids) - 1)
    itself = np.flatnonzero(v_ids[at] == q_ids)
    whole[itself, at[itself]] = _LEAST
    return whole


def _entries(rows: np.ndarray, values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs and how often each occurs."""
    key, count = np.unique(rows.astype(np.int64) * base + values, return_counts=True)
    return key // base, key % base, count


def _coarse(strip: np.ndarray, k: int, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = ((strip + SCALE) >> SHIFT).astype(np.int16)  # a row itself falls below all bins
    if bins.shape[1] > k:
        floor = np.partition(bins, bins.shape[1] - k, axis=1)[:, bins.shape[1] - k]
    else:
        floor = np.zeros(len(bins), np.int16)
    rows, columns = np.nonzero(bins >= np.maximum(floor, 0)[:, None])
    return _entries(rows, bins[rows, columns], 1 << 12)


def _fine(strip: np.ndarray, k: int, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = (state[:, 0] << SHIFT) - SCALE
    rows, columns = np.nonzero((strip >= low[:, None]) & (strip < (low + (1 << SHIFT))[:, None]))
    return _entries(rows, strip[rows, columns] - low[rows], 1 << SHIFT)


def _pass(pairs: DataFrame, k: int, step: Callable) -> DataFrame:
    """One histogram per pair of blocks: (block, entries)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for qb, q_ids, q_matrix, q_state, _, v_ids, v_matrix in zip(*(c.to_pylist() for c in batch.columns)):
                (qn, q), (vn, v) = _unit(q_ids, q_matrix), _unit(v_ids, v_matrix)
                state = np.frombuffer(q_state, "<i4").reshape(len(qn), 2)
                found = []
                for a in range(0, len(qn), STRIP):
                    part = slice(a, a + STRIP)
                    row, value, count = step(_scores(q[part], qn[part], v, vn), k, state[part])
                    found.append(np.stack([row + a, value, count], 1).astype("<i4"))
                entries = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array([qb], pa.int64()), pa.array([entries.tobytes()], pa.binary())], names=["block", "entries"])

    return pairs.mapInArrow(run, "block long, entries binary")


def _selector(k: int, fine: bool):
    """Adds the histograms of a block of queries up and finds where the k-th score lies.

    State per query: the bin, or at last the value, of the k-th score; and how many scores exceed it. Where a query has
    fewer than k scores, it is the least one.
    """

    def run(key, rows):
        entries = np.concatenate([np.frombuffer(x, "<i4").reshape(-1, 3) for x in rows.entries])
        old = np.frombuffer(rows.state.iloc[0], "<i4").reshape(-1, 2)
        order = np.lexsort([-entries[:, 1], entries[:, 0]])
        row, value, count = entries[order].T.astype(np.int64)
        out = np.zeros_like(old)
        out[:, 0] = 0 if not fine else (old[:, 0] << SHIFT) - SCALE
        bounds = np.searchsorted(row, np.arange(len(old) + 1))
        upto = np.concatenate([[0], np.cumsum(count)])
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if a == b:
                continue
            above = int(old[i, 1]) if fine else 0
            at = min(b - 1, int(np.searchsorted(upto[a + 1 : b + 1], upto[a] + k - above)) + a)
            first = a + int(np.searchsorted(-value[a:b], -value[at]))  # other blocks may hold the same value
            out[i] = (value[at] + ((int(old[i, 0]) << SHIFT) - SCALE if fine else 0), above + upto[first] - upto[a])
        return pd.DataFrame({"block": [int(key[0])], "state": [out.astype("<i4").tobytes()]})

    return run


def _filtered(pairs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for qb, q_ids, q_matrix, q_state, _, v_ids, v_matrix in zip(*(c.to_pylist() for c in batch.columns)):
                (qn, q), (vn, v) = _unit(q_ids, q_matrix), _unit(v_ids, v_matrix)
                state = np.frombuffer(q_state, "<i4").reshape(len(qn), 2)
                for a in range(0, len(qn), STRIP):
                    part = slice(a, a + STRIP)
                    strip = _scores(q[part], qn[part], v, vn)
                    least, missing = state[part, 0], k - state[part, 1]
                    row, column = np.nonzero(strip >= np.maximum(least, -SCALE)[:, None])
                    got = strip[row, column]
                    tied = got == least[row]
                    # Ids ascend within a block: of its ties, the first ones that are missing may be needed.
                    before = np.cumsum(tied) - tied
                    begin = np.searchsorted(row, np.arange(len(least)))
                    rank = before - np.concatenate([before, [0]])[begin][row]
                    keep = ~tied | (rank < missing[row])
                    row, column, got = row[keep], column[keep], got[keep]
                    yield pa.RecordBatch.from_arrays([pa.array(qn[part][row]), pa.array(vn[column]), pa.array(got)], names=["query_id", "vec_id", "whole"])

    return pairs.mapInArrow(run, "query_id long, vec_id long, whole int")


def _blocks(rows: DataFrame, n: int, block_rows: int) -> DataFrame:
    """(block, ids, matrix): rows in blocks by a hash of their id."""
    blocks = max(1, -(-n // block_rows))
    keyed = rows.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("long"))
    return keyed.groupBy("b").applyInPandas(_packed, "block long, ids binary, matrix binary")


def top_k(spark: SparkSession, vectors: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", every: int = QUERY_EVERY, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id is divisible by `every`, the k most similar other rows.

    score is the cosine rounded to six decimals; equal scores are ranked by vec_id. With fewer than k + 1 rows all the
    others are returned; no query, a single row or none gives an empty table. See valid_vectors for rows that can't take
    part. Other columns aren't read.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    scratch = Scratch(spark, "topk")
    rows = scratch.write(valid_vectors(vectors, id_col, vector_col), "rows")
    asked = rows.where(F.col("vec_id") % every == 0)
    n, n_asked = rows.count(), asked.count()
    packed = scratch.write(_blocks(rows, n, block_rows), "blocks")
    queried = scratch.write(_blocks(asked, n_asked, query_rows), "queries")
    # A number given by hand keeps the pairs of blocks apart: they are short of bytes, but not of work.
    spread = lambda df, key, n, size: df.repartition(min(max(1, -(-n // size)), 4096), key)
    side = spread(packed.select(F.col("block").alias("v_block"), F.col("ids").alias("v_ids"), F.col("matrix").alias("v_matrix")), "v_block", n, block_rows)

    def pairs(queries: DataFrame) -> DataFrame:
        return spread(queries.select("block", "ids", "matrix", "state"), "block", n_asked, query_rows).crossJoin(side)

    zero = F.expr("unhex(repeat('00', cast(length(ids) as int)))")  # two whole numbers of four bytes per id of eight
    queries = queried.withColumn("state", zero)
    for fine, step in ((False, _coarse), (True, _fine)):
        histograms = _pass(pairs(queries), k, step).join(queries.select("block", "state"), "block")
        state = scratch.write(histograms.groupBy("block").applyInPandas(_selector(k, fine), "block long, state binary"), f"state{int(fine)}")
        queries = queried.join(state, "block")
    found = _filtered(pairs(queries), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("whole"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", (F.col("whole") / F.lit(float(SCALE))).alias("score"))


def top_k_sql(k: int = K, every: int = QUERY_EVERY) -> str:
    """The same over a table of valid vectors without repeated ids."""
    return f"""
        WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, round(list_cosine_similarity(a.e, b.e), 6) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {every} = 0),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}
    """
