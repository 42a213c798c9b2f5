"""Training-order materialisation: token sequences in fixed-stride binary shards, ordered by a keyed permutation.

Order. A first pass counts the sequences of every task, so each sequence has an index from 0 to n - 1: its place in the
table as it is read. A Feistel network over the next power of four, applied again until the value is below n (cycle
walking), permutes these indexes under a key: the result is the sequence's global slot. Shard k holds the slots from
k * rows to (k + 1) * rows, so a sequence's file and its place there follow from its slot by division, and one shuffle is
enough. The order depends on the key, and on the order in which the table is read, which stays the same for the same files.

Both passes must read the same rows in the same tasks. The second one compares what it reads with the counts and a
checksum of the first, and a shard is written only if it holds exactly its slots; if a table doesn't hold still, or
executors were lost in between and tasks are cut otherwise, it is written down first and read from there.

Shard. Records of stride 16 + 2 * seq_len bytes, little endian: doc_id int64, seq int32, n_tokens int32, tokens uint16,
filled up with the end token. A shard is written under another name and renamed, so a task that runs again, or twice,
leaves the same file. Reading from any slot takes one seek.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.llm.bpe import VOCABULARY, Encoder, encoded_slices, load_shipped, ship, token_counts
from quillmill.llm.ragged import U64, mix64
from quillmill.llm.scratch import Scratch

SEQ_LEN, END_TOKEN, KEY, ROUNDS = 512, 50_256, 0x5EED, 6
#: Sequences of a shard.
SHARD_ROWS = 1 << 15
#: Times that the two passes are tried.
ATTEMPTS = 3


def record_type(seq_len: int) -> np.dtype:
    return np.dtype([("doc_id", "<i8"), ("seq", "<i4"), ("n_tokens", "<i4"), ("tokens", "<u2", (seq_len,))])


def _feistel(x: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    mask = U64((1 << half) - 1)
    left, right = x >> U64(half), x & mask
    for key in keys:
        left, right = right, left ^ (mix64(right + U64(key)) & mask)
    return left << U64(half) | right


def round_keys(key: int, rounds: int = ROUNDS) -> list[int]:
    return mix64(np.arange(1, rounds + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) ^ U64(key)).tolist()


def permute(index: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """A permutation of range(size), applied to some indexes; size is at most 2**62."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    keys = round_keys(key)
    out = _feistel(index.astype(U64), half, keys)
    while len(walk := np.flatnonzero(out >= U64(size))):
        out[walk] = _feistel(out[walk], half, keys)
    return out.astype(np.int64)


def _records(docs: np.ndarray, tokens: np.ndarray, offsets: np.ndarray, seq_len: int) -> np.ndarray:
    """Every document's tokens and an end token, cut into sequences."""
    lengths = np.diff(offsets) + 1
    ended = np.full(len(tokens) + len(docs), END_TOKEN, np.uint16)
    ended[np.arange(len(tokens)) + np.repeat(np.arange(len(docs)), lengths - 1)] = tokens
    pieces = -(-lengths // seq_len)
    of_doc = np.repeat(np.arange(len(docs)), pieces)
    seq = np.arange(len(of_doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    out = np.zeros(len(of_doc), record_type(seq_len))
    out["doc_id"], out["seq"] = docs[of_doc], seq
    out["n_tokens"] = np.minimum(seq_len, lengths[of_doc] - seq * seq_len)
    begin = (offsets[:-1] + np.arange(len(docs)))[of_doc] + seq * seq_len
    column = np.arange(seq_len)
    ended = np.concatenate([ended, np.full(seq_len, END_TOKEN, np.uint16)])
    for a in range(0, len(out), 4096):
        part = out[a : a + 4096]
        part["tokens"] = np.where(column < part["n_tokens"][:, None], ended[begin[a : a + 4096, None] + column], END_TOKEN)
    return out


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def _shard_name(shard: int) -> str:
    return f"shard-{shard:07d}.bin"


def _checksum(before: int, docs: np.ndarray, pieces: np.ndarray) -> int:
    return zlib.crc32(np.stack([docs, pieces]).astype("<i8").tobytes(), before)


def _no_nulls(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str]]:
    return batch.column(0).to_numpy(), batch.column(1).to_pylist()


def sequences_of_tasks(rows: DataFrame, vocabulary: str, seq_len: int) -> dict[int, tuple[int, int, int]]:
    """Of every task that reads rows (doc_id, text): the index of its first sequence, their number, and a checksum."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, n, checksum = Encoder(load_shipped(vocabulary)), 0, 0
        for batch in batches:
            docs, texts = _no_nulls(batch)
            pieces = token_counts(encoder, texts) // seq_len + 1  # with the end token
            n, checksum = n + int(pieces.sum()), _checksum(checksum, docs, pieces)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64()), pa.array([checksum], pa.int64())], names=["task", "n", "checksum"])

    # A row per task comes to the driver, whatever the tasks hold.
    found = sorted(map(tuple, rows.mapInArrow(count, "task int, n long, checksum long").collect()))
    begin, out = 0, {}
    for task, n, checksum in found:
        out[task] = (begin, n, checksum)
        begin += n
    return out


def _placed(rows: DataFrame, tasks: dict[int, tuple[int, int, int]], vocabulary: str, seq_len: int, key: int, shard_rows: int) -> DataFrame:
    """(shard, blob): the sequences of every task by shard, each with its slot."""
    total = sum(n for _, n, _ in tasks.values())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pack = Encoder(load_shipped(vocabulary)), zstandard.ZstdCompressor(level=5)
        begin, expected, expected_sum = tasks.get(TaskContext.get().partitionId(), (0, 0, 0))
        n = checksum = 0
        for batch in batches:
            docs, texts = _no_nulls(batch)
            sizes = []
            for a, b, tokens, offsets in encoded_slices(encoder, texts):
                records = _records(docs[a:b], tokens, offsets, seq_len)
                sizes.append(np.diff(offsets) // seq_len + 1)
                if n + len(records) > expected:
                    raise ValueError("the table has changed between two passes")
                slot = permute(np.arange(begin + n, begin + n + len(records)), total, key)
                n += len(records)
                shard = slot // shard_rows
                order = np.argsort(shard, kind="stable")
                records, slot, shard = records[order], slot[order], shard[order]
                at = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
                blobs = [pack.compress(slot[i:j].tobytes() + records[i:j].tobytes()) for i, j in zip(at, [*at[1:], len(shard)])]
                yield pa.RecordBatch.from_arrays([pa.array(shard[at].astype(np.int32)), pa.array(blobs, pa.binary())], names=["shard", "blob"])
            checksum = _checksum(checksum, docs, np.concatenate(sizes) if sizes else np.zeros(0, np.int64))
        if (n, checksum) != (expected, expected_sum):
            raise ValueError("the table has changed between two passes")

    return rows.mapInArrow(cut, "shard int, blob binary")


def write_shards(spark: SparkSession, docs: DataFrame, out_dir: str, seq_len: int = SEQ_LEN, key: int = KEY, vocabulary: str = VOCABULARY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Writes the shards and returns the manifest: (shard, path, rows, first_slot).

    A document gives its tokens and an end token, so an empty text gives one sequence. Rows with a null doc_id or text
    are left out. Repeated rows are written as often as they occur, and texts of any length whole. An empty table gives
    no shard. Other columns aren't read. On a cluster out_dir must be a URI that all executors share.
    """
    if "://" not in out_dir and not out_dir.startswith("file:") and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("out_dir must be a URI of a folder that all executors share")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).dropna()
    scratch, name = Scratch(spark, "shards"), ship(spark, vocabulary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = record_type(seq_len)
        system, root = _filesystem(out_dir)
        unpack = zstandard.ZstdDecompressor()

        def flush(shard: int, blobs: list[bytes]) -> pa.RecordBatch:
            parts = [unpack.decompress(x) for x in blobs]
            n = [len(x) // (8 + kind.itemsize) for x in parts]
            slot = np.concatenate([np.frombuffer(x, np.int64, k) for x, k in zip(parts, n)])
            records = np.concatenate([np.frombuffer(x, kind, k, 8 * k) for x, k in zip(parts, n)])
            order = np.argsort(slot)
            first = shard * shard_rows
            if not np.array_equal(slot[order], np.arange(first, min(first + shard_rows, total))):
                raise ValueError(f"shard {shard} doesn't hold each of its slots once")
            path = f"{root}/{_shard_name(shard)}"
            with system.open_output_stream(draft := f"{path}.{uuid.uuid4().hex}") as f:
                for a in range(0, len(order), 4096):
                    f.write(records[order[a : a + 4096]].tobytes())
            system.move(draft, path)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([f"{out_dir}/{_shard_name(shard)}"]), pa.array([len(order)], pa.int64()), pa.array([first], pa.int64())], names=["shard", "path", "rows", "first_slot"])

        system.create_dir(root, recursive=True)
        current, held = None, []
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if shard != current and held:
                    yield flush(current, held)
                    held = []
                current = shard
                held.append(blob)
        if held:
            yield flush(current, held)

    schema = "shard int, path string, rows long, first_slot long"
    for attempt in range(ATTEMPTS):
        tasks = sequences_of_tasks(rows, name, seq_len)
        total = sum(n for _, n, _ in tasks.values())
        if not total:
            return spark.createDataFrame([], schema)
        shards = -(-total // shard_rows)
        parts = min(shards, 20_000)
        placed = _placed(rows, tasks, name, seq_len, key, shard_rows).repartitionById(parts, F.expr(f"cast(shard div {-(-shards // parts)} as int)"))
        if shards > parts:
            placed = placed.sortWithinPartitions("shard")
        try:
            return scratch.write(placed.mapInArrow(write, schema), f"manifest{attempt}")
        except Exception as e:  # noqa: BLE001 - what a task raised comes as one of several kinds
            if attempt + 1 == ATTEMPTS or "between two passes" not in str(e):
                raise
            rows = scratch.write(rows, f"rows{attempt}")
    raise AssertionError


def read_records(path: str, seq_len: int, begin: int = 0, rows: int | None = None) -> np.ndarray:
    """Records of one shard from a place on, by one seek."""
    system, at = _filesystem(path)
    kind = record_type(seq_len)
    with system.open_input_file(at) as f:
        f.seek(begin * kind.itemsize)
        return np.frombuffer(f.read(None if rows is None else rows * kind.itemsize), kind)


def read_shards(manifest: DataFrame, seq_len: int = SEQ_LEN, from_slot: int = 0) -> DataFrame:
    """(slot, shard, byte_offset, doc_id, seq, n_tokens, token_ids) from a global slot on, in files read front to back."""
    kind = record_type(seq_len)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path, rows, first in zip(*(c.to_pylist() for c in batch.columns)):
                begin = max(0, from_slot - first)
                for a in range(begin, rows, 8192):
                    got = read_records(path, seq_len, a, min(8192, rows - a))
                    at = np.arange(a, a + len(got))
                    used = np.arange(seq_len) < got["n_tokens"][:, None]
                    offsets = np.concatenate([[0], np.cumsum(got["n_tokens"])]).astype(np.int32)
                    tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(got["tokens"][used].astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(first + at), pa.array(np.full(len(got), shard, np.int32)), pa.array(at * kind.itemsize), *(pa.array(np.ascontiguousarray(got[c])) for c in ("doc_id", "seq", "n_tokens")), tokens],
                        names=["slot", "shard", "byte_offset", "doc_id", "seq", "n_tokens", "token_ids"],
                    )

    wanted = manifest.where(F.col("first_slot") + F.col("rows") > from_slot).select("shard", "path", "rows", "first_slot")
    schema = "slot long, shard int, byte_offset long, doc_id long, seq int, n_tokens int, token_ids array<int>"
    # The manifest is small, its files are not: a task for each of them.
    return wanted.repartition(max(1, min(manifest.count(), 20_000)), "shard").mapInArrow(run, schema)


def training_order(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Writes shards into the shared folder and returns every sequence as read from them, with its global slot.

    For nulls, empty, long and repeated texts, empty tables and other columns see write_shards.
    """
    manifest = write_shards(spark, docs, Scratch(spark, "sequences").path("bin"), **options)
    return read_shards(manifest, options.get("seq_len", SEQ_LEN))
