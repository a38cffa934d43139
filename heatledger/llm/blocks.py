"""Blocks of rows in the shared folder, and the totals that blocks tell each other about their keys.

A block is some rows, about ``block_bytes`` of them, packed into one compressed value; the rows of one block come from one
input partition in a row, whatever their ids, so no key can make a block large. Blocks are written once and read
by every later pass.

To learn how often a key occurs in all blocks, each block sends its distinct keys in order with their counts, cut at equal
parts of the key space, differences instead of keys. The task of a part adds up equal keys and answers each block with
the totals of the keys it sent, in the order they were sent, so an answer needs no keys. A key sends one value for each block that has
it, however often it occurs there. A part sees all blocks' keys of its range; their number is a small multiple of that of full blocks, so its
task holds a share of a block's keys. Only parts that a block has keys for are touched, so work and messages of a block follow its
keys, not the number of parts: at most a message for each key, as many as a plain aggregation by key would send rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatledger.llm.common import batches

BLOCK = "block long, data binary"
SENT = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("data", pa.binary())])
SENT_DDL = "kind int, part int, block long, data binary"
#: Answers; the rows of block -1 carry a part's number of keys with a count and the sum of all counts instead.
TOLD = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("data", pa.binary()), ("types", pa.int64()), ("tokens", pa.int64())])
TOLD_DDL = SENT_DDL + ", types long, tokens long"


def table_of(rows: list, schema: pa.Schema) -> pa.Table:
    """Rows of tuples as a table."""
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def batch_of(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    """Rows of tuples as a batch."""
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def pack_table(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack_table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def bundle(rows: DataFrame, cut: Callable[[int, tuple], Iterator[tuple]], schema: pa.Schema, block_bytes: int) -> DataFrame:
    """Rows (block, data): what ``cut`` makes of each row and its number, packed; the last column of ``schema`` is bytes.

    Numbers of rows and blocks are distinct over the table; they hold once the result has been written.
    """

    def run(items):
        base = TaskContext.get().partitionId() << 34
        held, size, n_rows, n_blocks = [], 0, 0, 0
        for b in batches(items):
            columns = [b.column(i) for i in range(b.num_columns)]
            for i in range(b.num_rows):
                for piece in cut(base + n_rows, tuple(c[i].as_py() for c in columns)):
                    held.append(piece)
                    size += len(piece[-1]) + 64
                    if size >= block_bytes:
                        yield pa.RecordBatch.from_pydict({"block": pa.array([base + n_blocks], pa.int64()), "data": [pack_table(table_of(held, schema))]})
                        held, size, n_blocks = [], 0, n_blocks + 1
                n_rows += 1
        if held:
            yield pa.RecordBatch.from_pydict({"block": pa.array([base + n_blocks], pa.int64()), "data": [pack_table(table_of(held, schema))]})

    return rows.mapInArrow(run, BLOCK)


def tallied(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the sum of each one's counts, and the place among them of each key given."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))[: len(keys)]
    first = np.flatnonzero(new)
    distinct = ordered[first]
    del ordered  # blocks are large and their tasks' memory is not
    sums = np.add.reduceat(counts[order], first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    place = np.empty(len(keys), np.int32 if len(keys) < 1 << 31 else np.int64)
    rank = np.cumsum(new, dtype=place.dtype)
    rank -= 1
    place[order] = rank
    return distinct, sums, place


def pack_counts(values: np.ndarray) -> bytes:
    """Counts, a byte each with exceptions, compressed."""
    odd = np.flatnonzero(values > 254)
    parts = [np.array([len(values), len(odd)], np.int64), np.minimum(values, 255).astype(np.uint8), odd.astype(np.int64), values[odd].astype(np.int64)]
    return zstandard.compress(b"".join(x.tobytes() for x in parts), 1)


def unpack_counts(data: bytes) -> np.ndarray:
    data = zstandard.decompress(data)
    n, n_odd = np.frombuffer(data, np.int64, 2).tolist()
    values = np.frombuffer(data, np.uint8, n, 16).astype(np.int64)
    values[np.frombuffer(data, np.int64, n_odd, 16 + n)] = np.frombuffer(data, np.int64, n_odd, 16 + n + 8 * n_odd)
    return values


def packed(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Ascending keys and their counts in few bytes: differences in as many bytes as the largest needs."""
    steps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, -(-int(steps[1:].max() if len(steps) > 1 else 0).bit_length() // 8))
    counts = pack_counts(values)
    parts = [np.array([len(keys), width], np.int64), keys[:1], steps[1:].view(np.uint8).reshape(-1, 8)[:, :width]]
    return b"".join(x.tobytes() for x in parts) + counts


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of ``packed``."""
    n, width = np.frombuffer(data, np.int64, 2).tolist()
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    steps = np.zeros((n, 8), np.uint8)
    steps[1:, :width] = np.frombuffer(data, np.uint8, (n - 1) * width, 24).reshape(-1, width)
    flat = steps.reshape(-1).view(np.uint64)
    flat[0] = np.frombuffer(data, np.uint64, 1, 16)[0]
    return np.cumsum(flat), unpack_counts(data[24 + (n - 1) * width :])


def part_of(keys: np.ndarray, parts: int, bits: int) -> np.ndarray:
    """The part of each key: the key space of ``bits`` bits cut into ``parts`` equal parts, at most 2**31 of them."""
    keys = keys << np.uint64(64 - bits)
    low = (keys & np.uint64(0xFFFFFFFF)) * np.uint64(parts) >> np.uint64(32)
    return ((keys >> np.uint64(32)) * np.uint64(parts) + low >> np.uint64(32)).astype(np.int64)


def messages(kind: int, block: int, keys: np.ndarray, counts: np.ndarray, parts: int, bits: int = 64) -> list[tuple]:
    """Rows of ``SENT``: ascending keys of ``bits`` bits and their counts, by part of the key space; only parts with keys are touched."""
    part = part_of(keys, parts, bits)
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))[: len(part)]
    ends = np.append(cuts[1:], len(part)).tolist()
    return [(kind, k, block, packed(keys[a:b], counts[a:b])) for k, a, b in zip(part[cuts].tolist(), cuts.tolist(), ends, strict=False)]


def _answers(key, table):
    kind, part = key[0].as_py(), key[1].as_py()
    blocks = table.column("block").to_pylist()
    each = [unpacked(x) for x in table.column("data").to_pylist()]
    sent = np.concatenate([k for k, _ in each])
    known, total, place = tallied(sent, np.concatenate([n for _, n in each]))
    rows, at = [], 0
    for block, (k, _) in zip(blocks, each, strict=True):
        rows.append((kind, part, block, pack_counts(total[place[at : at + len(k)]]), None, None))
        at += len(k)
    rows.append((kind, part, -1, None, int((total > 0).sum()), int(total.sum())))
    return table_of(rows, TOLD)


def totals(sent: DataFrame) -> DataFrame:
    """Rows of ``TOLD`` for rows of ``SENT``: an answer to each message, and for each part one row of block -1."""
    return sent.groupBy("kind", "part").applyInArrow(_answers, TOLD_DDL)


def with_answers(blocks: DataFrame, told: DataFrame) -> DataFrame:
    """Rows (block, data, told): each block with the answers to its messages."""
    answers = told.filter("block >= 0").groupBy(F.col("block").alias("told_block")).agg(F.collect_list(F.struct("kind", "part", "data")).alias("told"))
    return blocks.join(answers, F.col("block") == F.col("told_block"), "left").select("block", "data", "told")


def answer(told: list | None, kind: int) -> np.ndarray:
    """Totals of the keys of one kind that a block sent, in their order."""
    found = sorted((x["part"], x["data"]) for x in told or () if x["kind"] == kind)
    return np.concatenate([unpack_counts(d) for _, d in found] or [np.zeros(0, np.int64)])
