"""Token ids of a corpus as compressed files, in ascending order of the key.

A file is a Parquet table of segments.  A segment is a byte string that can be read on its own:

    "WTS2"                                          mark of the format
    documents u32, blocks u32, ids u64, crc u32     crc: of the three tables below and the alphabets
    key i64, null u8, length u32                    each for all documents
    length, alphabet, alphabet bytes, coded bytes, crc: u32     each for all blocks; crc: of the block's ids as u32
    alphabets, coded ids                            of all blocks, one after the other

All numbers are little-endian.  A segment holds whole documents; its ids are cut into blocks of BLOCK_IDS ids, each of which is
coded alone (see ``mixcoder``).  Alphabets are the sorted distinct ids of a block, as differences of seven bits a byte.
Beside its bytes a segment has the number of its range, its place in it, and the ids before it there; so
``start`` of every document follows from one number for each range.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wharfline.functions.global_order import range_count
from wharfline.llm import mixcoder
from wharfline.llm.packing import Encoder, WordModel
from wharfline.llm.text import blocks, lean

MARK, HEAD = b"WTS2", struct.Struct("<IIQI")
BLOCK_IDS = 1 << 11
SEGMENT_IDS = 1 << 18  # a segment ends after the document that reaches it
SIDE_BY_SIDE = 2560  # blocks that are held, and decoded, together
ENCODED = 1280  # blocks that are encoded together: fewer steps are made one id at a time there, and their models stay in the caches
TEXT_BYTES = 4 << 20  # that are made into ids at once
SCHEMA = "part int, segment int, first long, n_docs int, n_ids long, data binary"


def widths(values: np.ndarray) -> np.ndarray:
    return 1 + sum((values >= 1 << k).astype(np.int64) for k in (7, 14, 21, 28))


def varints(values: np.ndarray) -> bytes:
    """Numbers below 2^35 as groups of seven bits, low ones first; the eighth bit says that more follow."""
    size = widths(values)
    last = np.cumsum(size)
    owner = np.repeat(np.arange(len(values)), size)
    place = np.arange(len(owner)) - np.repeat(last - size, size)
    out = ((values[owner] >> (7 * place)) & 127).astype(np.uint8)
    out[place < size[owner] - 1] |= 128
    return out.tobytes()


def from_varints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(raw < 128)
    if not len(ends):
        return np.zeros(0, dtype=np.int64)
    starts = np.concatenate(([0], ends[:-1] + 1))
    place = np.arange(ends[-1] + 1) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((raw[: ends[-1] + 1] & 127).astype(np.int64) << (7 * place), starts)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def write_segments(groups: Sequence[tuple[list[int | None], list[np.ndarray]]]) -> list[bytes]:
    """One segment for each (keys, ids of each document); their blocks are coded side by side."""
    cut, bounds = [], [0]
    for _, ids in groups:
        flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64)
        cut += [flat[k : k + BLOCK_IDS] for k in range(0, len(flat), BLOCK_IDS)]
        bounds.append(len(cut))
    coded = [c for k in range(0, len(cut), ENCODED) for c in mixcoder.encode(cut[k : k + ENCODED])]
    out = []
    first = np.cumsum([0] + [len(a) for a, _ in coded])
    steps = np.concatenate([*(a for a, _ in coded), np.zeros(1, dtype=np.int64)])
    steps[1:] -= np.where(np.isin(np.arange(1, len(steps)), first), 0, steps[:-1])
    ends = np.concatenate(([0], np.cumsum(widths(steps[:-1]))))[first]
    listed = varints(steps[:-1])
    for g, (keys, ids) in enumerate(groups):
        own, codes = cut[bounds[g] : bounds[g + 1]], coded[bounds[g] : bounds[g + 1]]
        alphabets = [listed[a:b] for a, b in zip(ends[bounds[g] : bounds[g + 1]], ends[bounds[g] + 1 : bounds[g + 1] + 1], strict=True)]
        sizes = np.array([[len(b) for b in own], [len(a) for a, _ in codes], [len(a) for a in alphabets], [len(c) for _, c in codes], [crc(b) for b in own]], dtype="<u4")
        tables = b"".join((
            np.array([k or 0 for k in keys], dtype="<i8").tobytes(), bytes(k is None for k in keys),
            np.array([len(i) for i in ids], dtype="<u4").tobytes(), sizes.tobytes(), *alphabets))
        head = HEAD.pack(len(keys), len(own), sum(map(len, own)), zlib.crc32(tables))
        out.append(b"".join((MARK, head, tables, *(c for _, c in codes))))
    return out


def read_segments(segments: Sequence[bytes]) -> list[tuple[list[int | None], list[np.ndarray]]]:
    """Keys and ids of the documents of each segment; raises ValueError for bytes that are damaged."""
    coded, crcs, found = [], [], []
    for data in segments:
        if data[:4] != MARK or len(data) < 4 + HEAD.size:
            raise ValueError("not a segment of token ids")
        docs, n, total, check = HEAD.unpack_from(data, 4)
        at = 4 + HEAD.size
        sizes = np.frombuffer(data[at + 13 * docs : at + 13 * docs + 20 * n].ljust(20 * n, b"\0"), dtype="<u4").reshape(5, n).astype(np.int64)
        bounds = np.concatenate(([0], np.cumsum(sizes[2]), sizes[2].sum() + np.cumsum(sizes[3]))) + at + 13 * docs + 20 * n
        if zlib.crc32(data[at : int(bounds[n])]) != check or len(data) != bounds[-1]:
            raise ValueError("a damaged segment of token ids")
        keys = np.frombuffer(data, "<i8", docs, at).tolist()
        keys = [None if null else k for k, null in zip(keys, data[at + 8 * docs : at + 9 * docs], strict=True)]
        found.append((keys, np.frombuffer(data, "<u4", docs, at + 9 * docs).astype(np.int64), n))
        listed = data[bounds[0] : bounds[n]]
        before = np.concatenate(([0], np.cumsum(np.frombuffer(listed, dtype=np.uint8) < 128)))[bounds[: n + 1] - bounds[0]]
        sums = np.concatenate(([0], np.cumsum(from_varints(listed))))
        for k in range(n):
            alphabet = sums[before[k] + 1 : before[k + 1] + 1] - sums[before[k]]
            coded.append((alphabet, int(sizes[0, k]), data[bounds[n + k] : bounds[n + k + 1]]))
        crcs += sizes[4].tolist()
    plain = [b for k in range(0, len(coded), SIDE_BY_SIDE) for b in mixcoder.decode(coded[k : k + SIDE_BY_SIDE])]
    if any(crc(b) != c for b, c in zip(plain, crcs, strict=True)):
        raise ValueError("a damaged block of token ids")
    out, used = [], 0
    for keys, lengths, n in found:
        flat = np.concatenate(plain[used : used + n]) if n else np.zeros(0, dtype=np.int64)
        used += n
        out.append((keys, np.split(flat, np.cumsum(lengths)[:-1]) if len(lengths) else []))
    return out


def write_ids(docs: DataFrame, model: WordModel, path: str, end_id: int = 2, text: str = "text", key: str = "doc_id") -> None:
    """Write the token ids of every row of ``docs``, each followed by ``end_id``, to a new table at ``path``.

    Rows lie in ascending order of ``key`` (a whole number, or text of one), null keys first; rows of one key in the order
    of a hash of their texts.  A null or empty text is ``end_id`` alone.  A repeated row is a document of its own.
    A very long text makes a long segment, whose blocks are as short as all others.  Other columns are
    ignored.  An empty table gives a table without segments.  A key or text that very many rows share is split over
    several ranges, as the place of a row in the input ends the order.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    order = [F.col("key").asc_nulls_first(), "hash", "place"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder(model), TaskContext.get().partitionId()
        groups: list[tuple[list, list]] = [([], [])]
        held = here = first = number = 0  # ids held, ids of the last group, ids written, segments written

        def written() -> pa.RecordBatch:
            nonlocal number, first
            n_ids = [sum(map(len, ids)) for _, ids in groups]
            starts = first + np.concatenate(([0], np.cumsum(n_ids[:-1], dtype=np.int64))).astype(np.int64)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part] * len(groups), pa.int32()), pa.array(range(number, number + len(groups)), pa.int32()), pa.array(starts, pa.int64()),
                 pa.array([len(k) for k, _ in groups], pa.int32()), pa.array(n_ids, pa.int64()), pa.array(write_segments(groups), pa.binary())],
                names=["part", "segment", "first", "n_docs", "n_ids", "data"])
            number, first = number + len(groups), first + sum(n_ids)
            return out

        for batch in batches:
            for block, offsets, raw in blocks(batch, "text", TEXT_BYTES):
                ids, sizes = encoder.texts(offsets, raw)
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                for k, a, b in zip(block.column(0).to_pylist(), bounds[:-1], bounds[1:], strict=True):
                    groups[-1][0].append(k)
                    groups[-1][1].append(np.append(ids[a:b], end_id).astype(model.dtype))
                    here += int(b - a) + 1
                    if here >= SEGMENT_IDS:
                        held, here = held + here, 0
                        if held >= SIDE_BY_SIDE * BLOCK_IDS:
                            yield written()
                            held, groups = 0, []
                        groups.append(([], []))
        if groups and not groups[-1][0]:
            groups.pop()
        if groups:
            yield written()

    ranged = rows.repartitionByRange(range_count(rows), *order).sortWithinPartitions(*order).select("key", "text")
    ranged.mapInArrow(lean(encode), SCHEMA).write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = True, key: str = "doc_id") -> DataFrame:
    """Documents of a table that ``write_ids`` made: ``key``, start, n_tokens, ids_crc32 and, on demand, ``ids`` (int array).

    ``start`` counts the ids of all documents before, ``n_tokens`` those of the document with its end id.  Every
    checksum is verified; damaged bytes raise ValueError.
    """
    table = spark.read.schema(SCHEMA).parquet(path)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = table.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = table.join(F.broadcast(parts), "part").select((F.col("before") + F.col("first")).alias("start"), "n_ids", "data")  # a row a range

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_ids = batch.column(1).to_numpy()
            ends = np.cumsum(n_ids)
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - n_ids[lo] + SIDE_BY_SIDE * BLOCK_IDS, side="right")))
                part = batch.slice(lo, hi - lo)
                for start, (keys, ids) in zip(part.column(0).to_pylist(), read_segments(part.column(2).to_pylist()), strict=True):
                    sizes = np.array([len(i) for i in ids], dtype=np.int64)
                    ends_in = np.cumsum(sizes)
                    columns = [pa.array(keys, pa.int64()), pa.array(start + ends_in - sizes), pa.array(sizes), pa.array([crc(i) for i in ids], pa.int64())]
                    if with_ids:
                        bounds = np.concatenate(([0], ends_in)).astype(np.int32)
                        columns.append(pa.ListArray.from_arrays(bounds, np.concatenate(ids).astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                lo = hi

    names = ["key", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "key long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return placed.mapInArrow(lean(decode), schema).withColumnRenamed("key", key)
