"""Line dedup: hashes range-partitioned and sorted by document and position, first occurrences streamed.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower case.  A key of at least
``min_chars`` code points that ``min_docs`` documents or more hold keeps its lines only in the document with the largest
key.  The texts are read twice and never sorted by line: only 128-bit hashes, document and position travel, and what
comes back to a document is a bitmap of the lines that stay.

The order is (hash, document from the largest down), so the first document of a run of equal hashes is the one that
keeps its lines.  A very common line spans many ranges: a run that touches the end of a range is settled by the
sums of such runs, at most two a range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.llm.text import blocks, lean
from wharfline.session import cut

_STRIP = b" \t\n\x0b\x0c\r"
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
ROWS_PER_RANGE = 1_000_000


def line_keys(text: bytes, min_chars: int) -> list[tuple[int, bytes]]:
    """Position and key of each line that is long enough to count."""
    out = []
    for position, line in enumerate(text.split(b"\n")):
        if len(line) >= min_chars:
            key = line.strip(_STRIP).translate(_LOWER)
            if len(key) >= min_chars and len(key.decode("utf-8", "replace")) >= min_chars:
                out.append((position, key))
    return out


def _lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc, copy, position) of every line that counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, offsets, raw in blocks(batch, "text"):
                data = raw.tobytes()
                which, place, digest = [], [], []
                for d in range(part.num_rows):
                    for position, key in line_keys(data[offsets[d] : offsets[d + 1]], min_chars):
                        which.append(d), place.append(position), digest.append(hashlib.blake2b(key, digest_size=16).digest())
                pair = np.frombuffer(b"".join(digest), dtype=np.int64).reshape(-1, 2)
                at = pa.array(which, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 0]), pa.array(pair[:, 1]), part.column(0).take(at), part.column(1).take(at), pa.array(place, pa.int32())],
                    names=["h1", "h2", "doc", "copy", "position"])

    return rows.select("doc", "copy", "text").mapInArrow(lean(run), "h1 long, h2 long, doc long, copy long, position int")


def _stream(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """One sorted range: its lines that go, and those of its first and last run, whose other part may lie elsewhere.

    Rows are (h1, h2, doc, copy, position, n_docs, last_doc).  Position -1 marks the sums of an open run: documents in
    it, the first of them in ``doc`` and the last in ``last_doc``; n_docs is 0 in a line of an open run.
    A range holds about ROWS_PER_RANGE rows of 44 bytes.
    """
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    h1, h2, doc, copy, position = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in range(5))
    del held
    new = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
    new_doc = new.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.concatenate((start, [len(h1)])))
    n = np.add.reduceat(new_doc.astype(np.int64), start)
    opened = np.zeros(len(start), dtype=bool)
    opened[[0, -1]] = True
    out = np.flatnonzero(np.repeat(opened, size) | np.repeat(n >= min_docs, size) & (doc != np.repeat(doc[start], size)))
    kind = np.where(np.repeat(opened, size), 0, np.repeat(n, size))
    ends = np.unique(np.flatnonzero(opened))
    first, last = start[ends], start[ends] + size[ends] - 1
    columns = [np.concatenate(x) for x in (
        (h1[out], h1[first]), (h2[out], h2[first]), (doc[out], doc[first]), (copy[out], copy[first]),
        (position[out], np.full(len(first), -1, np.int32)), (kind[out], n[ends]), (doc[out], doc[last]))]
    yield from pa.table([pa.array(x) for x in columns], names=["h1", "h2", "doc", "copy", "position", "n_docs", "last_doc"]).to_batches(50_000)


def drop_bitmaps(rows: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(doc, copy, bitmap) of the rows that lose lines; bitmap: number of a word of 64 lines -> bits of lines that go."""
    lines = cut(_lines(rows, min_chars), "line-hashes")
    ranges = max(1, -(-lines.count() // ROWS_PER_RANGE), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc(), F.col("copy"), F.col("position")]
    dealt = lines.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    schema = "h1 long, h2 long, doc long, copy long, position int, n_docs long, last_doc long"
    stream = cut(dealt.mapInArrow(lean(lambda batches: _stream(batches, min_docs)), schema).withColumn("part", F.spark_partition_id()), "line-stream")
    # runs at the ends of ranges: a document on both sides of a border counts once
    along = Window.partitionBy("h1", "h2").orderBy("part", F.col("doc").desc())
    runs = (
        stream.filter("position = -1")
        .withColumn("n", F.col("n_docs") - F.coalesce((F.lag("last_doc").over(along) == F.col("doc")).cast("long"), F.lit(0)))
        .groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("doc").alias("top")).filter(F.col("n") >= min_docs).drop("n")
    )
    settled = stream.filter("position >= 0 and n_docs = 0").join(F.broadcast(runs), ["h1", "h2"])  # at most two runs a range
    gone = stream.filter("position >= 0 and n_docs > 0").select("doc", "copy", "position").unionByName(
        settled.filter("doc != top").select("doc", "copy", "position"))
    words = gone.groupBy("doc", "copy", F.shiftright("position", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, position & 63))").alias("bits"))
    packed = words.groupBy("doc", "copy").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("bitmap"))
    return cut(packed, "line-bitmaps")


def line_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and ``n_lines`` (before) and ``n_dropped``.

    Lines end at ``\\n``; a null or empty text is one empty line and comes back empty.  Rows with the same key count as
    one document and keep a line together; a null key is one document, the smallest.  A line repeated inside the
    document that keeps it stays each time.  Columns of ``docs`` named n_lines or n_dropped are replaced.  Very long
    texts are read whole.  An empty table stays empty.
    """
    others = [c for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    lowest = F.lit(-(2**63)).cast("long")
    rows = docs.select(F.struct(*others).alias("row"), F.col(text).alias("text"),
                       F.coalesce(F.col(key).cast("long"), lowest).alias("doc"), F.xxhash64(text).alias("copy"))
    bitmaps = drop_bitmaps(rows, min_chars, min_docs)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, offsets, raw in blocks(batch, "text"):
                data = raw.tobytes()
                kept, counts, dropped = [], [], []
                for d, words in enumerate(part.column("bitmap").to_pylist()):
                    own = data[offsets[d] : offsets[d + 1]]
                    counts.append(own.count(b"\n") + 1)
                    if words:
                        bits = {w: b for w, b in words}
                        lines = own.split(b"\n")
                        left = [x for p, x in enumerate(lines) if not bits.get(p >> 6, 0) >> (p & 63) & 1]
                        dropped.append(len(lines) - len(left))
                        own = b"\n".join(left)
                    else:
                        dropped.append(0)
                    kept.append(own)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())],
                    names=["row", "text", "n_lines", "n_dropped"])

    joined = rows.join(bitmaps, ["doc", "copy"], "left").select("row", "text", "bitmap")
    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    out = joined.mapInArrow(lean(apply), schema)
    return out.select("row.*", F.col("text").alias(text), "n_lines", "n_dropped")
