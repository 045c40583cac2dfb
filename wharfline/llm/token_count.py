"""Token counts by merging of all pre-tokens at once, by rank (see ``bpe``), equal to the sentencepiece library.

The vocabulary holds U+2581 (for a space) only at the start of a piece, so a text falls apart into pre-tokens - a run
of spaces and what follows up to the next space - that never merge with each other.  Equal pre-tokens of a block
are merged once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline.llm import bpe
from wharfline.llm.text import blocks

BLOCK_BYTES = 8 << 20
SYMBOLS = 1 << 19  # symbols that one call of the merging holds


class PieceModel(NamedTuple):
    """What counting needs of a sentencepiece BPE model with byte fallback: bounded by the vocabulary."""

    points: np.ndarray  # code points of the one-character pieces, in order
    ids: np.ndarray
    pairs: bpe.Pairs


def load_model(path: str) -> PieceModel:
    """Read a model; raises ValueError for one whose texts need more than space marks, a prefix space and merging."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = {}
    for i in range(sp.vocab_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)):
            plain[sp.id_to_piece(i)] = i
    probe = "ﬁ Á\tx  y "
    if sp.normalize(probe) != "▁" + probe.replace(" ", "▁") or any("▁" in p.lstrip("▁") for p in plain):
        raise ValueError("the model rewrites texts or has pieces that run across a space")
    scores = sorted({sp.get_score(i) for i in plain.values()}, reverse=True)
    order = {s: k for k, s in enumerate(scores)}
    left, right, rank, merged = [], [], [], []
    for piece, i in plain.items():
        if any(c not in plain for c in piece):
            raise ValueError("a character of a piece is no piece")
        for k in range(1, len(piece)):
            a, b = plain.get(piece[:k]), plain.get(piece[k:])
            if a is not None and b is not None:
                left.append(a), right.append(b), rank.append(order[sp.get_score(i)]), merged.append(i)
    chars = sorted((ord(p), i) for p, i in plain.items() if len(p) == 1)
    points, ids = (np.array(x, dtype=np.int64) for x in zip(*chars, strict=True))
    return PieceModel(points, ids, bpe.Pairs(left, right, rank, merged))


def count_words(words: list[bytes], model: PieceModel) -> np.ndarray:
    """Tokens of each pre-token."""
    out = np.zeros(len(words), dtype=np.int64)
    lo = 0
    sizes = np.cumsum([len(w) for w in words])
    while lo < len(words):
        base = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, base + SYMBOLS, side="right")))
        texts = [w.decode("utf-8", "replace").replace(" ", "▁") for w in words[lo:hi]]
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(model.points, points), len(model.points) - 1)
        known = model.points[at] == points
        symbols = np.where(known, model.ids[at], -1).astype(np.int32)
        _, left = bpe.merge(symbols, lengths, model.pairs)
        # an unknown character has stayed as one symbol; it counts as its UTF-8 bytes
        owner = np.repeat(np.arange(len(texts)), lengths)[~known]
        p = points[~known]
        more = (p >= 0x80).astype(np.int64) + (p >= 0x800) + (p >= 0x10000)
        out[lo:hi] = left + np.bincount(owner, weights=more, minlength=len(texts)).astype(np.int64)
        lo = hi
    return out


def count_texts(texts: list[bytes], model: PieceModel) -> np.ndarray:
    """Tokens of each text (an empty one has none)."""
    full = [b" " + t.replace(b"\xe2\x96\x81", b" ") for t in texts if t]
    out = np.zeros(len(texts), dtype=np.int64)
    if not full:
        return out
    raw = np.frombuffer(b"".join(full), dtype=np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in full])))
    space = raw == 32
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[bounds[:-1]] = True
    starts = np.flatnonzero(start)
    offsets = np.concatenate((starts, [len(raw)])).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    coded = words.dictionary_encode()
    counts = count_words(coded.dictionary.to_pylist(), model)[coded.indices.to_numpy()]
    sums = np.concatenate(([0], np.cumsum(counts)))
    places = np.searchsorted(starts, bounds)
    out[[k for k, t in enumerate(texts) if t]] = sums[places[1:]] - sums[places[:-1]]
    return out


def token_counts(docs: DataFrame, model: PieceModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 limit: int = 4096) -> DataFrame:
    """``keep`` columns, ``n_bytes``, ``n_tokens`` and ``over_limit`` (n_tokens > limit) for every row of ``docs``.

    No begin, end or other special tokens.  A null or empty text has 0 bytes and 0 tokens; repeated rows are counted
    each; very long texts are cut into pre-tokens, of which any number of bytes may be one; columns of ``docs`` that are
    not kept have no effect.  Map only: no shuffle.
    """
    rows = docs.select(*keep, F.col(text).alias("__text"))
    names = [*keep, "n_bytes", "n_tokens"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, offsets, raw in blocks(batch, "__text", BLOCK_BYTES):
                data = raw.tobytes()
                tokens = count_texts([data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], model)
                columns = [part.column(k) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(offsets)), pa.array(tokens)], names=names)

    schema = rows.drop("__text").schema.add("n_bytes", "long").add("n_tokens", "long")
    return rows.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
