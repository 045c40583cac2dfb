"""Packing of documents into token windows: BM25 retrieval inside shards of lexical neighbours.

1. One pass over the texts makes token ids.  Whole windows of a document are sequences of their own; only
   its remainder of less than a window is shuffled, as two bytes an id (four for large vocabularies).
2. Document frequencies of all terms (token ids) over all documents, and the mean length of all remainders, are counted.
   Remainders are put in the order of SIGNATURE weighted MinHash terms, those of high inverse document frequency before
   others, and cut into shards of a fixed size along this order, so that neighbours share a shard and a hot term or a
   repeated document spans several.  A shard indexes its remainders by BM25.  The first unused
   document opens a window, its best unused neighbours fill it, and the one that does not fit is cut; what is left of
   it opens the next window.
3. The last, partly filled window of a shard is cut at powers of two, so that no sequence needs padding.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline.functions.global_order import with_row_number
from wharfline.llm import bpe
from wharfline.llm.text import blocks, give_back, lean, mix
from wharfline.session import cut

BLOCK_BYTES = 4 << 20  # of texts that are made into ids at once: more of them, fewer rounds of merging
SHARD_DOCS = 1024  # remainders that one index holds: at most this many windows of ids
PART_BYTES = 1 << 17  # of texts that are cut into pieces at once: arrays of numbers for each character stay small
KNOWN = 1 << 18  # pieces of texts whose ids a task keeps
SIGNATURE = 4  # terms that a remainder is ordered by
K1, B = 1.2, 0.75

# The pre-token pattern of the vocabulary file, and its special tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPECIAL = ("<|startoftext|>", "<|endoftext|>")


class WordModel(NamedTuple):
    path: str
    inner: np.ndarray  # symbol of each byte inside a pre-token
    last: np.ndarray  # symbol of each byte at its end
    kind: np.ndarray  # SPACE, LETTER, DIGIT, OTHER or ODD of each code point below PLAIN and, last, of all above
    lower: np.ndarray  # lower case of each code point below PLAIN
    pairs: bpe.Pairs
    dtype: str  # of stored ids


PLAIN = 0x180  # below it lower case is one code point for one, and nothing composes
SPACE, LETTER, DIGIT, OTHER, ODD = range(5)


def load_model(path: str) -> WordModel:
    """Read a byte-level BPE file with word ends, as described in its own JSON."""
    import json

    import regex

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, model = spec["model"]["vocab"], spec["model"]
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    if pattern != PATTERN or model["end_of_word_suffix"] != "</w>" or {t["content"] for t in spec["added_tokens"]} != set(SPECIAL):
        raise ValueError("the vocabulary file does not have the expected pre-tokens")
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    chars = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
    inner = np.array([vocab[chars[b]] for b in range(256)], dtype=np.int32)
    last = np.array([vocab[chars[b] + "</w>"] for b in range(256)], dtype=np.int32)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    left, right, merged = ([vocab[x] for x in col] for col in zip(*((a, b, a + b) for a, b in merges), strict=True))
    kind = np.full(PLAIN + 1, OTHER, dtype=np.uint8)
    lower = np.arange(PLAIN + 1, dtype=np.uint32)
    for c in map(chr, range(PLAIN)):
        low = c.lower()
        if regex.match(r"\p{L}", c):
            kind[ord(c)] = LETTER
        elif regex.match(r"\p{N}", c):
            kind[ord(c)] = DIGIT
        if c in " \t\n\r\x0b\x0c":
            kind[ord(c)] = SPACE
        elif c.isspace() or c == "'" or len(low) > 1 or unicodedata.normalize("NFC", c) != c:
            kind[ord(c)] = ODD
        else:
            lower[ord(c)] = ord(low)
    kind[PLAIN] = ODD
    return WordModel(path, inner, last, kind, lower, bpe.Pairs(left, right, np.arange(len(left)), merged),
                     "<u2" if max(vocab.values()) < 1 << 16 else "<u4")


class Encoder:
    """Token ids of texts, equal to those of the tokenizers library.

    White space never lies inside a pre-token, so texts are cut there.  Words of plain Latin letters, digits and
    marks are cut into pre-tokens in arrays; words with other characters, apostrophes or special tokens go to the library
    as they are.  Equal pieces are encoded once in a block, and not again while they are known, about KNOWN at most.
    """

    def __init__(self, model: WordModel):
        self.model, self.library = model, None
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_binary())
        self.ids, self.size = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)

    def _looked_up(self, parts: list[pa.Array], for_library: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the ``parts``' pieces among the known ones, and where the ids of each known piece begin."""
        if len(self.known) > KNOWN:
            self._forget()
        n = len(self.known)
        coded = pa.chunked_array([self.known, *parts]).dictionary_encode().chunks  # of one dictionary; the known come first
        codes, every = np.concatenate([c.indices.to_numpy() for c in coded])[n:], coded[-1].dictionary
        if len(every) > n:
            odd = np.zeros(len(every), dtype=bool)
            odd[codes[for_library]] = True
            fresh = every.take(pa.array(np.arange(n, len(every))))
            ids, size = self._distinct(fresh, odd[n:])
            self.known = every
            self.ids, self.size = np.concatenate((self.ids, ids)), np.concatenate((self.size, size))
        return codes, np.concatenate(([0], np.cumsum(self.size)))

    def _by_library(self, words: list[str]) -> list[list[int]]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.model.path)
        return [e.ids for e in self.library.encode_batch(words, add_special_tokens=False)]

    def _distinct(self, pieces: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and the number of each piece."""
        offsets = np.frombuffer(pieces.buffers()[1], dtype=np.int64)[: len(pieces) + 1]
        raw = np.frombuffer(pieces.buffers()[2], dtype=np.uint8)[: offsets[-1]]
        lengths = np.diff(offsets)
        symbols = self.model.inner[raw]
        symbols[offsets[1:] - 1] = self.model.last[raw[offsets[1:] - 1]]
        symbols[np.repeat(odd, lengths)] = -1
        ids, sizes = bpe.merge(symbols, lengths, self.model.pairs)
        if not odd.any():
            return ids, sizes
        at = np.flatnonzero(odd)
        extra = self._by_library([pieces[int(k)].as_py().decode("utf-8", "replace") for k in at])
        plain = np.repeat(~odd, sizes)
        sizes = np.where(odd, 0, sizes)
        ids, bound = ids[plain], np.cumsum(sizes)
        counts = np.array([len(x) for x in extra], dtype=np.int64)
        ids = np.insert(ids, np.repeat(bound[at], counts), np.array([i for x in extra for i in x], dtype=ids.dtype))
        sizes[at] = counts
        return ids, sizes

    def _pieces(self, offsets: np.ndarray, raw: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Pieces of the texts one after the other, whether each is for the library, and the pieces before the end of each text."""
        model, data = self.model, raw.tobytes()
        points = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
        kinds = model.kind
        if b"|>" in data:  # may be a special token
            kinds = kinds.copy()
            kinds[ord("|")] = ODD
        kind = kinds.take(points, mode="clip")
        # documents start where their first byte is decoded: texts are valid UTF-8, so bytes that continue are not counted
        if len(points) == len(raw):
            edges = offsets
        else:
            edges = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80, dtype=np.int32)))[offsets]
        dark = np.flatnonzero(kind != SPACE)
        if not len(dark):
            return pa.array([], pa.large_binary()), np.zeros(0, dtype=bool), np.zeros(len(offsets) - 1, dtype=np.int64)
        edge = np.zeros(len(points) + 1, dtype=bool)
        edge[edges] = True
        kind, given = kind.take(dark), points.take(dark)
        point = model.lower.take(given, mode="clip")
        far = np.flatnonzero(given >= PLAIN)
        point[far] = given[far]
        word = np.empty(len(dark), dtype=bool)  # starts of words
        word[0] = True
        word[1:] = (np.diff(dark) != 1) | edge.take(dark[1:])
        start = word.copy()
        start[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        inside = None
        if (kind == ODD).any():
            firsts = np.flatnonzero(word)
            odd = np.logical_or.reduceat(kind == ODD, firsts)
            inside = np.repeat(odd, np.diff(np.concatenate((firsts, [len(dark)]))))
            start[inside] = word[inside]
            point[inside] = given[inside]
        starts = np.flatnonzero(start)
        flat = point.tobytes().decode("utf-32-le").encode()
        if len(flat) == len(point):
            bounds = np.append(starts, len(point))
        else:
            widths = 1 + (point >= 0x80).astype(np.uint8) + (point >= 0x800) + (point >= 0x10000)
            ends = np.cumsum(widths, dtype=np.int32 if len(point) < 1 << 29 else np.int64)
            bounds = np.concatenate(([0], ends[starts[1:] - 1], ends[-1:])).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(flat)])
        return pieces, np.zeros(len(starts), dtype=bool) if inside is None else inside[starts], np.searchsorted(dark[starts], edges[1:])

    def texts(self, offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and the number of each text."""
        parts, lo = [], 0
        while lo < len(offsets) - 1:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PART_BYTES, side="right")) - 1)
            parts.append(self._pieces(offsets[lo : hi + 1] - offsets[lo], raw[offsets[lo] : offsets[hi]]))
            lo = hi
        if not any(len(p) for p, _, _ in parts):
            return np.zeros(0, dtype=np.int32), np.zeros(len(offsets) - 1, dtype=np.int64)
        before = np.cumsum([0] + [len(p) for p, _, _ in parts])
        ends = np.concatenate([e + n for (_, _, e), n in zip(parts, before[:-1], strict=True)])
        for_library = np.concatenate([o for _, o, _ in parts])
        codes, first = self._looked_up([p for p, _, _ in parts], for_library)
        del parts
        length = self.size[codes]
        bound = np.concatenate(([0], np.cumsum(length)))
        taken = np.repeat(first[codes] - bound[:-1], length)
        taken += np.arange(bound[-1])
        return self.ids[taken], np.diff(bound[ends], prepend=0)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class Corpus(NamedTuple):
    """Statistics of all documents."""

    idf: np.ndarray  # of each term
    shared: np.ndarray  # terms of two documents or more
    mean: float  # length of a remainder


def corpus_of(df: np.ndarray, documents: int, mean: float) -> Corpus:
    return Corpus(np.log1p((documents - df + 0.5) / (df + 0.5)), df > 1, mean)


def distinct(ids: np.ndarray, stamp: np.ndarray) -> np.ndarray:
    """One place of each of the different ids; ``stamp`` is scratch space with a number for each id."""
    place = np.arange(len(ids), dtype=stamp.dtype)
    stamp[ids] = place
    return np.flatnonzero(stamp[ids] == place)


def count_corpus(stored: DataFrame, dtype: str) -> Corpus:
    """Document frequencies over whole documents: one number a term, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, rests, ids = np.zeros(0, dtype=np.int64), 0, 0, 0
        stamp = np.zeros(0, dtype=np.int32)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                for whole, rest in zip(*(c.to_pylist() for c in batch.slice(lo, 64).columns), strict=True):
                    own = np.frombuffer(whole + rest, dtype=dtype).astype(np.int64)
                    most = int(own.max(initial=-1)) + 1
                    if most > len(df):
                        df, stamp = np.append(df, np.zeros(most - len(df), dtype=np.int64)), np.zeros(most, dtype=np.int32)
                    df[own[distinct(own, stamp)]] += 1
                    n, rests, ids = n + 1, rests + (len(rest) > 0), ids + len(rest)
        at = np.flatnonzero(df)
        totals = np.array([n, rests, ids // np.dtype(dtype).itemsize])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2, -3])), pa.array(np.append(df[at], totals))], names=["term", "n"])

    rows = stored.select("whole", "rest").mapInArrow(lean(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, value = (np.asarray(rows.column(k).to_numpy(), dtype=np.int64) for k in (0, 1))
    n, rests, ids = (int(value[term == -k].sum()) for k in (1, 2, 3))
    df = np.zeros(int(term.max(initial=-1)) + 1, dtype=np.int64)
    df[term[term >= 0]] = value[term >= 0]
    return corpus_of(df, n, ids / max(1, rests))


class Draws(NamedTuple):
    """For each of SIGNATURE draws: the terms in its order and then -1, and the place of each term there."""

    terms: np.ndarray
    place: np.ndarray  # of a term of one document only: that of -1


def draws_of(corpus: Corpus) -> Draws:
    n = len(corpus.idf)
    weight, every = np.maximum(corpus.idf, 1e-9) ** 2, np.arange(n)
    terms, place = np.full((SIGNATURE, n + 1), -1, dtype=np.int64), np.empty((SIGNATURE, n), dtype=np.int32)
    for k in range(SIGNATURE):
        draw = (mix(every.astype(np.uint64), 31 + k) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54
        terms[k, :n] = np.argsort(-np.log(draw) / weight, kind="stable")
        place[k, terms[k, :n]] = every
        place[k, ~corpus.shared] = n
    return Draws(terms, place)


def signatures(sets: list[np.ndarray], corpus: Corpus, draws: Draws | None = None) -> np.ndarray:
    """SIGNATURE terms of each set: two sets have each in common as often as the share of the weight (idf squared) that they share.

    A set without terms of two documents or more has -1.  ``draws`` are those of the corpus.
    """
    draws = draws or draws_of(corpus)
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    out = np.full((len(sets), SIGNATURE), -1, dtype=np.int64)
    full = np.flatnonzero(sizes)
    if len(full):
        terms = np.concatenate(sets).astype(np.int64)
        starts = np.cumsum(sizes)[full] - sizes[full]
        for k in range(SIGNATURE):
            out[full, k] = draws.terms[k].take(np.minimum.reduceat(draws.place[k].take(terms), starts))
    return out


def retrieve_and_fill(remainders: list[np.ndarray], window: int, corpus: Corpus | None = None) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length); every id once; only the last may be short.

    The seed is what was left of a cut document, else the first unused one.  Neighbours come by falling BM25 score
    for all terms of the seed, then in order.  Without ``corpus`` the remainders are the corpus.
    """
    n = len(remainders)
    sizes = np.array([len(x) for x in remainders], dtype=np.int64)
    key = np.repeat(np.arange(n) << 32, sizes) | np.concatenate([np.zeros(0, np.int64), *remainders]).astype(np.int64)
    key.sort()
    first = np.flatnonzero(np.diff(key, prepend=-1))
    freq = np.diff(np.append(first, len(key)))
    key = key[first]
    owner, terms = key >> 32, key & 0xFFFFFFFF
    ends = np.searchsorted(owner, np.arange(n + 1))
    doc_terms = [terms[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    order = np.argsort(terms.astype(np.uint16) if terms.max(initial=0) < 1 << 16 else terms, kind="stable")
    terms, freq, owner = terms[order], freq[order], owner[order]
    width = int(terms[-1]) + 2 if len(terms) else 1
    posting = np.searchsorted(terms, np.arange(width))
    if corpus is None:
        corpus = corpus_of(np.diff(np.concatenate((posting, [len(terms)]))), n, sizes.mean() if n else 1.0)
    norm = K1 * (1 - B + B * sizes / max(1.0, corpus.mean))
    impact = corpus.idf[terms] * freq * (K1 + 1) / (freq + norm[owner]) if n else np.zeros(0)
    used = sizes == 0
    held = unused = int((~used).sum())  # documents in the posting lists, and those of them not used yet
    pointer, rest = 0, None
    while True:
        if rest is None:
            while pointer < n and used[pointer]:
                pointer += 1
            if pointer == n:
                return
            rest = (pointer, 0)
            used[pointer] = True
            unused -= 1
        seed, at = rest
        take = min(window, int(sizes[seed]) - at)
        row, room = [(seed, at, take)], window - take
        rest = (seed, at + take) if at + take < sizes[seed] else None
        if room:
            if unused < held * 4 // 5:  # used documents leave the lists
                left = np.flatnonzero(~used.take(owner))
                terms, owner, impact, held = terms.take(left), owner.take(left), impact.take(left), unused
                posting = np.searchsorted(terms, np.arange(width))
            own = doc_terms[seed]
            lo, hits = posting[own], posting[own + 1] - posting[own]
            edges = np.concatenate(([0], np.cumsum(hits)))
            at = np.repeat(lo - edges[:-1], hits) + np.arange(edges[-1])
            score = np.bincount(owner.take(at), weights=impact.take(at), minlength=n)
            score[used] = -1.0
            while room and unused:
                d = int(score.argmax())  # the first of equal ones
                take = min(room, int(sizes[d]))
                row.append((d, 0, take))
                used[d], score[d] = True, -1.0
                unused -= 1
                room -= take
                if take < sizes[d]:
                    rest = (d, take)
        yield row


def powers_of_two(row: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The row cut into rows whose lengths are its binary digits, largest first."""
    left = sum(length for _, _, length in row)
    parts = iter(row)
    doc, start, length = next(parts, (0, 0, 0))
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        out = []
        while size:
            if not length:
                doc, start, length = next(parts)
            take = min(size, length)
            out.append((doc, start, take))
            start, length, size = start + take, length - take, size - take
        yield out


def pack(docs: DataFrame, model: WordModel, window: int = 2048, end_id: int = 1, text: str = "text", key: str = "doc_id",
         shard_docs: int = SHARD_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Pack all rows of ``docs`` into sequences of at most ``window`` ids.

    Returns one row per piece: ``key``, start, length, ids_crc32, ids (int array), doc_tokens, sequence_id, offset.
    Each document is its token ids and then ``end_id``; a null or empty text is ``end_id`` alone.  A repeated row, also
    one with the same key, is a document of its own; a null key stays null.  A very long text fills windows of its
    own and passes on only what is left.  Columns of ``docs`` besides text and key are ignored.  An empty table
    gives no rows.  Sequences are full, or a power of two long at the end of a shard.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, slot, windows = Encoder(model), 0, 0
        for batch in batches:
            for part, offsets, raw in blocks(batch, "text", block_bytes):
                ids, sizes = encoder.texts(offsets, raw)
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                whole, rest, first = [], [], []
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    own = np.append(ids[a:b], end_id).astype(model.dtype)
                    full = len(own) // window
                    whole.append(own[: full * window].tobytes())
                    rest.append(own[full * window :].tobytes())
                    first.append(windows)
                    windows += full
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes + 1), pa.array(whole, pa.binary()), pa.array(rest, pa.binary()),
                     pa.array(first, pa.int64()), pa.array(np.arange(slot, slot + len(rest)))],
                    names=["key", "tokens", "whole", "rest", "first", "slot"])
                slot += len(rest)

    schema = f"key {kind.simpleString()}, tokens long, whole binary, rest binary, first long, slot long"
    encoded = rows.mapInArrow(lean(encode), schema).withColumn("task", F.spark_partition_id().cast("long"))
    # the stored table fixes the place of each row, and with it shards and numbers, whatever is computed again later
    stored = cut(encoded, "packing-ids")
    out_schema = f"key {kind.simpleString()}, start long, length long, ids_crc32 long, ids array<int>, doc_tokens long, sequence_id long, offset long"

    def pieces(keys: pa.Array, tokens: np.ndarray, out: list[tuple[int, int, np.ndarray, int, int]]) -> pa.Table:
        """One row for each (row of ``keys``, start, ids, sequence, offset)."""
        which = np.array([x[0] for x in out], dtype=np.int64)
        flat = np.concatenate([x[2] for x in out]) if out else np.zeros(0, dtype=np.int32)
        bounds = np.concatenate(([0], np.cumsum([len(x[2]) for x in out], dtype=np.int64)))
        return pa.table({
            "key": keys.take(pa.array(which)), "start": pa.array([x[1] for x in out], pa.int64()),
            "length": pa.array(np.diff(bounds)), "ids_crc32": pa.array([crc(x[2]) for x in out], pa.int64()),
            "ids": pa.ListArray.from_arrays(bounds.astype(np.int32), flat.astype(np.int32)), "doc_tokens": pa.array(tokens[which]),
            "sequence_id": pa.array([x[3] for x in out], pa.int64()), "offset": pa.array([x[4] for x in out], pa.int64())})

    def cut_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                data = [np.frombuffer(x, dtype=model.dtype) for x in part.column("whole").to_pylist()]
                base = ((1 << 62) | (part.column("task").to_numpy() << 36)) + part.column("first").to_numpy()
                out = [(d, at, ids[at : at + window], int(base[d]) + at // window, 0) for d, ids in enumerate(data) for at in range(0, len(ids), window)]
                yield from pieces(part.column("key"), part.column("tokens").to_numpy(), out).to_batches()

    whole = stored.filter(F.length("whole") > 0).select("key", "tokens", "whole", "first", "task").mapInArrow(lean(cut_whole), out_schema)

    remainders = stored.filter(F.length("rest") > 0).select("key", "tokens", "rest", "slot", "task")
    corpus = count_corpus(stored, model.dtype)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = draws_of(corpus)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                marks = signatures([np.frombuffer(x, dtype=model.dtype) for x in part.column(2).to_pylist()], corpus, draws)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(marks[:, k]) for k in range(SIGNATURE))], names=["task", "slot", *marked])

    marked = [f"m{k}" for k in range(SIGNATURE)]
    signed = remainders.select("task", "slot", "rest").mapInArrow(lean(sign), ", ".join(f"{c} long" for c in ["task", "slot", *marked]))
    numbered = with_row_number(signed, [*marked, "task", "slot"], "number", start=0)
    shards = cut(numbered.select("task", "slot", F.expr(f"number div {shard_docs}").alias("shard"), "number"), "packing-shards")
    dealt = remainders.join(shards, ["task", "slot"])

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        sequence = int(table.column("shard")[0].as_py()) << 31
        rest = [np.frombuffer(x, dtype=model.dtype) for x in table.column("rest").to_pylist()]
        tokens = table.column("tokens").to_numpy()
        base = tokens - np.array([len(x) for x in rest], dtype=np.int64)
        out: list[tuple[int, int, np.ndarray, int, int]] = []
        for row in retrieve_and_fill(rest, window, corpus):
            full = sum(x[2] for x in row) == window
            for part in [row] if full else powers_of_two(row):
                offset = 0
                for d, start, length in part:
                    out.append((d, int(base[d]) + start, rest[d][start : start + length], sequence, offset))
                    offset += length
                sequence += 1
        made = pieces(table.column("key").combine_chunks(), tokens, out)
        del out, rest
        give_back()  # groups of one task follow each other in one worker
        return made

    packed = dealt.groupBy("shard").applyInArrow(fill, out_schema).unionByName(whole)
    return packed.withColumnRenamed("key", key)
