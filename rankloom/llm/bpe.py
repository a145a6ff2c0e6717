"""Byte-level BPE: encoding of whole texts and decoding of ids, in Arrow batches."""

from __future__ import annotations

import base64
import heapq
import struct
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import file_content, text_slices, tidy_task, worker_cache
from rankloom.llm.prescan import Slices, library_symbols


SLICE = 250_000  # bytes of texts or ids at a time; what is made of them takes many times as much


class Vocabulary:
    """Tokens by rank, and the rank of every pair of tokens that makes a token."""

    def __init__(self, content: bytes):
        rows = [line.split() for line in content.splitlines() if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in rows}
        self.tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.lengths)])[:-1].astype(np.int64)
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.single = [self.ranks.get(bytes([i])) for i in range(256)]
        if None in self.single:
            raise ValueError("the vocabulary lacks single bytes")

    def _pair_rows(self) -> np.ndarray:
        """(left, right, rank) of all pairs of tokens that make a token."""
        find, found = self.ranks.get, array("q")
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = find(token[:cut]), find(token[cut:])
                if left is not None and right is not None:
                    found.extend((left, right, rank))
        return np.array(found, np.int64).reshape(-1, 3)

    @cached_property
    def pairs(self) -> dict[tuple[int, int], int]:
        """Ranks of pairs, needed for very long pre-tokens only."""
        return {(a, b): r for a, b, r in self._pair_rows().tolist()}

    @cached_property
    def _slots(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Open addressing for the ranks of pairs: (keys, ranks, longest probe)."""
        pairs = self._pair_rows()
        ranks = pairs[:, 2]
        keys = pairs[:, 0] * len(self.tokens) + pairs[:, 1]
        size = 1 << max(4, int(3 * len(keys)).bit_length())
        held, found = np.full(size, -1), np.zeros(size, np.int64)
        todo, probes = np.arange(len(keys)), 0
        while len(todo):
            at = (_slot(keys[todo], size) + probes) % size
            free = held[at] < 0
            held[at[free]] = keys[todo[free]]  # of several the last stays
            placed = held[at] == keys[todo]
            found[at[placed]] = ranks[todo[placed]]
            todo, probes = todo[~placed], probes + 1
        return held, found, probes

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of tokens where there is none."""
        held, found, probes = self._slots
        keys = left * len(self.tokens) + right
        out = np.full(len(keys), len(self.tokens))
        todo, at = np.arange(len(keys)), _slot(keys, len(held))
        for _ in range(probes):
            there = held[at]
            same = there == keys[todo]
            out[todo[same]] = found[at[same]]
            on = ~same & (there >= 0)
            todo, at = todo[on], (at[on] + 1) % len(held)
            if not len(todo):
                break
        return out

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of pre-tokens: the pair of lowest rank merges first, the leftmost of equals.

        All pieces of moderate length make one merge a round, together.
        """
        out: list[bytes] = [b""] * len(pieces)
        open_pieces = []
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = _pack([whole])
            elif len(piece) > 64:
                out[i] = _pack(self._merge_long([self.single[b] for b in piece]))
            else:
                open_pieces.append(i)
        if not open_pieces:
            return out
        raw = np.frombuffer(b"".join([pieces[i] for i in open_pieces]), np.uint8)
        ids = np.array(self.single, np.int64)[raw]
        word = np.repeat(np.arange(len(open_pieces)), [len(pieces[i]) for i in open_pieces])
        far = len(self.tokens)
        rank = np.full(len(ids), far)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self.pair_ranks(ids[inner], ids[inner + 1])
        done = []
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            counts = np.diff(starts, append=len(ids))
            best = np.repeat(np.minimum.reduceat(rank, starts), counts)
            ended = best == far
            if ended.any():
                done.append((word[ended], ids[ended]))
                ids, word, rank, best = ids[~ended], word[~ended], rank[~ended], best[~ended]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == best)
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]
            ids[at] = rank[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # one token fewer for every merge before
            ids, word = ids[keep], word[keep]
            rank = rank[keep]
            rank[at] = far
            after = at[(at + 1 < len(ids)) & (word[np.minimum(at + 1, len(ids) - 1)] == word[at])]
            before = at[(at > 0) & (word[at - 1] == word[at])] - 1
            for place in (after, before):
                rank[place] = self.pair_ranks(ids[place], ids[place + 1])
        word = np.concatenate([w for w, _ in done])
        ids = np.concatenate([x for _, x in done])
        order = np.argsort(word, kind="stable")
        packed = ids[order].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(word, minlength=len(open_pieces)))).tolist()
        for i, a, b in zip(open_pieces, [0, *ends], ends):
            out[i] = packed[a:b]
        return out

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same order by a heap over a linked list, for pre-tokens of any length."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        find = self.pairs.get
        heap = [(r, i) for i, pair in enumerate(zip(ids, ids[1:])) if (r := find(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or find((ids[i], ids[j])) != rank:
                continue  # one of the two has merged meanwhile
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := find((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (r, a))
        return [x for x in ids if x >= 0]


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(32)).astype(np.int64) & (size - 1)


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Packed ids of the pre-tokens met of late, by their bytes.

    When half of the entries are new, the older half goes, so frequent pre-tokens stay.
    """

    def __init__(self, vocabulary: Vocabulary, most: int):
        self.vocabulary, self.half = vocabulary, most // 2
        self.newer: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        packed = list(map(self.newer.get, pieces))
        missed = [i for i, x in enumerate(packed) if x is None]
        found = dict.fromkeys([pieces[i] for i in missed])
        new = []
        for piece in found:
            found[piece] = self.older.get(piece)
            if found[piece] is None:
                new.append(piece)
        found.update(zip(new, self.vocabulary.merge_all(new)))
        for i in missed:
            packed[i] = found[pieces[i]]
        if len(self.newer) + len(found) > self.half:
            self.older, self.newer = self.newer, {}
        # the cache's size in bytes is bounded too
        self.newer.update((p, x) for p, x in found.items() if len(p) <= 256)
        return packed


@worker_cache(2)
def _vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


@worker_cache(2)
def _encoder(content: bytes, most: int) -> Encoder:
    """Kept by a worker for all of its tasks."""
    return Encoder(_vocabulary(content), most)


def encode_texts(texts: list[str], encoder: Encoder, table: np.ndarray) -> list[bytes]:
    slices = Slices(texts, table)
    packed = encoder.encode(slices.pieces())
    return [b"".join(packed[a:b]) for a, b in zip(slices.first.tolist(), slices.last.tolist())]


def token_starts(ids: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Byte offset of every token in its text."""
    lengths = vocabulary.lengths[ids]
    return np.cumsum(lengths) - lengths


def decode_ids(ids: np.ndarray, starts: np.ndarray, vocabulary: Vocabulary) -> bytes:
    """Every token's bytes put at its offset; a gap or overlap of the offsets is an error."""
    lengths = vocabulary.lengths[ids]
    starts = starts.astype(np.int64)
    if not np.array_equal(starts, np.cumsum(lengths) - lengths):
        raise ValueError("the offsets don't fit the ids")
    source = np.repeat(vocabulary.places[ids] - starts, lengths)
    source += np.arange(len(source))
    return vocabulary.blob[source].tobytes()


def encode(
    df: DataFrame,
    ranks_path: str,
    id: str = "doc_id",
    text: str = "text",
    keep: tuple[Column, ...] = (),
    cache_entries: int = 400_000,
) -> DataFrame:
    """Token ids of every whole text: (id, *keep, n_tokens, ids, starts), one row for each row.

    ``ids`` and ``starts`` (each token's byte offset) are little-endian unsigned
    32-bit integers. A null text is empty and has no tokens; null ids and repeated
    rows stay; columns not named in ``keep`` are left out. No row depends on
    another, so nothing is shuffled. A worker keeps the merges of at most
    ``cache_entries`` pre-tokens.
    """
    spark = df.sparkSession
    content = spark.sparkContext.broadcast(file_content(ranks_path))
    table = spark.sparkContext.broadcast(library_symbols())

    @tidy_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value, cache_entries)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1), SLICE):
                packed = encode_texts(texts, encoder, table.value)
                starts = [
                    token_starts(np.frombuffer(x, "<u4"), encoder.vocabulary).astype("<u4").tobytes() for x in packed
                ]
                counts = pa.array([len(x) // 4 for x in packed], pa.int64())
                rest = [batch.column(i)[a:b] for i in range(2, 2 + len(others))]
                columns = [batch.column(0)[a:b], *rest, counts, pa.array(packed, pa.binary()), pa.array(starts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", *others, "n_tokens", "ids", "starts"])

    rows = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *keep)
    others = rows.columns[2:]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text"]
    coded = rows.mapInArrow(run, ", ".join([*fields, "n_tokens long", "ids binary", "starts binary"]))
    return coded.withColumnRenamed("id", id)


def decode(df: DataFrame, ranks_path: str, id: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Bytes of encoded rows: (id, *keep, n_tokens, ids, decoded), from ``ids`` and ``starts``.

    Null ids decode to nothing (empty bytes).
    """
    spark = df.sparkSession
    content = spark.sparkContext.broadcast(file_content(ranks_path))

    @tidy_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(content.value)
        for batch in batches:
            for a, b, ids in text_slices(batch.column(2), SLICE):
                starts = batch.column(3)[a:b].to_pylist()
                out = [
                    decode_ids(np.frombuffer(x or b"", "<u4"), np.frombuffer(s or b"", "<u4"), vocabulary)
                    for x, s in zip(ids, starts)
                ]
                same = [c[a:b] for i, c in enumerate(batch.columns) if i != 3]
                yield pa.RecordBatch.from_arrays([*same, pa.array(out, pa.binary())], names)

    rows = df.select(F.col(id).alias("id"), "n_tokens", "ids", "starts", *keep)
    names = [*(c for c in rows.columns if c != "starts"), "decoded"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "starts"]
    out = rows.mapInArrow(run, ", ".join([*fields, "decoded binary"]))
    return out.withColumnRenamed("id", id)
