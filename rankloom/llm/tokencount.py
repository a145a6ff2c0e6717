"""Token counts by two tiers: a broadcast table of frequent pre-tokens, and worker caches.

The frequent pre-tokens come from bounded summaries that every task makes of all
its texts; pre-tokens themselves are never shuffled. A pre-token of up to 16 bytes
is packed exactly into two integers, so a hit needs no string. The others, and
those the table lacks, are encoded once by the library and kept by the worker.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import file_content, text_slices, worker_cache
from rankloom.llm.prescan import Slices, library_symbols

_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def packed_keys(slices: Slices) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first 8 bytes, next 8 bytes, length) of every pre-token."""
    padded = np.frombuffer(slices.raw + bytes(16), np.uint8)
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    lengths = slices.stops - slices.starts
    low = words[slices.starts] & _MASKS[np.minimum(lengths, 8)]
    # a pre-token of up to eight bytes may end the buffer; its second half is masked to nothing
    high = words[np.minimum(slices.starts + 8, len(words) - 1)] & _MASKS[np.clip(lengths - 8, 0, 8)]
    return low, high, lengths


def _mixed(low: np.ndarray, high: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    h = (low * _ODD[0]) ^ ((high + lengths.astype(np.uint64)) * _ODD[1])
    h ^= h >> np.uint64(29)
    h *= _ODD[2]
    return h ^ (h >> np.uint64(32))


@dataclass
class LengthTable:
    """Open addressing over packed keys; the longest probe is known."""

    low: np.ndarray
    high: np.ndarray
    length: np.ndarray
    tokens: np.ndarray
    probes: int

    @classmethod
    def build(cls, low: np.ndarray, high: np.ndarray, length: np.ndarray, tokens: np.ndarray) -> LengthTable:
        size = 1 << max(4, int(2 * len(low)).bit_length())
        slots = (_mixed(low, high, length) & np.uint64(size - 1)).astype(np.int64)
        owner = np.full(size, -1)
        probes = 1
        for i, slot in enumerate(slots.tolist()):
            step = 0
            while owner[(slot + step) % size] >= 0:
                step += 1
            owner[(slot + step) % size] = i
            probes = max(probes, step + 1)
        used = owner >= 0

        def spread(values: np.ndarray, kind: type) -> np.ndarray:
            out = np.zeros(size, kind)
            out[used] = values[owner[used]]
            return out

        return cls(spread(low, np.uint64), spread(high, np.uint64), spread(length, np.int8), spread(tokens, np.int8), probes)

    def find(self, low: np.ndarray, high: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each key, 0 where the table lacks it."""
        size = len(self.low)
        out = np.zeros(len(low), np.int64)
        todo = np.flatnonzero(lengths <= 16)
        slots = (_mixed(low[todo], high[todo], lengths[todo]) & np.uint64(size - 1)).astype(np.int64)
        for _ in range(self.probes):
            same = (self.low[slots] == low[todo]) & (self.high[slots] == high[todo]) & (self.length[slots] == lengths[todo])
            out[todo[same]] = self.tokens[slots[same]]
            on = ~same & (self.length[slots] > 0)
            todo, slots = todo[on], (slots[on] + 1) % size
            if not len(todo):
                break
        return out


@worker_cache(2)
def _library(content: bytes):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(content.decode())


class Counter(dict):
    """Tokens of pre-tokens met by this worker, by their bytes; emptied when full."""

    def __init__(self, library, most: int):
        self.library, self.most = library, most

    def learn(self, pieces: set[bytes]) -> dict[bytes, int]:
        """Counts of all the pieces; new ones are encoded in one call."""
        new = [p for p in pieces if p not in self]
        out = {p: self[p] for p in pieces if p in self}
        for a in range(0, len(new), 50_000):
            some = new[a : a + 50_000]
            coded = self.library.encode_batch([p.decode() for p in some], add_special_tokens=False)
            for piece, one in zip(some, coded):
                out[piece] = len(one.ids)
                if len(piece) <= 256:
                    if len(self) >= self.most:
                        self.clear()
                    self[piece] = out[piece]
        return out


@worker_cache(2)
def _counter(content: bytes, most: int) -> Counter:
    return Counter(_library(content), most)


def _segments(text: str, special: tuple[str, ...]) -> tuple[list[str], int]:
    """The text without its special strings, and how many there were; the earliest, then the longest, is taken first."""
    parts, count, at = [], 0, 0
    while True:
        found = [(p, -len(s), s) for s in special if (p := text.find(s, at)) >= 0]
        if not found:
            return [*parts, text[at:]], count
        place, _, mark = min(found)
        parts.append(text[at:place])
        at, count = place + len(mark), count + 1


def _special(library) -> tuple[str, ...]:
    added = library.get_added_tokens_decoder().values()
    if any(t.lstrip or t.rstrip or t.single_word for t in added):
        raise ValueError("added tokens that take the text around them are not supported")
    return tuple(t.content for t in added if t.content)


def _plain(texts: list[str], special: tuple[str, ...]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Segments of all texts, the text that each belongs to, and the special tokens of each text."""
    parts, owners, counts = [], [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found, counts[i] = _segments(text, special) if any(s in text for s in special) else ([text], 0)
        parts += found
        owners += [i] * len(found)
    return parts, np.array(owners, np.int64), counts


def _merged(keys: list[tuple[np.ndarray, ...]], most: int) -> tuple[np.ndarray, ...]:
    """Counts of equal keys added up; the ``most`` largest remain."""
    low, high, length, n = (np.concatenate(x) for x in zip(*keys))
    order = np.argsort(_mixed(low, high, length), kind="stable")
    low, high, length, n = low[order], high[order], length[order], n[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (length[1:] != length[:-1])
    first = np.flatnonzero(new)
    n = np.add.reduceat(n, first) if len(first) else n
    low, high, length = low[first], high[first], length[first]
    if len(n) > most:
        top = np.argpartition(-n, most)[:most]
        low, high, length, n = low[top], high[top], length[top], n[top]
    return low, high, length, n


Counted = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # (low, high, length, n)
SUMMARY = "task int, low binary, high binary, length binary, n binary"
FAN = 16  # Summaries merged at once, in a task of the tree and by the driver at its root.


def _summary(task: int, counted: Counted) -> pa.RecordBatch:
    arrays = [pa.array([task], pa.int32()), *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in counted]]
    return pa.RecordBatch.from_arrays(arrays, ["task", "low", "high", "length", "n"])


def _joined(summaries: pa.Table, most: int) -> Counted:
    kinds = {"low": np.uint64, "high": np.uint64, "length": np.int64, "n": np.int64}
    parts = [np.frombuffer(b"".join(summaries[c].to_pylist()), kind) for c, kind in kinds.items()]
    return _merged([tuple(parts)], most)


def frequent_pretokens(df: DataFrame, content: bytes, size: int, text: str = "text", per_task: int = 16_384) -> Counted:
    """The ``size`` most frequent pre-tokens of up to 16 bytes, those of most tokens first.

    Each task reads all its texts and keeps a summary of ``per_task`` keys, one packed
    row. No pre-token is shuffled: summaries are merged whole, ``FAN`` at a time, into
    summaries of bounded size. A key that a summary let go costs time later, never a count.
    """
    sc = df.sparkSession.sparkContext
    held, table = sc.broadcast(content), sc.broadcast(library_symbols())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = _special(_library(held.value))
        kept: list[Counted] = []
        for batch in batches:
            for _, _, texts in text_slices(batch.column(0)):
                low, high, length = packed_keys(Slices(_plain(texts, special)[0], table.value))
                short = length <= 16
                ones = np.ones(int(short.sum()), np.int64)
                chunk = _merged([(low[short], high[short], length[short], ones)], 4 * per_task)
                kept = [_merged([*kept, chunk], 4 * per_task)]
        if kept:
            yield _summary(TaskContext.get().partitionId(), _merged(kept, per_task))

    def merge(summaries: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_summary(summaries["task"][0].as_py(), _joined(summaries, max(size, per_task)))])

    rows = df.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    found, width = rows.mapInArrow(run, SUMMARY), rows.rdd.getNumPartitions()
    while width > FAN:
        found = found.withColumn("task", (F.col("task") / FAN).cast("int")).groupBy("task").applyInArrow(merge, SUMMARY)
        width = -(-width // FAN)
    low, high, length, n = _joined(found.toArrow(), size)
    order = np.lexsort((high, low, length, -n))
    return low[order], high[order], length[order], n[order]


def length_table(low: np.ndarray, high: np.ndarray, length: np.ndarray, library) -> LengthTable:
    pieces = [(a.tobytes() + b.tobytes())[:n].decode() for a, b, n in zip(low, high, length)]
    tokens = np.array([len(x.ids) for x in library.encode_batch(pieces, add_special_tokens=False)], np.int64)
    return LengthTable.build(low, high, length, tokens)


def count_tokens(
    df: DataFrame,
    tokenizer_path: str,
    id: str = "doc_id",
    text: str = "text",
    table_size: int = 65_536,
    cache_entries: int = 400_000,
) -> DataFrame:
    """(id, n_bytes, n_tokens) of every whole text, one row for each row.

    Counts are those of the library for a byte-level BPE file, added tokens inside
    a text as its default has them, none added at the ends. A null text is empty:
    no bytes, no tokens. Null ids and repeated rows stay; other columns are left out.
    ``table_size`` bounds the broadcast table (36 bytes an entry), ``cache_entries``
    a worker's cache; neither changes a count.
    """
    sc = df.sparkSession.sparkContext
    content = file_content(tokenizer_path)
    low, high, length, _ = frequent_pretokens(df, content, table_size, text)
    tier = sc.broadcast(length_table(low, high, length, _library(content)))
    held, table = sc.broadcast(content), sc.broadcast(library_symbols())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(held.value, cache_entries)
        special = _special(counter.library)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                parts, owners, tokens = _plain(texts, special)
                slices = Slices(parts, table.value)
                counts = tier.value.find(*packed_keys(slices))
                missed = np.flatnonzero(counts == 0)
                raw = slices.raw
                pieces = [raw[x:y] for x, y in zip(slices.starts[missed].tolist(), slices.stops[missed].tolist())]
                known = counter.learn(set(pieces))
                counts[missed] = [known[p] for p in pieces]
                before = np.concatenate([[0], np.cumsum(counts)])
                np.add.at(tokens, owners, before[slices.last] - before[slices.first])
                n_bytes = [len(t.encode()) for t in texts]
                columns = [batch.column(0)[a:b], pa.array(n_bytes, pa.int64()), pa.array(tokens)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens"])

    whole = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = whole.schema["id"].dataType.simpleString()
    return whole.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id)
