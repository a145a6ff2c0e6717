"""Class-based bigram scores of whole texts (Brown's model with exchange clustering).

Every word belongs to a unit: a word of at least ``min_count`` training tokens is its own
unit, any other word, seen or not, shares one with words of the same ending. Exchange
clustering moves units between classes while that raises the likelihood of the class
bigrams. A word after another has the probability

    (n(w) + 0.5) * G(class before, class of w),

where ``n`` is its training count and ``G`` holds the class transition, the class's
emission total and the share of the unigram model, all of bounded size.

Words are told apart by 64-bit hashes. Neighbouring units are counted once: a task adds up
its own tokens, and each unit's lists of neighbours after and before it end up in one of
many packed blocks. A step of the exchange then shuffles no pairs: the classes of all
units, an array of bounded size, go to the tasks, and the units of an eighth of the blocks
move at once to the classes that are best for them. A step that lowers the likelihood is
tried again with fewer of its moves, or undone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import text_slices, tidy_task
from rankloom.llm.words import hashes_and_endings, mix
from rankloom.session import stash

END = b"\n"  # the token that ends each text; no word holds white space
END_KEY = -1
SUFFIX = 3  # bytes of a word that make its ending


def words_of(text: str) -> list[bytes]:
    """Words of a text, A-Z lower-cased; bytes methods know ASCII only."""
    return text.encode().lower().split()


def add_up(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(n)
    order = np.argsort(key)
    key, count = key[order], count[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


class Adder:
    """Counts by key, added up whenever more than ``most`` entries, or twice what was left last, are held."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys, self.n, self.held, self.limit = [], [], 0, self.most

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.keys.append(keys)
        self.n.append(n)
        self.held += len(keys)
        if self.held > self.limit:
            self.total()
            self.limit = max(self.most, 2 * self.held)

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.keys) != 1:
            keys, n = add_up([np.zeros(0, np.int64), *self.keys], [np.zeros(0, np.int64), *self.n])
            self.keys, self.n, self.held = [keys], [n], len(keys)
        return self.keys[0], self.n[0]


def word_counts(rows: DataFrame, endings: int = 512) -> DataFrame:
    """(key, ending, n) of all tokens, ends of texts included (key -1); ``rows`` has ``text``. Tasks add up before the shuffle."""

    @tidy_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ends, n, held = [], [], [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            key, ending, count = (np.concatenate(x) for x in (keys, ends, n))
            order = np.argsort(key)
            key, ending, count = key[order], ending[order], count[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            columns = [key[first], ending[first], np.add.reduceat(count, first)]
            for a in range(0, len(first), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 100_000]) for x in columns], ["key", "ending", "n"])

        for batch in batches:
            for _, _, texts in text_slices(batch.column(0)):
                hashes, _, last = hashes_and_endings(texts, SUFFIX)
                key, at, count = np.unique(hashes.view(np.int64), return_index=True, return_counts=True)
                keys += [key, np.array([END_KEY])]
                ends += [(last[at] % np.uint64(endings)).astype(np.int16), np.zeros(1, np.int16)]
                n += [count, np.array([len(texts)])]
                held += len(key)
                if held > 1_500_000:
                    yield from packed()
                    keys, ends, n, held = [], [], [], 0
        if n:
            yield from packed()

    counted = rows.select("text").mapInArrow(run, "key long, ending short, n long")
    return counted.groupBy("key", "ending").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """Units: words by falling frequency, then the endings, then the end of texts."""

    keys: np.ndarray  # sorted hashes of the words that are units
    places: np.ndarray  # their units
    counts: np.ndarray  # training tokens by unit
    endings: int

    @property
    def size(self) -> int:
        return len(self.keys) + self.endings + 1

    def sequence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit, key, place of the end) of all tokens of all texts, each text with its end."""
        hashes, counts, last = hashes_and_endings(texts, SUFFIX)
        words = len(self.keys)
        different, back = np.unique(hashes.view(np.int64), return_inverse=True)
        place = np.full(len(different), -1, np.int64)
        if words:
            at = np.minimum(np.searchsorted(self.keys, different), words - 1)
            same = self.keys[at] == different
            place[same] = self.places[at[same]]
        ends = np.cumsum(counts + 1) - 1
        inside = np.ones(len(hashes) + len(texts), bool)
        inside[ends] = False
        unit = np.full(len(inside), self.size - 1)
        unit[inside] = np.where(place[back] >= 0, place[back], words + (last % np.uint64(self.endings)).astype(np.int64))
        key = np.full(len(inside), END_KEY)
        key[inside] = hashes.view(np.int64)
        return unit, key, ends


def previous(unit: np.ndarray) -> np.ndarray:
    """The unit before each one; the one before a text's first token is the end of texts, which stands last."""
    return np.append(unit[-1:], unit[:-1])


def lexicon_of(counts: DataFrame, endings: int, min_count: int, most_units: int) -> tuple[Lexicon, int]:
    """Units of all words of ``min_count`` tokens, and the count from which words are units.

    If there are more than ``most_units`` such words, the count is the smallest power of
    2 ** (1 / 8) that leaves no more; the others are classed by their endings.
    """
    words = counts.filter((F.col("key") != END_KEY) & (F.col("n") >= min_count))
    step = F.floor(F.log2("n") * 8)
    steps = sorted(((r["s"], r["m"]) for r in words.groupBy(step.alias("s")).agg(F.count("n").alias("m")).collect()), reverse=True)
    total, lowest = 0, min_count
    for s, m in steps:
        total += m
        if total > most_units:
            lowest = max(min_count, int(np.ceil(2 ** ((s + 1) / 8))))
            break
    found = words.filter(F.col("n") >= lowest).select("key", "n").toArrow()
    key, n = (found[c].to_numpy().astype(np.int64) for c in ("key", "n"))
    order = np.lexsort((key, -n))
    key, n = key[order], n[order]
    order = np.argsort(key)
    return Lexicon(key[order], order.astype(np.int32), n, endings), lowest


def pack(keys: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted keys as differences, and counts, byte by byte of each number, compressed."""
    both = np.stack([np.diff(keys, prepend=0), n])
    planes = np.ascontiguousarray(both.view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1))
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(data, 16 * size, codec="zstd", asbytes=True), np.uint8).reshape(2, 8, size)
    both = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64).reshape(2, size)
    return np.cumsum(both[0]), both[1]


LISTS = "block int, part int, size int, data binary"


def _lists(block: int, part: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([part], pa.int32()), pa.array([len(keys)], pa.int32()), pa.array([pack(keys, n)], pa.binary())],
        ["block", "part", "size", "data"],
    )


def neighbour_lists(rows: DataFrame, lexicon: Lexicon, tokens: int, flush: int = 2_500_000, fan_in: int = 256) -> DataFrame:
    """(block, group, size, data): packed counts of the units after and before the units of each block.

    A key is ``(unit * 2 + side) * units + other``, side 1 for the units before; a unit
    after itself is on side 0 only. Parts of a block are merged at most about ``fan_in``
    at a time, so that a frequent unit of a large corpus is merged by many tasks.
    """
    spark = rows.sparkSession
    held, size = spark.sparkContext.broadcast(lexicon), lexicon.size
    blocks = max(16, min(4096, -(-tokens // 4_000_000)))

    @tidy_task
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        draw = np.random.default_rng()
        parts, sums = [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            pair = np.sort(np.concatenate(parts))
            first_of = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
            n = np.diff(np.append(first_of, len(pair)))
            first, second = np.divmod(pair[first_of], size)
            other = first != second
            unit = np.concatenate([first, second[other]])
            key = np.concatenate([(first * 2) * size + second, (second[other] * 2 + 1) * size + first[other]])
            n = np.concatenate([n, n[other]])
            block = (mix(unit.astype(np.uint64)) % np.uint64(blocks)).astype(np.int16)
            order = np.lexsort((key, block))
            ends = np.searchsorted(block[order], np.arange(blocks + 1))
            part = int(draw.integers(0, 1 << 30))
            for b in np.flatnonzero(np.diff(ends)).tolist():
                own = order[ends[b] : ends[b + 1]]
                yield _lists(b, part, key[own], n[own])

        for batch in batches:
            for _, _, texts in text_slices(batch.column(0)):
                unit, _, _ = known.sequence(texts)
                parts.append(previous(unit) * size + unit)
                sums += len(unit)
                if sums > flush:
                    yield from packed()
                    parts, sums = [], 0
        if parts:
            yield from packed()

    @tidy_task
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, lists = None, Adder(6_000_000)
        for batch in batches:
            for r in range(batch.num_rows):
                at = (batch.column(0)[r].as_py(), batch.column(1)[r].as_py())
                if current is not None and at != current:
                    yield _lists(*current, *lists.total())
                    lists.clear()
                current = at
                lists.add(*unpack(batch.column(3)[r].as_buffer(), batch.column(2)[r].as_py()))
        if current is not None:
            yield _lists(*current, *lists.total())

    found = rows.select("text").mapInArrow(count, LISTS)
    parts = max(1, -(-tokens // flush))
    while True:
        parts = -(-parts // fan_in)
        found = found.withColumn("part", (F.col("part") % parts).cast("int"))
        found = found.repartition(blocks * min(parts, 64), "block", "part").sortWithinPartitions("block", "part").mapInArrow(merge, LISTS)
        if parts <= 1:
            break
    return found.select("block", (F.col("block") % 8).cast("int").alias("group"), "size", "data")


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(table: np.ndarray) -> float:
    return float(_h(table).sum() - _h(table.sum(axis=0)).sum() - _h(table.sum(axis=1)).sum())


def best_classes(table: np.ndarray, own: np.ndarray, right: np.ndarray, left: np.ndarray, loop: np.ndarray) -> np.ndarray:
    """For each of several units the class that raises the likelihood most, all others staying; the last class takes no unit.

    ``right`` and ``left`` (units x classes) count the classes of other units after and before
    each unit, ``loop`` the unit after itself.
    """
    each = np.arange(len(own))
    gain = np.zeros(right.shape)
    for cells, mine, other in ((table.T, right, left), (table, left, right)):
        at, d = np.nonzero(mine)
        if not len(at):
            continue
        x = mine[at, d]
        base = cells[d]  # the counts of d with every class, without the unit
        base[np.arange(len(at)), own[at]] -= x
        hit = np.flatnonzero(d == own[at])
        base[hit] -= other[at[hit]]
        base[hit, d[hit]] -= loop[at[hit]]
        part = _h(base + x[:, None]) - _h(base)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        gain[at[first]] += np.add.reduceat(part, first)
    rows, columns, cells = (np.repeat(v[None], len(own), 0) for v in (table.sum(axis=1), table.sum(axis=0), table.diagonal()))
    rights, lefts = right.sum(axis=1) + loop, left.sum(axis=1) + loop
    rows[each, own] -= rights
    columns[each, own] -= lefts
    cells[each, own] -= right[each, own] + left[each, own] + loop
    gain += _h(cells + right + left + loop[:, None]) - _h(cells + right) - _h(cells + left) + _h(cells)
    gain -= _h(rows + rights[:, None]) - _h(rows) + _h(columns + lefts[:, None]) - _h(columns)
    gain[:, -1] = -np.inf
    best = np.argmax(gain, axis=1)
    return np.where(gain[each, best] > gain[each, own] + 1e-9, best, own)


def class_table(lists: DataFrame, of: np.ndarray, classes: int) -> np.ndarray:
    """Counts of neighbouring classes, from the lists of the units after each unit."""
    size = len(of)
    held = lists.sparkSession.sparkContext.broadcast(of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = held.value
        sums = np.zeros(classes * classes)
        for batch in batches:
            for r in range(batch.num_rows):
                key, n = unpack(batch.column(1)[r].as_buffer(), batch.column(0)[r].as_py())
                after = key // size % 2 == 0
                key, n = key[after], n[after]
                sums += np.bincount(of[key // (2 * size)].astype(np.int64) * classes + of[key % size], n, classes * classes)
        full = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(sums[full].astype(np.int64))], ["cell", "n"])

    cells = lists.select("size", "data").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    held.unpersist()
    table = np.zeros(classes * classes)
    table[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return table.reshape(classes, classes)


def moves(lists: DataFrame, of: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit, class) of the units of ``lists`` that another class is best for, the others staying."""
    size, classes = len(of), len(table)
    held = lists.sparkSession.sparkContext.broadcast((of, table))

    @tidy_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, table = held.value
        for batch in batches:
            for r in range(batch.num_rows):
                key, n = unpack(batch.column(1)[r].as_buffer(), batch.column(0)[r].as_py())
                start = np.flatnonzero(np.append(True, np.diff(key // (2 * size)) != 0))
                ends = np.append(start, len(key))
                for a in range(0, len(start), 512):
                    part = slice(ends[a], ends[min(a + 512, len(start))])
                    k, count = key[part], n[part]
                    unit, other = k // (2 * size), k % size
                    units = unit[ends[a : min(a + 512, len(start))] - ends[a]]
                    cell = np.where(unit == other, 2 * classes, k // size % 2 * classes + of[other])
                    width = 2 * classes + 1
                    sums = np.bincount(np.searchsorted(units, unit) * width + cell, count, len(units) * width).reshape(-1, width)
                    own = of[units].astype(np.int64)
                    best = best_classes(table, own, sums[:, :classes], sums[:, classes:-1], sums[:, -1])
                    new = (best != own) & (units != size - 1)
                    yield pa.RecordBatch.from_arrays([pa.array(units[new]), pa.array(best[new])], ["unit", "c"])

    found = lists.select("size", "data").mapInArrow(run, "unit long, c long").toArrow()
    held.unpersist()
    return found["unit"].to_numpy(), found["c"].to_numpy()


def exchange(lists: DataFrame, size: int, classes: int, sweeps: int, settled: float = 0.02) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(class of each unit, class table, likelihood after each sweep); the end of texts is a class of its own, the last.

    Starts from units dealt out by frequency, so that each of the most frequent words stands
    for a class. Ends after ``sweeps``, or when a sweep has gained less than ``settled`` of
    what all have.
    """
    of = np.append(np.arange(size - 1) % (classes - 1), classes - 1).astype(np.int16)
    table = class_table(lists, of, classes)
    values = [likelihood(table)]
    for sweep in range(sweeps):
        value = values[-1]
        for group in range(8):
            unit, c = moves(lists.filter(F.col("group") == group), of, table)
            order = np.argsort(mix(unit.astype(np.uint64) + np.uint64(sweep << 40)))
            for parts in (1, 4, 16) if len(unit) else ():  # units that move to the same class at once may do too much together
                some = order[: -(-len(unit) // parts)]
                trial = of.copy()
                trial[unit[some]] = c[some]
                tried = class_table(lists, trial, classes)
                if likelihood(tried) > value:
                    of, table, value = trial, tried, likelihood(tried)
                    break
        values.append(value)
        if value - values[-2] <= settled * (value - values[0]):
            break
    return of, table, values


@dataclass
class ClassModel:
    """What a task needs to score: units with their counts and classes, and the class table."""

    lexicon: Lexicon
    classes: np.ndarray
    log_g: np.ndarray
    end_count: int
    tokens: int
    kinds: int


def _share(transition: np.ndarray, emission: np.ndarray, unigram: float, held: np.ndarray) -> float:
    """Weight of the class model, by EM on class bigrams of the other fold."""
    weight = 0.5
    if not held.sum():
        return weight
    model = transition * emission[None, :]
    for _ in range(50):
        mine = weight * model
        weight = float((held * mine / (mine + (1 - weight) * unigram)).sum() / held.sum())
    return min(max(weight, 0.001), 0.999)


def _log_g(fold0: np.ndarray, fold1: np.ndarray, class_n: np.ndarray, class_v: np.ndarray, tokens: int, kinds: int) -> np.ndarray:
    """log10 of G from the class tables of both folds and the tokens and words of every class."""
    emission = 1.0 / (class_n + 0.5 * (class_v + 1))
    unigram = 1.0 / (tokens + 0.5 * (kinds + 1))
    prior = (class_n + 0.5) / (class_n + 0.5).sum()

    def transitions(table: np.ndarray) -> np.ndarray:
        return (table + prior) / (table.sum(axis=1, keepdims=True) + 1)

    weight = _share(transitions(fold0), emission, unigram, fold1)
    return np.log10(weight * transitions(fold0 + fold1) * emission[None, :] + (1 - weight) * unigram)


def fold_table(rows: DataFrame, lexicon: Lexicon, of: np.ndarray, classes: int) -> np.ndarray:
    """Counts of neighbouring classes in the texts of ``rows``."""
    held = rows.sparkSession.sparkContext.broadcast((lexicon, of))

    @tidy_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, of = held.value
        sums = np.zeros(classes * classes, np.int64)
        for batch in batches:
            for _, _, texts in text_slices(batch.column(0)):
                c = of[known.sequence(texts)[0]].astype(np.int64)
                sums += np.bincount(previous(c) * classes + c, minlength=classes * classes)
        full = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(sums[full])], ["cell", "n"])

    cells = rows.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(classes * classes)
    table[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return table.reshape(classes, classes)


def train(
    rows: DataFrame,
    counts: DataFrame,
    endings: int = 512,
    classes: int = 64,
    min_count: int = 5,
    most_units: int = 2_000_000,
    sweeps: int = 8,
    flush: int = 2_500_000,
    fan_in: int = 256,
) -> ClassModel:
    """Fit on all ``rows`` (text, fold); ``counts`` are their stored ``word_counts`` with the same ``endings``.

    Every word of ``min_count`` tokens is a unit, up to ``most_units`` of them, which bounds
    what is broadcast and what the driver holds (20 bytes a unit); every word has a unit, a class
    and its exact count. The folds, 0 and 1, serve to weigh the class model against the
    unigram model.
    """
    totals = counts.agg(
        F.sum("n").alias("tokens"), F.count("n").alias("kinds"), F.sum(F.when(F.col("key") == END_KEY, F.col("n"))).alias("ends")
    ).first()
    tokens, kinds, end_count = totals["tokens"] or 0, totals["kinds"], totals["ends"] or 0
    lexicon, lowest = lexicon_of(counts, endings, min_count, most_units)
    words = len(lexicon.keys)
    lists = stash(neighbour_lists(rows, lexicon, tokens, flush, fan_in), "lm-lists")
    of, table, _ = exchange(lists, lexicon.size, classes, sweeps)

    first_fold = fold_table(rows.filter("fold = 0"), lexicon, of, classes)
    class_n = table.sum(axis=0)  # every token stands after one other
    class_v = np.bincount(of[:words], minlength=classes).astype(float)
    class_v[-1] = float(end_count > 0)
    rare = counts.filter((F.col("n") < lowest) & (F.col("key") != END_KEY)).groupBy("ending").agg(F.count("n").alias("v"))
    for r in rare.collect():  # at most one row for each ending
        class_v[of[words + r["ending"]]] += r["v"]
    log_g = _log_g(first_fold, table - first_fold, class_n, class_v, tokens, kinds)
    return ClassModel(lexicon, of, log_g, end_count, tokens, kinds)


def score(
    df: DataFrame, model: ClassModel, counts: DataFrame, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, n_tokens, n_known, base_score, score, perplexity) of every whole text, one row for each row.

    ``base_score`` is the smoothed unigram model's log10 probability, ``score`` the
    class model's. A null or empty text is its end alone. Repeated rows come out as
    often as they went in; null ids stay; other columns are left out. Counts of words
    that are no units are looked up by a join.
    """
    held = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    @tidy_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        words, end_unit = len(m.lexicon.keys), m.lexicon.size - 1
        logs = np.full(m.lexicon.size, np.nan)
        logs[:words] = np.log10(m.lexicon.counts + 0.5)
        logs[end_unit] = np.log10(m.end_count + 0.5)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(2)):
                unit, key, ends = m.lexicon.sequence(texts)
                starts = np.append(0, ends[:-1] + 1)
                c = m.classes[unit].astype(np.int64)
                sum_g = np.add.reduceat(m.log_g[previous(c), c], starts)
                own = logs[unit]
                out = np.isnan(own)
                known = ~out
                if not m.end_count:
                    known[ends] = False
                sum_log = np.add.reduceat(np.where(out, 0.0, own), starts)
                text_of = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=-1))
                at, word = text_of[out], key[out]
                order = np.lexsort((word, at))
                at, word = at[order], word[order]
                first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (word[1:] != word[:-1]))) if len(at) else at
                times = np.diff(np.append(first, len(at)))
                ids, docs = batch.column(0)[a:b], batch.column(1)[a:b]
                whole = [ids, docs, pa.nulls(b - a, pa.int64()), pa.array(np.ones(b - a, np.int64)),
                         pa.array(np.add.reduceat(known.astype(np.int64), starts)), pa.array(np.diff(ends, prepend=-1)),
                         pa.array(sum_log), pa.array(sum_g)]
                yield pa.RecordBatch.from_arrays(whole, NAMES)
                for s in range(0, len(first), 100_000):
                    e = min(s + 100_000, len(first))
                    none = pa.nulls(e - s, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(e - s, ids.type), docs.take(pa.array(at[first[s:e]])), pa.array(word[first[s:e]]),
                         pa.array(times[s:e]), none, none, none.cast(pa.float64()), none.cast(pa.float64())], NAMES
                    )

    NAMES = ["id", "doc", "word", "times", "known", "tokens", "sum_log", "sum_g"]
    # rows of one id and text are added up; ids whose hash is the same as another's are told apart by themselves
    coded = rows.select("id", F.xxhash64("id", "text").alias("doc"), "text").mapInArrow(
        run, f"id {kind}, doc long, word long, times long, known long, tokens long, sum_log double, sum_g double"
    )
    coded = stash(coded, "lm-parts")
    # a word outside the units has few tokens; what its documents need is their sum
    looked = coded.filter("word IS NOT NULL").select("doc", F.col("word").alias("key"), "times").join(
        counts.select("key", F.col("n").alias("c")), "key", "left"
    )
    looked = looked.groupBy("doc").agg(
        F.sum(F.when(F.col("c").isNull(), 0).otherwise(F.col("times"))).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_log"),
    )
    whole = coded.filter("word IS NULL").groupBy("id", "doc").agg(
        F.sum("times").alias("rows"), *[F.sum(c).alias(c) for c in ("known", "tokens", "sum_log", "sum_g")]
    )
    sums = whole.join(looked, "doc", "left")
    # equal rows were added up; each comes out with its part
    each = sums.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    tokens = (F.col("tokens") / F.col("rows")).cast("long")
    log = (F.col("sum_log") + F.coalesce("rare_log", F.lit(0.0))) / F.col("rows")
    g = F.col("sum_g") / F.col("rows")
    unigram = float(np.log10(model.tokens + 0.5 * (model.kinds + 1)))
    return each.select(
        F.col("id").alias(id),
        tokens.alias("n_tokens"),
        ((F.col("known") + F.coalesce("rare_known", F.lit(0))) / F.col("rows")).cast("long").alias("n_known"),
        (log - tokens * F.lit(unigram)).alias("base_score"),
        (log + g).alias("score"),
        F.pow(F.lit(10.0), -(log + g) / tokens).alias("perplexity"),
    )
