"""Exact BM25 top-k: a sharded inverted index searched with block-max pruning.

Rows are dealt into shards of a stated size. A task builds the inverted index of its
shard and then reads all queries, each with its terms' global weights, in batches. The
rows of a shard are ordered by length and cut into blocks; for every block the index
has each term's largest impact. A batch of queries goes through the blocks from the
most to the least promising one. A block is scored only for those queries whose block
maxima reach their k-th best score so far, which rises as blocks are scored. Weights
are global, so the shards' lists merge to the exact result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.classlm import words_of
from rankloom.llm.common import text_slices
from rankloom.session import stash

K1, B = 1.2, 0.75
DIGITS = 6  # scores are rounded before they are compared, so that sums in another order tie alike
BLOCK = 256  # rows of a block of the index
QUERIES = 500  # queries that go through the blocks together


class ShardIndex:
    """Postings of one shard, by term; the impacts of frequent terms also as rows of a matrix, with block maxima."""

    def __init__(self, texts: list[str], mean_length: float):
        found = [Counter(words_of(t)) for t in texts]
        lengths = np.array([sum(f.values()) for f in found], float)
        self.order = np.argsort(lengths, kind="stable")  # of the index's rows in the given texts
        self.rows = len(texts)
        self.numbers: dict[bytes, int] = {}
        terms, rows, counts = [], [], []
        for row, place in enumerate(self.order.tolist()):
            terms += [self.numbers.setdefault(w, len(self.numbers)) for w in found[place]]
            rows += [row] * len(found[place])
            counts += found[place].values()
        term, row, n = np.array(terms, np.int64), np.array(rows, np.int64), np.array(counts, float)
        by_term = np.lexsort((row, term))
        term, row, n = term[by_term], row[by_term], n[by_term]
        self.row = row
        self.impact = n * (K1 + 1) / (n + K1 * (1 - B + B * lengths[self.order][row] / max(mean_length, 1e-9)))
        self.ends = np.searchsorted(term, np.arange(len(self.numbers) + 1))
        self.blocks = -(-self.rows // BLOCK)
        sizes = np.diff(self.ends)
        frequent = np.flatnonzero(sizes >= max(16, self.rows // 64))
        frequent = frequent[np.argsort(-sizes[frequent], kind="stable")][:1000]
        self.place = np.full(len(self.numbers), -1)
        self.place[frequent] = np.arange(len(frequent))
        self.exact = np.zeros((len(frequent), self.blocks * BLOCK))
        for i, t in enumerate(frequent.tolist()):
            span = slice(self.ends[t], self.ends[t + 1])
            self.exact[i, self.row[span]] = self.impact[span]
        self.matrix = self.exact.astype(np.float32)
        self.most = self.matrix.reshape(len(frequent), self.blocks, BLOCK).max(axis=2) if self.rows else self.matrix
        self.scored = 0  # pairs of a query and a block whose rows were scored

    def _rare(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query * rows + row, score) of all rows that hold a query's rare terms, in order."""
        size = self.ends[term + 1] - self.ends[term]
        at = np.repeat(self.ends[term] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        key = np.repeat(query, size) * (self.blocks * BLOCK) + self.row[at]
        value = self.impact[at] * np.repeat(weight, size)
        by_key = np.argsort(key, kind="stable")
        key, value = key[by_key], value[by_key]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        return key[first], np.add.reduceat(value, first) if len(first) else value

    def search(self, queries: list[list[tuple[bytes, float]]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (places, rounded scores) of all texts that can be among the k best, ties included."""
        count, width = len(queries), self.blocks * BLOCK
        weights = np.zeros((count, len(self.exact)))
        rare: list[tuple[int, int, float]] = []
        for q, words in enumerate(queries):
            for word, weight in words:
                term = self.numbers.get(word)
                if term is not None:
                    if self.place[term] >= 0:
                        weights[q, self.place[term]] += weight
                    else:
                        rare.append((q, term, weight))
        nothing = [(np.zeros(0, np.int64), np.zeros(0))] * count
        if not self.rows or not (rare or weights.any()):
            return nothing
        parts = np.array(rare).reshape(-1, 3)
        key, value = self._rare(parts[:, 0].astype(np.int64), parts[:, 1].astype(np.int64), parts[:, 2])
        small = weights.astype(np.float32)
        # what a block can give a query: maxima of its frequent terms, and its best row of rare ones
        bounds = (small @ self.most).astype(float)
        cell = key // width * self.blocks + key % width // BLOCK
        np.maximum.at(bare := np.zeros(count * self.blocks), cell, value)
        bounds = bounds * (1 + 1e-5) + bare.reshape(count, self.blocks)
        by_block = np.argsort(cell % self.blocks, kind="stable")
        starts = np.searchsorted((cell % self.blocks)[by_block], np.arange(self.blocks + 1))
        best = np.zeros((count, k), np.float32)
        floor = np.zeros(count)
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for block in np.argsort(-bounds.sum(axis=0), kind="stable").tolist():
            alive = np.flatnonzero((bounds[:, block] > 0) & (bounds[:, block] >= floor))
            if not len(alive):
                continue
            self.scored += len(alive)
            scores = small[alive] @ self.matrix[:, block * BLOCK : (block + 1) * BLOCK]
            some = by_block[starts[block] : starts[block + 1]]
            at = np.full(count, -1)
            at[alive] = np.arange(len(alive))
            own = at[key[some] // width]
            scores[own[own >= 0], (key[some] % width % BLOCK)[own >= 0]] += value[some][own >= 0]
            both = np.concatenate([best[alive], scores], axis=1)
            best[alive] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            # single precision and rounding are allowed for
            floor[alive] = best[alive].min(axis=1) * (1 - 1e-4) - 2 * 10.0**-DIGITS
            q, row = np.nonzero((scores > 0) & (scores >= floor[alive][:, None]))
            kept.append((alive[q], block * BLOCK + row, scores[q, row]))
        if not kept:
            return nothing
        query, row, rough = (np.concatenate(x) for x in zip(*kept))
        last = rough >= floor[query]
        query, row = query[last], row[last]
        score = np.zeros(len(query))
        for a in range(0, len(query), 20_000):
            part = slice(a, a + 20_000)
            score[part] = np.einsum("ij,ij->i", weights[query[part]], self.exact[:, row[part]].T)
        wanted = query * width + row
        found = np.minimum(np.searchsorted(key, wanted), max(len(key) - 1, 0))
        if len(key):
            score += np.where(key[found] == wanted, value[found], 0.0)
        score = np.round(score, DIGITS)
        by_query = np.argsort(query, kind="stable")
        cuts = np.searchsorted(query[by_query], np.arange(count + 1)).tolist()
        return [(self.order[row[by_query[a:b]]], score[by_query[a:b]]) for a, b in zip(cuts, cuts[1:])]


def _term_counts(rows: DataFrame) -> DataFrame:
    """(word, rows with it, words in all); the null word counts rows and their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        size = total = 0

        def packed() -> pa.RecordBatch:
            words = pa.array([*held, None], pa.binary())
            counts = pa.array([*held.values(), size], pa.int64())
            return pa.RecordBatch.from_arrays([words, counts, pa.array([0] * len(held) + [total], pa.int64())], ["word", "n", "words"])

        for batch in batches:
            for _, _, texts in text_slices(batch.column(0)):
                for text in texts:
                    words = words_of(text)
                    held.update(set(words))
                    size, total = size + 1, total + len(words)
                if len(held) > 400_000:
                    yield packed()
                    held.clear()
                    size = total = 0
        yield packed()

    counted = rows.select("text").mapInArrow(run, "word binary, n long, words long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))


def _query_terms(queries: DataFrame) -> DataFrame:
    """(query, word, times) of the words of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                found = [Counter(words_of(t)) for t in texts]
                sizes = pa.array(np.repeat(np.arange(a, b), [len(f) for f in found]))
                words = pa.array([w for f in found for w in f], pa.binary())
                times = pa.array([n for f in found for n in f.values()], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(sizes), words, times], ["query", "word", "times"])

    kind = queries.schema["query"].dataType.simpleString()
    return queries.select("query", "text").mapInArrow(run, f"query {kind}, word binary, times long")


def bm25_top_k(
    df: DataFrame,
    queries: DataFrame,
    ids: tuple[str, ...] = ("conv_id", "turn"),
    text: str = "text",
    k: int = 10,
    shard_rows: int = 20_000,
) -> DataFrame:
    """(q_<id>..., rank, <id>..., score): the k best rows for each query, over whole texts.

    Words are as in ``classlm.words_of``; a word of the query counts as often as it
    stands there. Scores are BM25 (k1 1.2, b 0.75, idf ln(1 + (N - n + 0.5) / (n + 0.5)))
    rounded to six digits; equal scores rank by ids, smaller first. Only rows with a
    word of the query are found, among them the query's own row. Null and empty texts
    find nothing and are not found, but count as rows of length 0. Of queries with
    equal ids one is asked, the text that sorts first; repeated rows are found as often
    as they stand there. Other columns are left out. Ids are integers and not null;
    rows with a null id are left out, as are such queries.
    """
    whole = [F.col(c).isNotNull() for c in ids]
    named = [F.col(c).cast("long").alias(f"i{n}") for n, c in enumerate(ids)]
    places = [f"i{n}" for n in range(len(ids))]

    def plain(rows: DataFrame) -> DataFrame:
        kept = rows
        for condition in whole:
            kept = kept.filter(condition)
        return kept.select(*named, F.coalesce(F.col(text), F.lit("")).alias("text"))

    rows = plain(df)
    counts = stash(_term_counts(rows), "search-terms")
    total = counts.filter("word IS NULL").first()
    size = total["n"] if total else 0
    mean = total["words"] / size if size else 0.0
    shards = max(1, math.ceil(size / shard_rows))

    asked = plain(queries).groupBy(*places).agg(F.min("text").alias("text")).withColumn("query", F.struct(*places))
    idf = F.log1p((size - F.col("n") + 0.5) / (F.col("n") + 0.5))
    known = counts.filter("word IS NOT NULL").select("word", idf.alias("idf"))
    terms = _query_terms(asked).join(known, "word")
    terms = terms.groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("word", (F.col("times") * F.col("idf")).alias("weight")))).alias("terms")
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    no_terms = F.lit(None).cast("array<struct<word:binary,weight:double>>")
    left = rows.select(
        F.pmod(F.xxhash64(*places), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("turn"), *places, "text",
        no_terms.alias("words"),
    )
    right = stash(terms, "search-queries").select(
        every.alias("shard"), F.lit(1).alias("turn"), *[F.col(f"query.{p}").alias(p) for p in places],
        F.lit(None).cast("string").alias("text"), F.col("terms").alias("words"),
    )
    mixed = left.unionByName(right).repartition(shards, "shard").sortWithinPartitions("shard", "turn", *places)
    width = len(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[str] = []
        keys: list[np.ndarray] = []
        index, shard = None, None
        for batch in batches:
            own_shards = batch.column(0).to_numpy()
            asking = batch.column(1).to_numpy()
            numbers = np.stack([batch.column(2 + i).to_numpy() for i in range(width)], axis=1)
            cuts = np.flatnonzero((np.diff(own_shards) != 0) | (np.diff(asking) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if own_shards[a] != shard:
                    texts, keys, index, shard = [], [], None, own_shards[a]
                if not asking[a]:
                    texts += batch.column(2 + width)[a:b].to_pylist()
                    keys.append(numbers[a:b])
                    continue
                if index is None:
                    index, places_of = ShardIndex(texts, mean), np.concatenate(keys) if keys else numbers[:0]
                    texts, keys = [], []
                for c in range(a, b, QUERIES):
                    out_query, out_rows, out_scores = [], [], []
                    terms = [[(w["word"], w["weight"]) for w in q] for q in batch.column(3 + width)[c : min(c + QUERIES, b)].to_pylist()]
                    for i, (found, scores) in enumerate(index.search(terms, k), c):
                        best = np.lexsort((*places_of[found].T[::-1], -scores))[:k]
                        out_query += [i] * len(best)
                        out_rows.append(found[best])
                        out_scores.append(scores[best])
                    if not out_query:
                        continue
                    left_ids, right_ids = numbers[out_query], places_of[np.concatenate(out_rows)]
                    arrays = [pa.array(x) for x in (*left_ids.T.copy(), *right_ids.T.copy(), np.concatenate(out_scores))]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    names = [*[f"q{i}" for i in range(width)], *places, "score"]
    schema = ", ".join([*[f"{n} long" for n in names[:-1]], "score double"])
    lists = mixed.mapInArrow(run, schema)
    order = Window.partitionBy(*names[:width]).orderBy(F.desc("score"), *places)  # k rows a shard and query
    ranked = lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(
        *[F.col(f"q{i}").alias(f"q_{c}") for i, c in enumerate(ids)],
        "rank",
        *[F.col(f"i{i}").alias(c) for i, c in enumerate(ids)],
        "score",
    )


def conversation_search_sql(k: int = 10) -> str:
    """The same over ``conversations``, asked by all rows whose conversation is divisible by 20."""
    return f"""
WITH words AS (
  SELECT conv_id, turn, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+')) AS word FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
tf AS (SELECT conv_id, turn, word, count(*) AS n FROM words GROUP BY ALL),
len AS (SELECT conv_id, turn, sum(n) AS length FROM tf GROUP BY ALL),
total AS (SELECT (SELECT count(*) FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL) AS size, sum(n) AS words FROM tf),
idf AS (SELECT word, ln(1 + (any_value(size) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, total GROUP BY word),
scored AS (
  SELECT q.conv_id AS q_conv_id, q.turn AS q_turn, d.conv_id, d.turn,
    round(sum(q.n * idf * d.n * {K1 + 1} / (d.n + {K1} * ({1 - B} + {B} * length / (words / size)))), {DIGITS}) AS score
  FROM tf q JOIN idf USING (word) JOIN tf d ON d.word = q.word JOIN len l ON l.conv_id = d.conv_id AND l.turn = d.turn, total
  WHERE q.conv_id % 20 = 0 GROUP BY ALL)
SELECT q_conv_id, q_turn, rank, conv_id, turn, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q_conv_id, q_turn ORDER BY score DESC, conv_id, turn) AS rank FROM scored)
WHERE rank <= {k}"""

