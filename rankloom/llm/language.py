"""Language proportions of documents by expectation-maximisation over letter n-grams.

Every language is a distribution over hashed trigrams of letters, learned from all
labelled rows. A document is a mixture of languages: its proportions are estimated
by EM, and the set of languages in it is the one of the nested candidate sets
(the largest first language, the two largest, ...) whose likelihood, less a penalty
for each language, is highest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import text_slices, tidy_task

UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def trigrams(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every trigram that holds a letter; all else between letters counts as one space."""
    points = np.frombuffer("\n".join([*texts, ""]).lower().encode("utf-32-le"), "<u4")
    # lower() can lengthen a text, so the texts are told apart in its result
    ends = np.cumsum(np.fromiter((len(t.lower()) + 1 for t in texts), np.int64, len(texts)))
    if len(points) != (ends[-1] if len(texts) else 0):  # a letter whose lower case depends on its neighbours
        parts = [t.lower() for t in texts]
        points = np.frombuffer("\n".join([*parts, ""]).encode("utf-32-le"), "<u4")
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of other characters stays, as a space
    last = ends - 1
    keep[last] = True
    symbol = np.where(letter, points, 32).astype(np.uint64)[keep]
    owner = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))[keep]
    whole = np.zeros(len(points), bool)
    whole[last] = True
    letter, end = letter[keep], whole[keep]
    before, after = np.roll(symbol, 1), np.roll(symbol, -1)
    if len(owner):
        starts = np.concatenate([[True], owner[1:] != owner[:-1]])
        before[starts] = 32
        after[end] = 32
    mixed = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (symbol * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (
        after * np.uint64(0x165667B19E3779F9)
    )
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    bucket = (mixed >> np.uint64(40)).astype(np.int64) % buckets
    around = letter.copy()  # trigrams whose middle is a letter
    return owner[around], bucket[around]


@dataclass
class LanguageModel:
    """Log probabilities (language, bucket), smoothed; small enough to be sent to every task."""

    languages: list[str]
    probabilities: np.ndarray
    buckets: int


def train(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    buckets: int = 16_384,
    smoothing: float = 0.5,
    most_languages: int = 500,
) -> LanguageModel:
    """Trigram distributions from all rows with a text and a language.

    Counts are summed in each task first; at most ``most_languages * buckets``
    sums reach the driver, and more languages are an error. Rows with a null text
    or language, and texts without a letter, teach nothing.
    """

    @tidy_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for a, b, texts in text_slices(batch.column(0)):
                owner, bucket = trigrams(texts, buckets)
                names = {name: i for i, name in enumerate(sorted(set(langs[a:b])))}
                number = np.array([names[x] for x in langs[a:b]])
                counts = np.bincount(number[owner] * buckets + bucket, minlength=len(names) * buckets)
                for name, i in names.items():
                    sums[name] = sums.get(name, 0) + counts[i * buckets : (i + 1) * buckets]
                if len(sums) > most_languages:
                    raise ValueError(f"more than {most_languages} languages")
        for name, counts in sums.items():
            full = np.flatnonzero(counts)
            columns = [pa.array([name] * len(full), pa.string()), pa.array(full), pa.array(counts[full])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    rows = df.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    )
    counted = rows.mapInArrow(run, "lang string, bucket long, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    counts = np.zeros((len(languages), buckets))
    place = {name: i for i, name in enumerate(languages)}
    counts[found["lang"].map(place).to_numpy(int), found["bucket"].to_numpy(int)] = found["n"].to_numpy(float)
    smooth = counts + smoothing
    return LanguageModel(languages, (smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32), buckets)


def _proportions(
    likelihood: np.ndarray, weight: np.ndarray, first: np.ndarray, owner: np.ndarray, allowed: np.ndarray, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """EM for all documents at once: (proportions, log likelihoods).

    Rows of ``likelihood`` are the different trigrams of a document, ``first`` the
    places where documents begin; only ``allowed`` languages of a document take part.
    """
    share = allowed / allowed.sum(axis=1, keepdims=True)
    total = np.add.reduceat(weight, first)
    for _ in range(rounds):
        mixed = likelihood * share[owner]
        mixed *= (weight / mixed.sum(axis=1))[:, None]
        share = np.add.reduceat(mixed, first, axis=0) / total[:, None]
    mixed = np.einsum("ij,ij->i", likelihood, share[owner])
    return share, np.add.reduceat(weight * np.log(mixed), first)


def mixtures(texts: list[str], model: LanguageModel, rounds: int, penalty: float) -> np.ndarray:
    """Proportions (text, language) in the chosen language set; rows without letters are zero.

    Sets grow by the languages of the largest shares. They end where the penalty of one
    more language is above all that the likelihood of the set of all languages leaves to gain.
    """
    count = len(model.languages)
    out = np.zeros((len(texts), count))
    owner, bucket = trigrams(texts, model.buckets)
    if not len(owner) or not count:
        return out
    key, weight = np.unique(owner * model.buckets + bucket, return_counts=True)
    owner, bucket = key // model.buckets, key % model.buckets
    present, first = np.unique(owner, return_index=True)
    owner = np.searchsorted(present, owner)
    likelihood = model.probabilities[:, bucket].T.astype(np.float64)
    weight = weight.astype(np.float64)
    everything = np.ones((len(present), count))
    share, most = _proportions(likelihood, weight, first, owner, everything, rounds)
    order = np.argsort(-share, axis=1, kind="stable")  # equal shares: the smaller name first
    cost = penalty * np.log(np.maximum(np.add.reduceat(weight, first), 2.0))
    best = np.full(len(present), -np.inf)
    chosen = np.zeros_like(share)
    allowed = np.zeros_like(share)
    for size in range(1, count + 1):
        if size > 1 and (most - size * cost < best).all():
            break
        np.put_along_axis(allowed, order[:, size - 1 : size], 1.0, axis=1)
        fitted, value = _proportions(likelihood, weight, first, owner, allowed, 1 if size == 1 else rounds)
        most = np.maximum(most, value)
        value = value - size * cost
        better = value > best
        chosen[better], best[better] = fitted[better], value[better]
    out[present] = chosen
    return out


def predict(
    df: DataFrame,
    model: LanguageModel,
    id: str = "doc_id",
    text: str = "text",
    keep: tuple[Column, ...] = (),
    keep_text: bool = False,
    rounds: int = 12,
    penalty: float = 1.0,
) -> DataFrame:
    """(id, text if wanted, *keep, lang_pred, score, languages, shares) of every whole text, one row for each row.

    ``lang_pred`` has the largest share of the chosen set, the smaller name of equal
    ones; ``score`` is that share. Null texts, texts without a letter, and a model
    without languages give ``und`` with score 0 and an empty set. The penalty alone
    bounds a text's set of languages. Null ids and repeated rows stay; columns not named in ``keep`` are left out.
    """
    held = df.sparkSession.sparkContext.broadcast(model)
    kept = df.select(F.col(id).alias("id"), F.col(text).alias("text"), *keep)
    others = ["text"] * keep_text + kept.columns[2:]
    places = [1] * keep_text + list(range(2, len(kept.columns)))  # of the columns that pass through

    @tidy_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = held.value.languages
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                shares = mixtures([t or "" for t in texts], held.value, rounds, penalty)
                if not names:
                    shares = np.zeros((b - a, 1))
                top = shares.argmax(axis=1)
                score = shares.max(axis=1)
                best = [names[i] if s > 0 else UNKNOWN for i, s in zip(top.tolist(), score.tolist())]
                sets = [sorted(np.flatnonzero(row).tolist(), key=lambda j, r=row: -r[j]) for row in shares]
                columns = [
                    batch.column(0)[a:b],
                    *[batch.column(i)[a:b] for i in places],
                    pa.array(best, pa.string()),
                    pa.array(np.clip(score, 0.0, 1.0)),
                    pa.array([[names[j] for j in s] for s in sets], pa.list_(pa.string())),
                    pa.array([[float(row[j]) for j in s] for s, row in zip(sets, shares)], pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", *others, "lang_pred", "score", "languages", "shares"])

    fields = [f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in ["id", *others]]
    schema = ", ".join([*fields, "lang_pred string", "score double", "languages array<string>", "shares array<double>"])
    return kept.mapInArrow(run, schema).withColumnRenamed("id", id)
