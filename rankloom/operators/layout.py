"""Row numbers, top-k and splits that never need one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.order import hash_key
from rankloom.session import durable

SEAT_BITS = 33  # Fixed value: monotonically_increasing_id keeps the row in the low 33 bits.


def number_rows(
    df: DataFrame, order: Sequence[Column], group: Sequence[str] = (), name: str = "pos"
) -> DataFrame:
    """Positions from 1 in ``order``, over the table or inside each group.

    One range sort spreads even a single huge group over many tasks. The
    position is the seat in the sorted partition plus the rows of the group in
    earlier partitions. The sorted rows are checkpointed, so the second read
    sees the same partitions after executors are lost. ``order`` must be total.
    """
    ranked = df.orderBy(*[F.col(g).asc() for g in group], *order)
    ranked = durable(ranked.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", SEAT_BITS).alias("_part")
    seat = F.col("_at").bitwiseAND(F.lit((1 << SEAT_BITS) - 1))
    runs = ranked.groupBy(part, *group).agg(F.min(seat).alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = (
        Window.partitionBy(*(group or [F.lit(0)]))
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    starts = runs.select("_part", *group, (before - F.col("_first") + 1).alias("_shift"))
    if not group:
        starts = F.broadcast(starts)  # one row per partition of the sort
    rows = ranked.select("*", part, seat.alias("_seat")).join(starts, ["_part", *group])
    return rows.select(*df.columns, (F.col("_seat") + F.col("_shift")).alias(name))


def top_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    spread: Sequence[str],
    name: str = "rank",
    salts: int = 16,
) -> DataFrame:
    """First ``k`` rows of every group with their rank from 1.

    Candidates are cut to ``k`` inside ``salts`` parts of the group first, so a
    group that holds most of the table is ranked by many tasks and the last
    step sees at most ``salts * k`` rows of it.
    """
    parts = df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    local = Window.partitionBy(*group, "_salt").orderBy(*order)
    best = parts.withColumn("_local", F.row_number().over(local)).filter(F.col("_local") <= k)
    whole = Window.partitionBy(*(group or [F.lit(0)])).orderBy(*order)
    ranked = best.withColumn(name, F.row_number().over(whole)).filter(F.col(name) <= k)
    return ranked.drop("_salt", "_local")


def holdout_sample(
    df: DataFrame, key: str, fraction: float = 0.3, seed: int = 0, exclusive: bool = False
) -> DataFrame:
    """Mark the first ``round(fraction * n)`` rows of a hash shuffle in ``in_eval``.

    ``in_train`` stays true for the marked rows unless ``exclusive`` is set.
    """
    placed = number_rows(df, [hash_key(seed, key), F.col(key)], name="_pos")
    size = round(df.count() * fraction)
    chosen = F.col("_pos") <= size
    in_train = ~chosen if exclusive else F.lit(True)
    return placed.withColumn("in_eval", chosen).withColumn("in_train", in_train).drop("_pos")


def hash_split(df: DataFrame, key: str, fraction: float = 0.2, seed: int = 0) -> DataFrame:
    """Column ``split``: ``valid`` for about ``fraction`` of the keys, else ``train``."""
    bucket = F.conv(F.substring(hash_key(seed, key), 1, 6), 16, 10).cast("long")
    valid = bucket < F.lit(int(fraction * 16**6))
    return df.withColumn("split", F.when(valid, "valid").otherwise("train"))


def minibatches(
    rows: DataFrame, key: str, batch_size: int, seed: int | str = 0, repeat_tail: bool = True
) -> DataFrame:
    """Hash-shuffled batches as ``(key, batch)``; a short last batch comes twice.

    When ``batch_size`` divides the number of rows there is one more, empty
    batch, which has no rows here; see :func:`batch_count`.
    """
    placed = number_rows(rows.select(key), [hash_key(seed, key), F.col(key)], name="_pos")
    n = rows.count()
    batch = F.floor((F.col("_pos") - 1) / batch_size).cast("int")
    tail = n // batch_size
    out = placed.select(key, batch.alias("batch"))
    if repeat_tail and n % batch_size:
        copies = F.when(F.col("batch") == tail, F.array(F.lit(tail), F.lit(tail + 1)))
        out = out.select(key, F.explode(copies.otherwise(F.array("batch"))).alias("batch"))
    return out


def batch_count(rows: int, batch_size: int, repeat_tail: bool = True) -> int:
    """Number of batches per epoch, with the repeated or empty one."""
    if not repeat_tail:
        return -(-rows // batch_size)
    return rows // batch_size + (2 if rows % batch_size else 1)


def length_batches(df: DataFrame, key: str, length: Column, batch_size: int = 64) -> DataFrame:
    """Batches of rows of similar length: sorted by length, cut every ``batch_size``."""
    rows = df.select(key, length.cast("int").alias("length"))
    placed = number_rows(rows, [F.col("length"), F.col(key)], name="_pos")
    batch = F.floor((F.col("_pos") - 1) / batch_size).cast("long")
    return placed.select(key, "length", batch.alias("batch"))
