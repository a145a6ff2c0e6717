"""Benchmark passages inside documents, by fingerprints of item-sized windows.

A window of a document has as many words as a benchmark item. Windows of every start
that hold a shingle of an item of their length, in whatever place, are looked at; those
whose known shingles weigh too little for the similarity with any such item are left
out before fingerprinting, which loses none.
Fingerprints are SimHashes over weighted shingles. They are indexed by blocks of bits:
two fingerprints within the radius differ in at most ``radius // blocks`` bits in some
block, so entries for all block values that near find every pair. The candidates are
verified by the exact weighted similarity. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import broadcast_if_small
from rankloom.session import stash

WORDS = 5
BITS = 64
BLOCKS = 8
RADIUS = 19  # similarity 0.8 makes about 10 different bits of 64; 20 or more have a probability below 0.001


def _words(text: Column) -> Column:
    """Lower-cased runs of anything but ASCII white space."""
    cut = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.filter(cut, lambda w: w != "")


def _shingles(words: Column, size: int) -> Column:
    """Hash of the ``size`` words from each place on, as far as there are so many."""
    places = F.sequence(F.lit(1), F.size(words) - (size - 1))
    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, F.lit(size))))
    return F.when(F.size(words) >= size, hashes).otherwise(F.array().cast("array<bigint>"))


def _fingerprint(weighted: Column) -> Column:
    """SimHash of (shingle, weight): a bit is set if the weights of shingles with it are not outweighed."""
    zero = F.array_repeat(F.lit(0.0), BITS)

    def add(sums: Column, one: Column) -> Column:
        return F.transform(
            sums,
            lambda s, b: s + one["weight"] * (2 * F.getbit(one["shingle"], b) - 1),
        )

    sums = F.aggregate(weighted, zero, add)
    bits = F.transform(sums, lambda s, b: F.when(s >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(0))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def _block(fingerprint: Column, number: Column) -> Column:
    """The bits of one block, as a number."""
    width = BITS // BLOCKS
    shifted = F.call_function("shiftright", fingerprint, (number * width).cast("int"))
    return shifted.bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _weighted(rows: DataFrame, keys: list[str], weights: DataFrame) -> DataFrame:
    """Rows (keys, shingles) with their different shingles weighted (null: in no item), summed and fingerprinted.

    In the fingerprint a shingle of no item weighs what the row's others do in the mean.
    """
    single = rows.select(*keys, F.explode(F.array_distinct("shingles")).alias("shingle"))
    known = single.join(weights, "shingle", "left")
    # a window holds as many shingles as its item at most
    lists = known.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("shingle", "weight"))).alias("weighted"),
        F.coalesce(F.sum("weight"), F.lit(0.0)).alias("total"), F.coalesce(F.avg("weight"), F.lit(1.0)).alias("mean"),
        F.count(F.lit(1)).alias("n"), F.count("weight").alias("n_known"),
    )
    filled = F.transform("weighted", lambda x: F.struct(x["shingle"].alias("shingle"), F.coalesce(x["weight"], F.col("mean")).alias("weight")))
    return lists.select(*keys, "weighted", "total", "mean", (F.col("n") - F.col("n_known")).alias("strange"), _fingerprint(filled).alias("fingerprint"))


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    similarity: float = 0.8,
    radius: int = RADIUS,
    copy: str | None = None,
) -> DataFrame:
    """(id, item, start, words, similarity): the best window of each document for each item it leaks.

    Shingles have five words (all words of a shorter item) and weigh 1 over the number
    of different item texts that hold them; one that no item holds weighs as much as the
    item's own in the mean, so an edit costs a templated item no more than another one.
    The similarity of a window and an item is the weight of their common shingles over
    that of all of theirs. ``start`` counts
    words from 0; a document shorter than the item is one window. Of equally similar
    windows the first counts. Null and empty texts leak nothing, empty items are never
    found; null ids and ids repeated with other texts are told apart by the text, and
    repeated rows give one result. Other columns are left out, whatever their names.
    ``copy`` names a further column for the text's hash, ``xxhash64``.
    """
    items = benchmark.select(F.col(item).alias("item"), _words(F.col(item_text)).alias("w"))
    items = items.withColumn("length", F.size("w")).filter("length > 0").distinct()
    items = stash(items.withColumn("k", F.least("length", F.lit(WORDS))), "bench-items")
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())  # 1 to 5
    if not sizes:
        empty = df.select(F.col(id), F.lit(None).cast(items.schema["item"].dataType).alias(item)).limit(0)
        if copy:
            empty = empty.withColumn(copy, F.lit(0).cast("long"))
        return empty.select("*", *[F.lit(0).cast(t).alias(c) for c, t in (("start", "int"), ("words", "int"), ("similarity", "double"))])

    def shingled(rows: DataFrame, size: Column) -> DataFrame:
        every = F.coalesce(*[F.when(size == s, _shingles(F.col("w"), s)) for s in sizes])
        return rows.withColumn("shingles", every)

    made = stash(shingled(items, F.col("k")), "bench-shingles")
    anchors = made.select("length", "k", F.explode("shingles").alias("shingle")).distinct()
    weights = made.select("w", "shingles").distinct().select(F.explode(F.array_distinct("shingles")).alias("shingle"))
    weights = stash(weights.groupBy("shingle").agg((1.0 / F.count(F.lit(1))).alias("weight")), "bench-weights")
    weights = broadcast_if_small(weights, 2_000_000)
    # the least weight of a window's shingles among the items' that an item of its length needs
    needs = made.select("item", "length", F.explode(F.array_distinct("shingles")).alias("shingle")).join(weights, "shingle")
    needs = needs.groupBy("item", "length").agg(F.sum("weight").alias("total"))
    needs = needs.groupBy("length").agg((F.min("total") * similarity - 1e-6).alias("needed"))
    anchors = anchors.join(weights, "shingle").join(F.broadcast(needs), "length")
    anchors = broadcast_if_small(stash(anchors, "bench-anchors"), 2_000_000)

    # every place of every document against the items' shingles
    docs = df.select(F.col(id).alias("id"), F.xxhash64(text).alias("copy"), _words(F.col(text)).alias("w"))
    places = [
        docs.select("id", "copy", F.size("w").alias("n"), F.lit(s).alias("k"), F.posexplode(_shingles(F.col("w"), s)).alias("at", "shingle"))
        for s in sizes
    ]
    hits = places[0]
    for other in places[1:]:
        hits = hits.unionByName(other)
    # all starts whose window holds the shingle; a document shorter than the item is one window
    last = F.greatest(F.lit(0), F.col("n") - F.col("length"))
    first = F.least(F.greatest(F.lit(0), F.col("at") + F.col("k") - F.col("length")), last)
    met = hits.join(anchors, ["shingle", "k"])
    met = met.withColumn("start", F.explode(F.sequence(first, F.least(F.col("at"), last))))
    window = ["id", "copy", "length", "k", "start"]
    # a shingle counts once in a window, and so do repeated rows
    single = met.groupBy(*window, "shingle").agg(F.first("weight").alias("weight"), F.first("needed").alias("needed"))
    starts = single.groupBy(*window).agg(F.sum("weight").alias("known"), F.first("needed").alias("needed"))
    starts = stash(starts.filter(F.col("known") >= F.col("needed")).select(*window), "bench-starts")

    # the windows' shingles, from the documents that have any
    wanted = broadcast_if_small(stash(starts.select("id", "copy").distinct(), "bench-docs"), 2_000_000)
    same = F.col("d.id").eqNullSafe(F.col("x.id")) & (F.col("d.copy") == F.col("x.copy"))
    found = docs.alias("d").join(wanted.alias("x"), same, "left_semi").dropDuplicates(["id", "copy"])
    found = stash(found, "bench-texts")
    same = F.col("d.id").eqNullSafe(F.col("s.id")) & (F.col("d.copy") == F.col("s.copy"))
    windows = starts.alias("s").join(found.alias("d"), same).select(
        "s.id", "s.copy", "s.length", "s.k", "s.start", F.slice("w", F.col("s.start") + 1, F.col("s.length")).alias("w")
    )
    keys = ["id", "copy", "length", "start"]
    windows = stash(_weighted(shingled(windows, F.col("k")), keys, weights), "bench-windows")
    known = stash(_weighted(made, ["item", "length"], weights), "bench-prints")

    # entries for all values within the block's share of the radius
    number = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))
    width = BITS // BLOCKS
    near = F.filter(
        F.sequence(F.lit(0).cast("long"), F.lit((1 << width) - 1).cast("long")),
        lambda v: F.bit_count(v.bitwiseXOR(F.col("value"))) <= radius // BLOCKS,
    )
    prints = known.select("item", "length", "fingerprint", number.alias("block"))
    entries = prints.withColumn("value", _block(F.col("fingerprint"), F.col("block"))).withColumn("value", F.explode(near))
    entries = broadcast_if_small(stash(entries, "bench-entries"), 2_000_000)
    probes = windows.select(*keys, F.col("fingerprint").alias("own"), number.alias("block"))
    probes = probes.withColumn("value", _block(F.col("own"), F.col("block")))
    met = probes.join(entries, ["length", "block", "value"])
    met = met.filter(F.bit_count(F.col("own").bitwiseXOR(F.col("fingerprint"))) <= radius)
    candidates = met.select(*keys, "item").distinct()

    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"w.{k}")) for k in keys]
    items_side = broadcast_if_small(known, 50_000)
    pairs = candidates.alias("c").join(windows.alias("w"), same).join(
        items_side.alias("i"), (F.col("c.item") == F.col("i.item")) & (F.col("c.length") == F.col("i.length"))
    )
    theirs = F.transform("i.weighted", lambda x: x["shingle"])
    common = F.filter("w.weighted", lambda x: F.array_contains(theirs, x["shingle"]))
    shared = F.aggregate(common, F.lit(0.0), lambda s, x: s + x["weight"])
    strange = F.col("w.strange") * F.col("i.mean")
    value = F.round(shared / (F.col("w.total") + strange + F.col("i.total") - shared), 9)
    rated = pairs.select("c.id", "c.copy", "c.item", "c.start", F.col("c.length").alias("words"), value.alias("similarity"))
    rated = rated.filter(F.col("similarity") >= similarity)
    best = rated.groupBy("id", "copy", "item", "words").agg(F.max(F.struct("similarity", -F.col("start"))).alias("b"))
    return best.select(
        F.col("id").alias(id),
        F.col("item").alias(item),
        *([F.col("copy").alias(copy)] if copy else []),
        (-F.col("b.col2")).alias("start"),
        "words",
        F.col("b.similarity").alias("similarity"),
    )
