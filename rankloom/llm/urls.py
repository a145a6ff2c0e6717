"""URL verdicts by rules and, where no rule fits, by two character language models.

The models are Markov models of variable order: the probability of a character after
its context mixes all shorter contexts, each weighted by the different characters
that followed it (Witten-Bell smoothing). One learns from URLs that rules allow, one
from those that rules block. The difference of the two log likelihoods, divided by
the length, is compared with a threshold set on ruled URLs that the models have not
seen. Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import broadcast_if_small
from rankloom.session import stash

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_START, _END = "\x02", "\x03"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits, the earlier of equal length; else nulls.

    The rules are a stated short list; they become one conditional expression.
    """
    if len(rules) > 500:
        raise ValueError("more than 500 rules: join them instead")
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        place, slash, rest = text.partition("/")
        fits = ((host == place) | host.endswith("." + place)) & path.startswith(slash + rest)
        rule, action = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(action)
    return rule, action


def _grams(text: Column, order: int) -> Column:
    """Every character of a text and its end mark, with the ``order`` characters before it."""
    padded = F.concat(F.lit(_START * order), text, F.lit(_END))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, F.lit(order + 1)))


def _log_ratios(counts: DataFrame, order: int) -> DataFrame:
    """(gram, ratio): log probability of the last character, accepted less rejected.

    ``counts`` has (gram, n_a, n_r) for every gram that is needed, with zeros where
    a class lacks it. Shorter contexts are sums of longer ones.
    """
    levels = [counts]
    for size in range(order, 0, -1):
        shorter = counts.select(F.expr(f"right(gram, {size})").alias("gram"), "n_a", "n_r")
        levels.append(shorter.groupBy("gram").agg(F.sum("n_a").alias("n_a"), F.sum("n_r").alias("n_r")))
    levels.reverse()
    # below all contexts every character known to either class, and one unknown, are equally likely
    base = levels[0].agg((1.0 / (F.count(F.lit(1)) + 1)).alias("p_a")).withColumn("p_r", F.col("p_a"))
    known = base.withColumn("rest", F.lit(""))
    for size, level in enumerate(levels):
        context = F.substring("gram", 1, size)
        follow = level.groupBy(context.alias("context")).agg(
            F.sum("n_a").alias("all_a"),
            F.sum("n_r").alias("all_r"),
            F.count(F.when(F.col("n_a") > 0, 1)).alias("kinds_a"),
            F.count(F.when(F.col("n_r") > 0, 1)).alias("kinds_r"),
        )

        def mixed(c: str) -> Column:
            seen = F.col(f"all_{c}") + F.col(f"kinds_{c}")
            value = (F.col(f"n_{c}") + F.col(f"kinds_{c}") * F.col(f"p_{c}")) / seen
            return F.when(seen > 0, value).otherwise(F.col(f"p_{c}")).alias(f"p_{c}")

        rows = level.select("gram", "n_a", "n_r", context.alias("context"), F.expr(f"right(gram, {size})").alias("rest"))
        known = rows.join(follow, "context").join(known, "rest").select(F.col("gram").alias("rest"), mixed("a"), mixed("r"))
    return known.select(F.col("rest").alias("gram"), (F.ln("p_a") - F.ln("p_r")).alias("ratio"))


def judge(
    df: DataFrame,
    id: str = "page_id",
    url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    order: int = 4,
) -> DataFrame:
    """(id, host, path, rule, verdict, ratio), one row for each row.

    ``ratio`` is the length-normalised log-likelihood difference, null where a rule
    decides. The models learn from the different ruled host-path texts; of those, the
    ones whose md5 begins with 0, 1 or 2 set the threshold: the point at which both
    classes have the same share of errors if their ratios are normal, and 0 while a
    class has no such URLs. A ratio of at least the threshold allows. A null or empty
    URL is the empty text. Null ids and repeated rows stay; other columns are left out.
    """
    host, path = host_and_path(F.col(url))
    parsed = df.select(F.col(id).alias("id"), host.alias("host"), path.alias("path"))
    rule, action = fitting_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("*", rule.alias("rule"), action.alias("action"), F.concat("host", "path").alias("text"))
    # a text has one host and path unless they join differently, so the rule's action is part of the key
    texts = ruled.groupBy("text", "action").count()
    aside = F.substring(F.md5(F.encode("text", "UTF-8")), 1, 1).isin("0", "1", "2")
    texts = stash(texts.select("text", "action", (F.col("action").isNotNull() & ~aside).alias("learn")), "url-texts")

    grams = texts.select("text", "action", "learn", F.explode(_grams(F.col("text"), order)).alias("gram"))
    one = F.col("learn").cast("long")
    counts = grams.groupBy("gram").agg(
        F.sum(F.when(F.col("action") == "allow", one).otherwise(0)).alias("n_a"),
        F.sum(F.when(F.col("action") == "block", one).otherwise(0)).alias("n_r"),
    )
    ratios = stash(_log_ratios(stash(counts, "url-grams"), order), "url-ratios")
    needed = grams.filter("not learn").groupBy("text", "action", "gram").count()
    total = needed.join(broadcast_if_small(ratios, 500_000), "gram").groupBy("text", "action").agg(
        (F.sum(F.round(F.col("count") * F.col("ratio"), 9)) / F.sum("count")).alias("ratio")
    )
    scored = stash(total, "url-scores")

    held = scored.filter("action is not null")

    def part(name: str, value: str) -> Column:
        only = F.when(F.col("action") == value, F.col("ratio"))
        return F.struct(F.avg(only).alias("mean"), F.coalesce(F.stddev_pop(only), F.lit(0.0)).alias("sd")).alias(name)

    middle = held.agg(part("a", "allow"), part("r", "block"))
    spread = F.col("a.sd") + F.col("r.sd")
    crossing = F.when(spread > 0, (F.col("a.mean") * F.col("r.sd") + F.col("r.mean") * F.col("a.sd")) / spread)
    threshold = middle.select(
        F.coalesce(crossing, (F.col("a.mean") + F.col("r.mean")) / 2, F.lit(0.0)).alias("threshold")
    ).first()["threshold"]

    free = scored.filter("action is null")
    open_text = F.when(F.col("action").isNull(), F.col("text"))
    judged = ruled.withColumn("open", open_text).join(
        free.select(F.col("text").alias("open"), "ratio"), "open", "left"
    )
    own = F.when(F.col("ratio") >= threshold, "allow").otherwise("block")
    return judged.select(
        F.col("id").alias(id), "host", "path", "rule", F.coalesce("action", own).alias("verdict"), "ratio"
    )


def judge_sql(rules: Sequence[tuple[str, str]] = RULES, order: int = 4) -> str:
    """The same in SQL over ``pages``."""
    cases = {"rule": "NULL", "action": "NULL"}
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        place, slash, rest = text.partition("/")
        fits = f"(host = '{place}' OR ends_with(host, '.{place}')) AND starts_with(path, '{slash + rest}')"
        cases["rule"] = f"CASE WHEN {fits} THEN '{text}' ELSE {cases['rule']} END"
        cases["action"] = f"CASE WHEN {fits} THEN '{verdict}' ELSE {cases['action']} END"
    ctes = [
        "rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages)",
        f"cut AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, "
        "regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest)",
        f"ruled AS (SELECT *, {cases['rule']} AS rule, {cases['action']} AS action, host || path AS text FROM cut)",
        "texts AS (SELECT DISTINCT text, action, action IS NOT NULL AND substr(md5(text), 1, 1) NOT IN ('0', '1', '2') AS learn FROM ruled)",
        f"grams AS (SELECT text, action, learn, substr(repeat(chr(2), {order}) || text || chr(3), i, {order + 1}) AS gram "
        "FROM texts, unnest(range(1, length(text) + 2)) AS u(i))",
        f"l{order} AS (SELECT gram, sum((learn AND action = 'allow')::INT) AS n_a, sum((learn AND action = 'block')::INT) AS n_r FROM "
        "(SELECT gram, learn, coalesce(action, '') AS action FROM grams) GROUP BY gram)",
    ]
    for size in range(order, 0, -1):
        ctes.append(
            f"l{size - 1} AS (SELECT right(gram, {size}) AS gram, sum(n_a) AS n_a, sum(n_r) AS n_r FROM l{order} GROUP BY 1)"
        )
    ctes.append("p AS (SELECT '' AS gram, 1.0::DOUBLE / (count(*) + 1) AS p_a, 1.0::DOUBLE / (count(*) + 1) AS p_r FROM l0)")
    known = "p"
    for size in range(order + 1):
        mixed = ", ".join(
            f"CASE WHEN all_{c} + kinds_{c} > 0 THEN (n_{c} + kinds_{c} * k.p_{c}) / (all_{c} + kinds_{c})::DOUBLE ELSE k.p_{c} END AS p_{c}"
            for c in "ar"
        )
        ctes.append(
            f"f{size} AS (SELECT substr(gram, 1, {size}) AS context, sum(n_a) AS all_a, sum(n_r) AS all_r, "
            f"count(*) FILTER (n_a > 0) AS kinds_a, count(*) FILTER (n_r > 0) AS kinds_r FROM l{size} GROUP BY 1)"
        )
        ctes.append(
            f"p{size} AS (SELECT l.gram, {mixed} FROM l{size} l JOIN f{size} f ON f.context = substr(l.gram, 1, {size}) "
            f"JOIN {known} k ON k.gram = right(l.gram, {size}))"
        )
        known = f"p{size}"
    ctes += [
        "needed AS (SELECT text, action, gram, count(*) AS n FROM grams WHERE NOT learn GROUP BY 1, 2, 3)",
        f"scored AS (SELECT text, action, sum(round(n * (ln(p_a) - ln(p_r)), 9)) / sum(n) AS ratio FROM needed JOIN {known} USING (gram) GROUP BY 1, 2)",
        "middle AS (SELECT avg(ratio) FILTER (action = 'allow') AS ma, coalesce(stddev_pop(ratio) FILTER (action = 'allow'), 0) AS sa, "
        "avg(ratio) FILTER (action = 'block') AS mr, coalesce(stddev_pop(ratio) FILTER (action = 'block'), 0) AS sr FROM scored)",
        "line AS (SELECT coalesce(CASE WHEN sa + sr > 0 THEN (ma * sr + mr * sa) / (sa + sr) END, (ma + mr) / 2, 0) AS threshold FROM middle)",
    ]
    return (
        "WITH " + ",\n".join(ctes) + "\nSELECT page_id, host, path, rule, "
        "coalesce(r.action, CASE WHEN ratio >= threshold THEN 'allow' ELSE 'block' END) AS verdict FROM ruled r "
        "LEFT JOIN (SELECT text, ratio FROM scored WHERE action IS NULL) s ON r.action IS NULL AND s.text = r.text, line"
    )

