import math
from collections import Counter

import duckdb
import pandas as pd
import pytest

from rankloom.llm import urls

SCHEMA = "page_id long, url string, html string, id string, text string, gram string, ratio string"
ODD = [None, "", "no-scheme/path", "://", "http://", "HTTP://Example.NET", "http://example.net/en/", "http://EXAMPLE.net/", "http://a.net?x/",
       "http://xnet/", "http://a.org/fr/x#y", "http://a.org/FR/", "http://x.y://z/p", "http://é.de/ü?q", "http://" + "a" * 5000 + ".com/", "http://n.net#f"]


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "h", "a", "b", "c", "d") for i, u in rows], SCHEMA)


def some_rows():
    draw = [f"http://{'www.' * (i % 3 == 0)}{'casino' if i % 4 == 0 else 'garden'}{i % 9}.example.{('net', 'org', 'com')[i % 3]}/{('en', 'de', 'fr')[i % 5 % 3]}/{i}" for i in range(120)]
    return [*enumerate(draw), *[(200 + i, u) for i, u in enumerate(ODD)], (5, draw[5]), (None, draw[7])]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule_of(host, path):
    fits = []
    for action, rule in urls.RULES:
        place, slash, rest = rule.partition("/")
        if (host == place or host.endswith("." + place)) and path.startswith(slash + rest):
            fits.append((len(rule), rule, action))
    return max(fits)[1:] if fits else (None, None)


def test_host_path_and_rules(spark):
    rows = some_rows()
    out = urls.judge(pages(spark, rows)).collect()
    got = sorted((str(r["page_id"]), r["host"], r["path"], str(r["rule"])) for r in out)
    assert got == sorted((str(i), *parts(u), str(rule_of(*parts(u))[0])) for i, u in rows)
    for r in out:
        action = rule_of(r["host"], r["path"])[1]
        assert r["verdict"] == action if action else r["verdict"] in ("allow", "block")


def test_verdicts_equal_the_sql(spark):
    rows = some_rows()
    con = duckdb.connect()
    con.register("frame", pd.DataFrame(rows, columns=["page_id", "url"]).astype({"page_id": "Int64"}))
    con.execute("CREATE VIEW pages AS SELECT * FROM frame")
    want = con.execute(urls.judge_sql()).df()
    got = urls.judge(pages(spark, rows)).drop("ratio").toPandas()

    def plain(frame):
        return sorted(tuple("" if pd.isna(v) else str(v).removesuffix(".0") for v in row) for row in frame[sorted(frame.columns)].values)

    assert plain(got) == plain(want)


def test_ratios_by_brute_force(spark):
    """Witten-Bell by its recursion over whole strings, against the joined tables."""
    learn = {"ab": (2, 0), "abc": (1, 1), "bb": (0, 3)}
    order = 2
    counts = Counter()
    for text, (a, r) in learn.items():
        padded = "\x02" * order + text + "\x03"
        for i in range(len(text) + 1):
            gram = padded[i : i + order + 1]
            counts[gram, "a"] += a
            counts[gram, "r"] += r
    grams = sorted({g for g, _ in counts} | {"zab", "aba"})
    alphabet = len({g[-1] for g in grams})

    def p(gram, c):
        if not gram:
            return 1 / (alphabet + 1)
        context = gram[:-1]
        follow = Counter()
        for (g, own), n in counts.items():
            if own == c and g.endswith(context + g[-1]):
                follow[g[-1]] += n
        total, kinds = sum(follow.values()), sum(n > 0 for n in follow.values())
        lower = p(gram[1:], c)
        return (follow[gram[-1]] + kinds * lower) / (total + kinds) if total else lower

    table = spark.createDataFrame([(g, counts[g, "a"], counts[g, "r"]) for g in grams], "gram string, n_a long, n_r long")
    for r in urls._log_ratios(table, order).collect():
        # a symbol's order-0 count needs only the symbol, so the context of one symbol is empty
        assert r["ratio"] == pytest.approx(math.log(p(r["gram"], "a")) - math.log(p(r["gram"], "r")), abs=1e-9)


def test_empty_table(spark):
    assert urls.judge(pages(spark, [])).count() == 0


def test_plan_has_no_python(spark):
    plan = urls.judge(pages(spark, some_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
