"""DuckDB SQL for link ranks and ranked lists; loops are recursive CTEs."""

from __future__ import annotations

from rankloom.plans.oracle.views import compose
from rankloom.plans.views import TOPICS

LINKS = {
    "outw": "SELECT src, sum(weight) AS w FROM edges GROUP BY src HAVING sum(weight) <> 0",
    "e": "SELECT src, dst, weight / w AS p FROM edges JOIN outw USING (src)",
    "d": "SELECT id FROM nodes WHERE id NOT IN (SELECT src FROM outw)",
    "n": "SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes",
}
START = {"start": "SELECT topic, doc, 1.0 / max(k) AS p FROM (SELECT *, count(*) OVER (PARTITION BY topic) AS k FROM doc_topics) t GROUP BY topic, doc"}

ROW_NORMALISE = compose(["edges"], {"outw": LINKS["outw"], "e": LINKS["e"]}, "SELECT src, dst, round(p, 9) AS p FROM e")
DANGLING = compose(["nodes", "edges"], {"outw": LINKS["outw"], "d": LINKS["d"]}, "SELECT id FROM d")
TELEPORT = compose(["doc_topics"], START, "SELECT topic, doc, round(p, 12) AS p FROM start")
TOPIC_GROUP = compose(
    ["doc_topics"], {},
    """SELECT DISTINCT d.topic, d.doc, s.docs FROM doc_topics d
       JOIN (SELECT topic, count(*) AS docs FROM doc_topics GROUP BY topic) s USING (topic)""",
)
SPMV = compose(
    ["edges", "doc_topics"],
    {"outw": LINKS["outw"], "e": LINKS["e"], **START, "x": "SELECT doc AS src, sum(p) AS x FROM start GROUP BY doc"},
    "SELECT dst AS id, round(sum(p * x), 12) AS y FROM e JOIN x USING (src) GROUP BY dst",
)


TOLERANCE = 1e-10  # The loops carry the norm of their last step and end when that is small enough.


def _global(dangling: str = "reference", name: str = "r", out: str = "ranks") -> dict[str, str]:
    gate = "CASE WHEN d.id IS NULL THEN 0 ELSE 1 END" if dangling == "reference" else "1"
    return {
        f"{name}(it, id, rank, gap)": f"""
          SELECT 0, id, CAST(1.0 AS DOUBLE), CAST(1.0 AS DOUBLE) FROM nodes
          UNION ALL
          SELECT it + 1, id, rank, sqrt(sum(power(rank - old, 2)) OVER ()) FROM (
            SELECT o.it, o.id, o.rank AS old,
                   0.8 * coalesce(f.s, 0) + 0.8 * coalesce(m.mass, 0) / n.n * {gate} + 0.2 / n.n AS rank
            FROM {name} o CROSS JOIN n
            CROSS JOIN (SELECT sum(rank) AS mass FROM {name} JOIN d USING (id)) m
            LEFT JOIN d ON d.id = o.id
            LEFT JOIN (SELECT dst, sum(p * rank) AS s FROM {name} JOIN e ON e.src = {name}.id GROUP BY dst) f ON f.dst = o.id
            WHERE o.gap > {TOLERANCE}) t""",
        out: f"SELECT id, rank / sum(rank) OVER () AS rank FROM {name} WHERE it = (SELECT max(it) FROM {name})",
    }


def global_result(dangling: str = "reference") -> str:
    if dangling not in ("reference", "uniform"):
        raise ValueError("unknown handling of dangling nodes")
    return compose(["nodes", "edges"], {**LINKS, **_global(dangling)}, "SELECT id, round(rank, 12) AS rank FROM ranks")


def distance() -> str:
    both = {**LINKS, **_global(), **_global("uniform", "ru", "uranks")}
    return compose(
        ["nodes", "edges"], both,
        "SELECT round(sqrt(sum(power(a.rank - b.rank, 2))), 12) AS l2 FROM ranks a JOIN uranks b USING (id)",
    )


def _topic() -> dict[str, str]:
    """Topics leave the loop one by one; the last state of each counts."""
    return {
        **LINKS,
        **START,
        "topics": "SELECT DISTINCT topic FROM doc_topics",
        "r(it, topic, id, rank, gap)": f"""
          SELECT 0, topic, id, 1.0 / n, CAST(1.0 AS DOUBLE) FROM topics, nodes, n
          UNION ALL
          SELECT it + 1, topic, id, rank, sqrt(sum(power(rank - old, 2)) OVER (PARTITION BY topic)) FROM (
            SELECT o.it, o.topic, o.id, o.rank AS old,
                   0.8 * coalesce(f.s, 0) + CASE WHEN d.id IS NULL THEN 0 ELSE 0.8 * m.mass / n.n END
                   + 0.1 * coalesce(s.p, 0) + (0.2 - 0.1) / n.n AS rank
            FROM r o CROSS JOIN n
            LEFT JOIN d ON d.id = o.id
            LEFT JOIN (SELECT topic, sum(rank) AS mass FROM r JOIN d USING (id) GROUP BY topic) m ON m.topic = o.topic
            LEFT JOIN start s ON s.topic = o.topic AND s.doc = o.id
            LEFT JOIN (SELECT topic, dst, sum(p * rank) AS s FROM r JOIN e ON e.src = r.id GROUP BY topic, dst) f
              ON f.topic = o.topic AND f.dst = o.id
            WHERE o.gap > {TOLERANCE}) t""",
        "tranks": """SELECT topic, id, rank / sum(rank) OVER (PARTITION BY topic) AS rank
          FROM (SELECT *, max(it) OVER (PARTITION BY topic) AS last FROM r) t WHERE it = last""",
    }


def topic_result() -> str:
    wide = ", ".join(f"round(max(CASE WHEN topic = {t} THEN rank END), 12) AS t{t}" for t in TOPICS)
    return compose(["nodes", "edges", "doc_topics"], _topic(), f"SELECT id, {wide} FROM tranks GROUP BY id")


def _mixture(mix: str) -> dict[str, str]:
    return {
        **_topic(),
        "ranks": f"""SELECT w.user_id, w.query_id, w.doc, coalesce(sum(t.rank * x.p), 0) AS rank
          FROM run w JOIN tranks t ON t.id = w.doc
          LEFT JOIN {mix} x ON x.user_id = w.user_id AND x.query_id = w.query_id AND x.topic = t.topic
          GROUP BY 1, 2, 3""",
    }


def mixture_result(mix: str) -> str:
    return compose(
        ["nodes", "edges", "doc_topics", "run", mix], _mixture(mix),
        "SELECT user_id, query_id, doc, round(rank, 12) AS rank FROM ranks",
    )


def _scored() -> dict[str, str]:
    return {
        **LINKS, **_global(),
        "scored": "SELECT user_id, query_id, doc, rel, rank FROM run LEFT JOIN ranks ON ranks.id = run.doc",
    }


VIEWS = ["nodes", "edges", "run"]


def scored_result() -> str:
    return compose(
        VIEWS, _scored(), "SELECT user_id, query_id, doc, round(rel, 12) AS rel, round(rank, 12) AS rank FROM scored"
    )


def score_range() -> str:
    sides = ", ".join(f"round({f}({c}), 12) AS {a}_{c}" for c in ("rank", "rel") for f, a in (("min", "low"), ("max", "high")))
    return compose(VIEWS, _scored(), f"SELECT user_id, query_id, {sides} FROM scored GROUP BY 1, 2")


def l1_norms() -> str:
    return compose(VIEWS, _scored(), "SELECT user_id, query_id, round(sum(abs(rel)), 6) AS l1 FROM scored GROUP BY 1, 2")


def _units() -> dict[str, str]:
    def unit(c: str) -> str:
        low = f"min({c}) OVER (PARTITION BY user_id, query_id)"
        high = f"max({c}) OVER (PARTITION BY user_id, query_id)"
        return f"CASE WHEN {high} = {low} OR {c} = {low} THEN 1e-10 ELSE ({c} - {low}) / ({high} - {low}) END AS {c}_unit"

    return {"units": f"SELECT *, {unit('rank')}, {unit('rel')} FROM scored"}


def list_minmax() -> str:
    return compose(
        VIEWS, {**_scored(), **_units()},
        "SELECT user_id, query_id, doc, round(rank_unit, 9) AS rank_unit, round(rel_unit, 9) AS rel_unit FROM units",
    )


def list_l1() -> str:
    return compose(
        VIEWS, _scored(),
        """SELECT user_id, query_id, doc, round(rank / sum(abs(rank)) OVER (PARTITION BY user_id, query_id), 9) AS share
           FROM scored""",
    )


COEFFICIENTS = {
    "C01": "p + s", "C02": "abs(p - s)", "C03": "(p + s) / 2", "C04": "greatest(p, s)", "C05": "sqrt(p * s)",
    "C06": "2 / (1 / p + 1 / s)", "C07": "exp(s) - exp(p)", "C08": "exp(s) + exp(p)", "C09": "ln(s) - ln(p)",
    "C10": "-ln(p) - ln(s)",
}


def _cm(variant: str) -> dict[str, str]:
    return {
        **_units(),
        "raw": f"SELECT *, {COEFFICIENTS[variant]} AS c FROM (SELECT *, rank_unit AS p, rel_unit AS s FROM units) u",
        "fused": """SELECT user_id, query_id, doc,
                      s + c / CASE WHEN l = 0 THEN 1 ELSE l END AS score
                    FROM (SELECT *, sum(abs(c)) OVER (PARTITION BY user_id, query_id) AS l FROM raw) t""",
    }


def fuse_cm(variant: str) -> str:
    return compose(
        VIEWS, {**_scored(), **_cm(variant)}, "SELECT user_id, query_id, doc, round(score, 9) + 0.0 AS score FROM fused"
    )


def fuse_ns() -> str:
    return compose(VIEWS, _scored(), "SELECT user_id, query_id, doc, round(rank, 12) AS score FROM scored")


def fuse_ws() -> str:
    return compose(
        VIEWS, _scored(),
        "SELECT user_id, query_id, doc, round(0.999 * rank + 0.001 * rel, 9) + 0.0 AS score FROM scored",
    )


def ranked(source: str, method: str, with_score: bool = True, repeats: bool = False) -> str:
    if source == "global":
        needs, base = VIEWS, _scored()
    else:
        needs = ["nodes", "edges", "doc_topics", "run", source]
        base = {
            **_mixture(source),
            "scored": f"""SELECT user_id, query_id, doc, {"CASE WHEN doc % 3 = 1 AND doc % 2 = 0 THEN rel - 0.5 ELSE rel END AS rel" if repeats else "rel"},
                rank FROM run LEFT JOIN ranks USING (user_id, query_id, doc)""",
        }
    if method == "CM":
        fused = _cm("C07")
    else:
        score = "rank" if method == "NS" else "0.999 * rank + 0.001 * rel"
        fused = {"fused": f"SELECT user_id, query_id, doc, {score} AS score FROM scored"}
    last = ", round(score, 9) + 0.0 AS score" if with_score else ""
    return compose(
        needs, {**base, **fused},
        f"""SELECT user_id, query_id, doc,
              row_number() OVER (PARTITION BY user_id, query_id
                ORDER BY CASE WHEN score = 0 THEN 0 ELSE floor(score * grid + 0.5) / grid END DESC, CAST(doc AS VARCHAR) DESC) AS position{last}
            FROM (SELECT *, power(10, 9 - floor(log10(nullif(abs(score), 0)))) AS grid FROM fused) f""",
    )
