"""The input views in DuckDB SQL, and a composer for queries on top of them."""

from __future__ import annotations

from rankloom.functions.text import WHITESPACE
from rankloom.plans.views import STOPWORDS

SPACE = WHITESPACE
_TOKENS = (
    f"list_filter(regexp_split_to_array(regexp_replace(lower(text), '[^A-Za-z0-9{SPACE}]+', '', 'g'), '[{SPACE}]+'), "
    "lambda t: t <> '' AND NOT regexp_matches(t, '[0-9]'))"
)
CLEAN = r"regexp_replace(lower(regexp_replace(text, '\([^)]*\)', '', 'g')), '[^a-z0-9]+', ' ', 'g')"
WORDS = f"list_filter(string_split({CLEAN}, ' '), lambda t: t <> '')"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "nodes": (
        (),
        """SELECT 3 * c_custkey AS id FROM customer UNION ALL SELECT 3 * p_partkey + 1 FROM part
           UNION ALL SELECT 3 * s_suppkey + 2 FROM supplier""",
    ),
    "edges": (
        (),
        """SELECT src, dst, CAST(count(*) AS DOUBLE) AS weight FROM (
             SELECT 3 * o_custkey AS src, 3 * l_partkey + 1 AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             UNION ALL
             SELECT 3 * l_partkey + 1, 3 * o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             WHERE l_returnflag = 'R'
             UNION ALL SELECT 3 * l_partkey + 1, 3 * l_suppkey + 2 FROM lineitem) l
           GROUP BY src, dst""",
    ),
    "doc_topics": (
        (),
        """SELECT 3 * c_custkey AS doc, CAST(1 + c_nationkey % 12 AS INT) AS topic FROM customer
           UNION ALL SELECT 3 * p_partkey + 1, CAST(1 + p_size % 12 AS INT) FROM part
           UNION ALL SELECT 3 * s_suppkey + 2, CAST(1 + s_nationkey % 12 AS INT) FROM supplier""",
    ),
    "sales": (
        (),
        """SELECT c.c_nationkey AS user_id, CAST(1 + o.o_orderkey % 6 AS INT) AS query_id, l.l_partkey, l.l_extendedprice
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey""",
    ),
    "topic_counts": (
        ("sales",),
        """SELECT user_id, query_id, CAST(1 + p_size % 12 AS INT) AS topic, CAST(count(*) AS DOUBLE) AS n
           FROM sales JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""",
    ),
    "user_mix": (
        ("topic_counts",),
        "SELECT user_id, query_id, topic, n / sum(n) OVER (PARTITION BY user_id, query_id) AS p FROM topic_counts",
    ),
    "query_mix": (
        ("topic_counts",),
        """SELECT u.user_id, s.query_id, s.topic, s.p
           FROM (SELECT query_id, topic, sum(n) / sum(sum(n)) OVER (PARTITION BY query_id) AS p
                 FROM topic_counts GROUP BY query_id, topic) s
           JOIN (SELECT DISTINCT user_id, query_id FROM topic_counts) u USING (query_id)""",
    ),
    "run": (
        ("sales",),
        """SELECT user_id, query_id, 3 * l_partkey + 1 AS doc, round(ln(sum(l_extendedprice) / 10000000), 6) AS rel
           FROM sales GROUP BY user_id, query_id, l_partkey""",
    ),
    "ratings": (
        (),
        """SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
                  CAST(1 + floor((l.l_quantity - 1) / 10) AS INT) AS rating, CAST(l.l_orderkey % 10 AS INT) AS fold
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    ),
    "train": (
        ("ratings",),
        "SELECT user_id, item_id, CAST(sum(rating - 3) AS DOUBLE) AS rating FROM ratings WHERE fold < 9 GROUP BY 1, 2",
    ),
    "stars": (
        ("ratings",),
        "SELECT user_id, item_id, CAST(sum(rating) AS DOUBLE) AS rating FROM ratings WHERE fold < 9 GROUP BY 1, 2",
    ),
    "profiles": (("train",), "SELECT * FROM train WHERE rating <> 0"),
    "pairs": (("ratings",), "SELECT DISTINCT item_id, user_id FROM ratings WHERE fold = 9"),
    "truth": (
        ("ratings",),
        "SELECT item_id, user_id, avg(rating) AS truth FROM ratings WHERE fold = 9 GROUP BY 1, 2",
    ),
    "targets": (
        ("pairs",),
        "SELECT row_number() OVER (ORDER BY item_id, user_id) AS pair_idx, item_id, user_id FROM pairs",
    ),
    "users": ((), "SELECT c_custkey AS id FROM customer"),
    "items": ((), "SELECT p_partkey AS id FROM part"),
    "reviews": (
        (),
        """SELECT doc_id, text, CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 WHEN 'fr' THEN 3 ELSE 4 END AS stars,
                  CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'dev' ELSE 'test' END AS split
           FROM documents""",
    ),
    "stopwords": ((), "SELECT word FROM (VALUES " + ", ".join(f"('{w}')" for w in STOPWORDS) + ") t(word)"),
    "review_words": (
        ("reviews", "stopwords"),
        f"""SELECT doc_id, stars, split, word, count(*) AS tf
            FROM (SELECT doc_id, stars, split, unnest({_TOKENS}) AS word FROM reviews) t
            WHERE word NOT IN (SELECT word FROM stopwords) GROUP BY ALL""",
    ),
    "binary_text": (
        (),
        """SELECT d.doc_id, d.text, 2 * l.quality - 1 AS y
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    ),
    "binary_tokens": (
        ("binary_text",),
        f"""SELECT doc_id, y, unnest(w) AS word, unnest(range(len(w))) AS pos
            FROM (SELECT doc_id, y, {WORDS} AS w FROM binary_text) t""",
    ),
    "dense_rows": (
        (),
        """SELECT vec_id AS row_id, embedding AS v, CASE WHEN label < 5 THEN 1 ELSE -1 END AS y, label + 1 AS cls,
                  vec_id % 5 = 0 AS is_test FROM embeddings""",
    ),
    "feat": (
        ("dense_rows",),
        """SELECT row_id, y, cls, is_test, unnest(range(len(v))) AS idx, CAST(unnest(v) AS DOUBLE) AS val
           FROM dense_rows""",
    ),
}
TOKENS = _TOKENS


def compose(needs: list[str], steps: dict[str, str], final: str) -> str:
    """``WITH`` statement of the needed views, the query's own steps and its result."""
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in VIEWS[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    parts = [f"{n} AS MATERIALIZED ({VIEWS[n][1]})" for n in order]
    parts += [f"{n} AS ({s})" if "(" in n else f"{n} AS MATERIALIZED ({s})" for n, s in steps.items()]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + final
