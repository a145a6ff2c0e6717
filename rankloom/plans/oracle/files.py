"""DuckDB SQL for what comes back from the written formats."""

from __future__ import annotations

from rankloom.plans.oracle import link, margin, rating, words
from rankloom.plans.oracle.views import CLEAN, compose

K = 10
EDGES = compose(["edges"], {}, "SELECT src, dst, weight FROM edges")
DOC_TOPICS = compose(["doc_topics"], {}, "SELECT doc, topic FROM doc_topics")
MIXTURE = compose(
    ["user_mix"], {},
    """SELECT l.user_id, l.query_id, CAST(t.topic AS INT) AS topic, round(coalesce(m.p, 0), 9) AS p
       FROM (SELECT DISTINCT user_id, query_id FROM user_mix) l CROSS JOIN (SELECT unnest(range(1, 13)) AS topic) t
       LEFT JOIN user_mix m ON m.user_id = l.user_id AND m.query_id = l.query_id AND m.topic = t.topic""",
)
RUN = compose(["run"], {}, "SELECT user_id, query_id, doc, rel FROM run")


def ratings(offset: int) -> str:
    return compose(["ratings"], {}, f"SELECT item_id, user_id, CAST(rating - {offset} AS DOUBLE) AS rating FROM ratings")


TARGETS = compose(["targets"], {}, "SELECT pair_idx, item_id, user_id FROM targets")
TREE = compose(
    ["binary_text"], {}, f"SELECT CASE WHEN y = 1 THEN 'pos' ELSE 'neg' END AS label, {CLEAN} AS text FROM binary_text"
)
VECTORS = compose(
    ["dense_rows"], {"r": "SELECT 'w' || row_id AS word, list_transform(v, lambda x: CAST(x AS DOUBLE)) AS v FROM dense_rows"},
    f"SELECT word, {words._texts('v')} FROM r",
)
TEXT_CSV = TREE
LIBSVM = compose(
    ["review_words", "reviews"], words.doc_term_steps("CTF"),
    """SELECT CAST(r.stars AS INT) AS label, d.idx, CAST(d.val AS BIGINT) AS val
       FROM reviews r LEFT JOIN doc_term d ON d.row_id = r.doc_id""",
)
REVIEWS = compose(
    ["reviews"], {},
    """SELECT CAST(doc_id AS VARCHAR) AS review_id, text, CAST(CASE WHEN split = 'train' THEN stars ELSE 0 END AS INT) AS stars
       FROM reviews""",
)
STOPWORDS = compose(
    ["review_words", "reviews"], {},
    "SELECT word FROM review_words GROUP BY word HAVING count(*) * 10 > (SELECT count(*) FROM reviews)",
)
SCORES = link.global_result()
RANKED = link.ranked("global", "WS")
PREDICTIONS = (
    "SELECT pair_idx, score FROM (" + rating.in_order(K) + ") t"
)
HARD_SOFT = "SELECT row_number() OVER (ORDER BY row_id) AS line_no, hard, soft FROM (" + margin.softmax("predict") + ") t"
MODEL = margin.softmax("weights")
