"""DuckDB SQL for text cleaning, counts, features and word vectors."""

from __future__ import annotations

from rankloom.plans.oracle.views import CLEAN, SPACE, TOKENS, WORDS, compose
from rankloom.plans.views import DIM

TOKENIZE = compose(["reviews"], {}, f"SELECT doc_id, array_to_string({TOKENS}, ' ') AS tokens FROM reviews")
CLEAN_LINE = f"SELECT doc_id, {CLEAN} AS clean FROM documents"
WORD_TOKENS = f"SELECT doc_id, array_to_string({WORDS}, ' ') AS words FROM documents"
SENTENCES = """SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(text, '[.!?]+'), lambda s: trim(s)),
                 lambda s: s <> ''), ' | ') AS sentences FROM documents"""
LOWER_SPLIT = f"""SELECT doc_id, array_to_string(
                    list_filter(regexp_split_to_array(lower(text), '[{SPACE}]+'), lambda t: t <> ''), ' ') AS t
                  FROM documents"""
UNIQUE = compose(
    ["reviews"], {}, f"SELECT doc_id, array_to_string(list_sort(list_distinct({TOKENS})), ' ') AS words FROM reviews"
)
CLASSES = compose(["reviews"], {}, "SELECT doc_id, CAST(stars - 1 AS INT) AS cls FROM reviews")
DOC_WORDS = compose(["review_words"], {}, "SELECT doc_id, word, tf FROM review_words")
TERM_BINARY = compose(["review_words"], {}, "SELECT doc_id, word, CAST(1 AS INT) AS tf FROM review_words")
WORD_COUNT = compose(["binary_tokens"], {}, "SELECT word, count(*) AS cnt FROM binary_tokens GROUP BY 1")

COUNTS = {
    "ctf": "SELECT word, CAST(sum(tf) AS BIGINT) AS cnt FROM review_words WHERE split = 'train' GROUP BY 1",
    "df": "SELECT word, count(*) AS cnt FROM review_words WHERE split = 'train' GROUP BY 1",
    "cdf": "SELECT stars, word, count(*) AS cnt FROM review_words WHERE split = 'train' GROUP BY 1, 2",
    "bycls": """SELECT * FROM (
                  SELECT stars, word, cnt, row_number() OVER (PARTITION BY stars ORDER BY cnt DESC, word) AS rank FROM cdf) t
                WHERE rank <= 2000""",
}
COLLECTION_TF = compose(["review_words"], COUNTS, "SELECT word, cnt FROM ctf")
DOCUMENT_FREQ = compose(["review_words"], COUNTS, "SELECT word, cnt FROM df")
CLASS_FREQ = compose(["review_words"], COUNTS, "SELECT stars, word, cnt FROM cdf")
TOP_PER_CLASS = compose(["review_words"], COUNTS, "SELECT stars, word, cnt, rank FROM bycls")


def _chosen(scheme: str) -> dict[str, str]:
    if scheme == "BAL":
        rows = "SELECT word, row_number() OVER (ORDER BY word) AS rn FROM (SELECT DISTINCT word FROM bycls) t"
    else:
        counts = "ctf" if scheme == "CTF" else "df"
        rows = f"""SELECT * FROM (SELECT word, row_number() OVER (ORDER BY cnt DESC, word) AS rn FROM {counts}) t
                   WHERE rn <= 2000"""
    return {**COUNTS, "chosen": f"SELECT word, CAST(rn - 1 AS INT) AS idx FROM ({rows}) c"}


def features(scheme: str) -> str:
    return compose(["review_words"], _chosen(scheme), "SELECT word, idx FROM chosen")


def doc_term_steps(scheme: str) -> dict[str, str]:
    val = "CAST(tf AS DOUBLE)" if scheme == "CTF" else "CAST(1 AS DOUBLE)"
    return {
        **_chosen(scheme),
        "doc_term": f"""SELECT doc_id AS row_id, idx, {val} AS val, stars AS cls, split
                        FROM review_words JOIN chosen USING (word)""",
    }


def doc_term(scheme: str) -> str:
    return compose(["review_words"], doc_term_steps(scheme), "SELECT row_id, idx, val FROM doc_term")


VOCAB = {
    "wc": "SELECT word, count(*) AS cnt FROM binary_tokens GROUP BY 1",
    "ranked": "SELECT word, cnt, row_number() OVER (ORDER BY cnt DESC, word) AS rn FROM wc",
    "vocab": """SELECT '<unk>' AS word, 0 AS idx, CAST(0 AS BIGINT) AS cnt UNION ALL SELECT '<pad>', 1, 0
                UNION ALL SELECT word, CAST(rn + 1 AS INT), cnt FROM ranked WHERE rn <= 10000 AND cnt >= 3""",
}
TOP_VOCAB = compose(
    ["binary_tokens"], VOCAB, "SELECT word, CAST(rn + 1 AS INT) AS idx, cnt FROM ranked WHERE rn <= 10000"
)
BUILD_VOCAB = compose(["binary_tokens"], VOCAB, "SELECT word, idx, cnt FROM vocab")


def encode(length: int) -> str:
    return compose(
        ["binary_text", "binary_tokens"],
        {
            **VOCAB,
            "coded": f"""SELECT doc_id, list(coalesce(idx, 0) ORDER BY pos) AS c FROM binary_tokens LEFT JOIN vocab USING (word)
                         WHERE pos < {length} GROUP BY 1""",
        },
        f"""SELECT doc_id, array_to_string(list_concat(coalesce(c, []),
              list_transform(range({length} - coalesce(len(c), 0)), lambda i: 1)), ' ') AS codes
            FROM binary_text LEFT JOIN coded USING (doc_id)""",
    )


def length_batches(size: int) -> str:
    return compose(
        ["binary_text"],
        {"sized": f"SELECT doc_id, CAST(len({WORDS}) AS INT) AS length FROM binary_text"},
        f"""SELECT doc_id, length, CAST((row_number() OVER (ORDER BY length, doc_id) - 1) // {size} AS BIGINT) AS batch
            FROM sized""",
    )


NGRAMS = compose(
    ["binary_text"],
    {
        "w": f"SELECT doc_id, {WORDS} AS w FROM binary_text",
        "grams": """SELECT doc_id, n, array_to_string(w[i + 1 : i + n], ' ') AS gram
                    FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM w, (VALUES (3), (4), (5)) k(n)) t""",
    },
    "SELECT n, gram, count(DISTINCT doc_id) AS docs, count(*) AS cnt FROM grams GROUP BY 1, 2",
)
HOLDOUT_STEPS = {
    "placed": """SELECT doc_id, stars, row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) AS pos
                 FROM reviews WHERE split = 'train'""",
}
HOLDOUT = compose(
    ["reviews"], HOLDOUT_STEPS,
    """SELECT doc_id, stars, pos <= (SELECT round_even(count(*) * 0.3, 0) FROM placed) AS in_eval, true AS in_train
       FROM placed""",
)
SPLIT = compose(
    ["binary_text"], {},
    """SELECT doc_id, y,
         CASE WHEN CAST('0x' || substr(md5('7:' || doc_id), 1, 6) AS BIGINT) < 3355443 THEN 'valid' ELSE 'train' END AS split
       FROM binary_text""",
)


def sizes(batch: int) -> str:
    return compose(
        ["reviews"], {},
        f"SELECT split, count(*) AS rows, CAST(ceil(count(*) / {batch}.0) AS BIGINT) AS batches FROM reviews GROUP BY 1",
    )


VECTORS = {
    **VOCAB,
    "vec": f"""SELECT b.word, b.idx, r.v[1:{DIM}] AS v FROM vocab b LEFT JOIN dense_rows r ON r.row_id + 2 = b.idx""",
    "joined": f"""SELECT word, idx, CASE WHEN v IS NULL THEN list_transform(range({DIM}), lambda i: CAST(0 AS DOUBLE))
                    ELSE list_transform(v, lambda x: CAST(x AS DOUBLE)) END AS v FROM vec""",
    "tab": f"""SELECT word, idx, CASE WHEN word = '<unk>'
                 THEN list_transform(range({DIM}), lambda i: (((i * 104729) % 1000) / 1000.0::DOUBLE - 0.5) * 0.1) ELSE v END AS v
               FROM joined""",
}


def _texts(col: str) -> str:
    return f"array_to_string(list_transform({col}, lambda x: CAST(CAST(floor(x * 1e6 + 0.5) AS BIGINT) AS VARCHAR)), ' ') AS {col}"


VECTOR_JOIN = compose(["binary_tokens", "dense_rows"], VECTORS, f"SELECT word, idx, {_texts('v')} FROM joined")
EMBEDDING_SKIP = compose(
    ["binary_tokens", "dense_rows"], VECTORS,
    f"""SELECT word, idx, {_texts('v')} FROM tab WHERE idx < 2 OR idx IN (SELECT row_id + 2 FROM dense_rows)""",
)
W2V_WORDS = compose(["binary_tokens"], VOCAB, "SELECT word FROM wc WHERE cnt >= 3")
EMBEDDING = compose(["binary_tokens", "dense_rows"], VECTORS, f"SELECT word, idx, {_texts('v')} FROM tab")
POOL_STEPS = {
    **VECTORS,
    "words": "SELECT doc_id, word, count(*) AS tf FROM binary_tokens GROUP BY 1, 2",
    "cells": """SELECT doc_id, tf, unnest(v) AS x, unnest(range(len(v))) AS i FROM words JOIN tab USING (word)""",
    "dims": "SELECT doc_id, i, sum(tf * x) / sum(tf) AS m, max(x) AS p FROM cells GROUP BY 1, 2",
}
POOLED = compose(
    ["binary_tokens", "dense_rows"],
    {
        **POOL_STEPS,
        "docs": "SELECT doc_id, list(m ORDER BY i) AS mean, list(p ORDER BY i) AS peak FROM dims GROUP BY 1",
    },
    f"SELECT doc_id, {_texts('mean')}, {_texts('peak')} FROM docs",
)


def classifier(result: str, epochs: int = 20, reg: float = 0.01) -> str:
    """Logistic regression by full gradient steps; feature ``2 * DIM`` is the bias."""
    steps = {
        **POOL_STEPS,
        "given": """SELECT doc_id, CAST(y > 0 AS INT) AS label,
                      CASE WHEN CAST('0x' || substr(md5('0:' || doc_id), 1, 6) AS BIGINT) < 3355443 THEN 'valid' ELSE 'train' END AS split
                    FROM binary_text WHERE doc_id IN (SELECT doc_id FROM dims)""",
        "feats": f"""SELECT doc_id, i, m AS x FROM dims UNION ALL SELECT doc_id, i + {DIM}, p FROM dims
                     UNION ALL SELECT doc_id, {2 * DIM}, 1 FROM given""",
        "fitted": "SELECT doc_id, i, x, label FROM feats JOIN given USING (doc_id) WHERE split = 'train'",
        "rate": f"""SELECT n, 1 / (s / n / 4 + {reg}) AS rate FROM (
                      SELECT sum(x * x) AS s, count(DISTINCT doc_id) AS n FROM fitted) t""",
        "w(it, i, w)": f"""
          SELECT 0, i, CAST(0 AS DOUBLE) FROM (SELECT DISTINCT i FROM feats) t
          UNION ALL
          SELECT w.it + 1, w.i, w.w - rate * (g.s / n + CASE WHEN w.i = {2 * DIM} THEN 0 ELSE {reg} END * w.w)
          FROM w CROSS JOIN rate JOIN (
            SELECT f.i, sum(f.x * (p.p - f.label)) AS s FROM fitted f JOIN (
              SELECT doc_id, 1 / (1 + exp(-sum(x * w))) AS p FROM fitted JOIN w USING (i) GROUP BY 1) p USING (doc_id)
            GROUP BY 1) g ON g.i = w.i
          WHERE w.it < {epochs}""",
        "guess": """SELECT it, doc_id, split, label, CAST(m > 0 AS INT) AS prediction,
                      CASE WHEN label = 1 THEN 1 / (1 + exp(-m)) ELSE 1 - 1 / (1 + exp(-m)) END AS p_true
                    FROM (SELECT it, doc_id, sum(x * w) AS m FROM feats JOIN w USING (i) WHERE it > 0 GROUP BY 1, 2) t
                    JOIN given USING (doc_id)""",
        "history": """SELECT CAST(it AS INT) AS epoch, split, count(*) AS rows, sum(-ln(p_true)) / count(*) AS loss,
                        avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy FROM guess GROUP BY 1, 2""",
        "best": "SELECT epoch FROM history WHERE split = 'valid' ORDER BY loss, epoch LIMIT 1",
    }
    finals = {
        "trace": "SELECT epoch, split, rows, round(loss, 7) + 0.0 AS loss, round(accuracy, 7) + 0.0 AS accuracy FROM history",
        "quality": """SELECT split, rows, round(loss, 7) + 0.0 AS loss, round(accuracy, 7) + 0.0 AS accuracy
                      FROM history WHERE epoch = (SELECT epoch FROM best)""",
        "predictions": """SELECT doc_id, split, label, prediction, round(p_true, 7) + 0.0 AS p_true
                          FROM guess WHERE it = (SELECT epoch FROM best)""",
    }
    return compose(["binary_tokens", "dense_rows"], steps, finals[result])
