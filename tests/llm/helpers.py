"""Texts that every text operator must cope with, and plain forms of what they compute."""

import re

SCHEMA = "doc_id long, text string, lang string, id string, word string, node long, shard int, n long"


def documents(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, lang, "x", "y", 7, 3, 9) for i, t, lang in rows], SCHEMA)


def ascii_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


ODD_TEXTS = [None, "", " ", "\n\n", "a", "'s", "''ll 're", "x" * 3000, "ab " * 4000, "  x", "\x00", "漢字 かな", "İΣ 😀"]


def odd_rows(start=1000):
    rows = [(start + i, t, "en") for i, t in enumerate(ODD_TEXTS)]
    return [*rows, rows[7], rows[7], (None, "no id at all here", None)]


class Union:
    """Sets that links join; the smallest member stands for each."""

    def __init__(self, members):
        self.up = {m: m for m in members}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
