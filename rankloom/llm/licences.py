"""Licence texts and notices in documents, by templates with markup.

A template is wording with marked regions: ``[...]`` may be missing, ``<a-b>`` stands for
a to b words of any kind. All templates become one automaton over words, which runs
through a whole text from the words that a template can start with. A template accepts
a passage whose mandatory wording is its own, word for word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import text_slices, worker_cache

# Phrases with their labels, and the wording of public licences and their usual notices.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
_NO_WARRANTY = "provided as is without warranty of any kind"
TEMPLATES = {
    "mit-notice": ("mit", "[released|licensed|available|distributed] under the [terms of the] mit license"),
    "mit-text": (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
        "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
        "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so subject to the following conditions the above copyright notice and this permission notice [including "
        "the next paragraph] shall be included in all copies or substantial portions of the software [the software is "
        + _NO_WARRANTY + " express or implied]",
    ),
    "apache-notice": ("apache", "licensed under the apache license version 2 0 [the license]"),
    "apache-header": (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at <0-12> unless required by applicable law or agreed to in writing software "
        "distributed under the license is distributed on an as is basis without warranties or conditions of any kind",
    ),
    "gpl-notice": ("gpl", "licensed under the [terms of the] [gnu] general public license [as published by the free software foundation] [version <1-2>]"),
    "gpl-header": (
        "gpl",
        "is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version <1-2> of the license or [at your option] any later version",
    ),
    "lgpl-notice": ("lgpl", "under the [terms of the] gnu lesser general public license [version <1-2>]"),
    "cc-notice": ("cc", "licensed under [a|the] cc by [nc] [nd|sa] [<1-1> 0]"),
    "cc-long-notice": ("cc", "licensed under [a|the] creative commons attribution [noncommercial|non commercial] [sharealike|share alike|noderivatives] <0-3> license"),
    "bsd-text": (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met [1] redistributions of source code must retain the above copyright notice this list of conditions and "
        "the following disclaimer [2] redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials provided with the distribution [[3] "
        "neither the name of <1-16> may be used to endorse or promote products derived from this software without specific prior "
        "written permission]",
    ),
    "isc-text": (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "spdx-line": ("spdx", "spdx license identifier <1-4>"),
}

_WORDS_OF = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
_MARKS = re.compile(r"\[|\]|\||<(\d+)-(\d+)>|[^\s\[\]|<>]+")


def words_of(text: str) -> list[bytes]:
    """Words of a text, A-Z lower-cased: letters and digits of ASCII and all other characters beyond it."""
    return text.encode().translate(_WORDS_OF).split()


@dataclass(frozen=True)
class Region:
    """``low`` to ``high`` words of any kind."""

    low: int
    high: int


@dataclass(frozen=True)
class Optional:
    """One of several wordings, or nothing."""

    choices: tuple[tuple, ...]


def parse(template: str) -> tuple:
    """The parts of a template: words, regions and optional wordings, which may hold optional wordings themselves."""
    stack: list[list[list]] = [[[]]]
    at = 0
    for mark in _MARKS.finditer(template):
        if template[at : mark.start()].strip():
            raise ValueError(f"cannot read {template[at : mark.start()]!r} in a template")
        at, token = mark.end(), mark[0]
        if token == "[":
            stack.append([[]])
        elif token == "|":
            if len(stack) == 1:
                raise ValueError("a choice stands in brackets only")
            stack[-1].append([])
        elif token == "]":
            if len(stack) == 1:
                raise ValueError("a bracket is closed but not opened")
            choices = stack.pop()
            stack[-1][-1].append(Optional(tuple(map(tuple, choices))))
        elif mark[1]:
            low, high = int(mark[1]), int(mark[2])
            if low > high:
                raise ValueError("a region has more words at least than at most")
            stack[-1][-1].append(Region(low, high))
        else:
            stack[-1][-1].extend(words_of(token))
    if len(stack) > 1 or template[at:].strip():
        raise ValueError("a bracket is opened but not closed")
    return tuple(stack[0][0])


def mandatory_words(parts: tuple) -> int:
    return sum(isinstance(p, bytes) for p in parts)


@dataclass
class Automaton:
    """All templates as one automaton; a state is a word, or any word, and what may follow it."""

    word: list[bytes | None] = field(default_factory=list)  # None: any word
    after: list[tuple[int, ...]] = field(default_factory=list)
    accepts: list[tuple[str, ...]] = field(default_factory=list)  # templates that are complete after the word
    first: dict[bytes, list[int]] = field(default_factory=dict)
    anywhere: list[int] = field(default_factory=list)  # states that start at any word

    @classmethod
    def of(cls, templates: Mapping[str, str]) -> Automaton:
        made = cls()
        for name, template in templates.items():
            start, ends = made._build(parse(template), (frozenset(), frozenset([name])))
            if ends or not start:
                raise ValueError(f"template {name} has no mandatory wording")
            for state in sorted(start):
                if made.word[state] is None:
                    made.anywhere.append(state)
                else:
                    made.first.setdefault(made.word[state], []).append(state)
        return made

    def _state(self, word: bytes | None, then: tuple[frozenset, frozenset]) -> tuple[frozenset, frozenset]:
        self.word.append(word)
        self.after.append(tuple(sorted(then[0])))
        self.accepts.append(tuple(sorted(then[1])))
        return frozenset([len(self.word) - 1]), frozenset()

    def _build(self, parts: tuple, then: tuple[frozenset, frozenset]) -> tuple[frozenset, frozenset]:
        """(states, templates complete without one) that begin ``parts``, from those that follow them."""
        for part in reversed(parts):
            if isinstance(part, Optional):
                ways = [then, *(self._build(c, then) for c in part.choices)]
                then = frozenset().union(*(w[0] for w in ways)), frozenset().union(*(w[1] for w in ways))
            elif isinstance(part, Region):
                end = then
                for _ in range(part.high - part.low):
                    more = self._state(None, then)
                    then = more[0] | end[0], end[1]
                for _ in range(part.low):
                    then = self._state(None, then)
            else:
                then = self._state(part, then)
        return then

    def run(self, words: Sequence[bytes]) -> list[tuple[str, int, int]]:
        """(template, first word, last word) of the accepted passages: earliest and longest, none over another of its template.

        A run from one word ends after as many words as the longest template has at most.
        """
        starts = range(len(words)) if self.anywhere else [i for i, w in enumerate(words) if w in self.first]
        last: dict[str, int] = {}
        out = []
        for start in starts:
            longest: dict[str, int] = {}
            active = {*self.first.get(words[start], ()), *self.anywhere}
            at = start
            while active and at < len(words):
                then: set[int] = set()
                for state in active:
                    if self.word[state] is None or self.word[state] == words[at]:
                        then.update(self.after[state])
                        for name in self.accepts[state]:
                            longest[name] = at
                active = then
                at += 1
            for name, end in longest.items():
                if start > last.get(name, -1):
                    out.append((name, start, end))
                    last[name] = end
        return sorted(out)


@worker_cache(4)
def _automaton(templates: tuple[tuple[str, str], ...]) -> Automaton:
    return Automaton.of(dict(templates))


def phrase_places(words: Sequence[bytes], phrases: Sequence[tuple[bytes, ...]]) -> list[tuple[int, int]]:
    """(phrase number, first word) of every place where a phrase's words stand one after another."""
    firsts = {p[0] for p in phrases}
    out = []
    for i in [i for i, w in enumerate(words) if w in firsts]:
        out += [(k, i) for k, p in enumerate(phrases) if tuple(words[i : i + len(p)]) == p]
    return out


def certainty(mandatory: int) -> float:
    """0 for no wording, nearer to 1 the more words had to be the same."""
    return 1.0 - 1.0 / (1 + mandatory)


SCHEMA = (
    "n_words long, places array<struct<label:string,first:long>>, "
    "matches array<struct<label:string,template:string,first:long,last:long>>, labels array<string>, score double"
)


def scan(
    df: DataFrame,
    templates: Mapping[str, tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(id, n_words, places, matches, labels, score) of every whole text, one row for each row.

    ``places`` are all places of the phrases, ``matches`` the passages that templates
    accept, with first and last word counted from 0; ``labels`` are the sorted different
    labels of both. The score grows with the mandatory words of the longest of them. A
    null or empty text has no words, no labels and score 0. Null ids and repeated rows
    stay; other columns are not read. Templates and phrases travel with the task.
    """
    names = tuple((name, wording) for name, (_, wording) in templates.items())
    label_of = {name: label for name, (label, _) in templates.items()}
    weight = {name: mandatory_words(parse(wording)) for name, (_, wording) in templates.items()}
    known = [(tuple(words_of(p)), label) for p, label in phrases.items()]
    if any(not p for p, _ in known):
        raise ValueError("a phrase has no word")
    _automaton(names)  # a wrong template is an error here
    kept = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"id {df.schema[id].dataType.simpleString()}, {SCHEMA}"
    place_type = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64())]))
    match_type = pa.list_(pa.struct([("label", pa.string()), ("template", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))

    def row(content: str | None) -> tuple:
        words = words_of(content or "")
        places = phrase_places(words, [p for p, _ in known])
        matches = _automaton(names).run(words)
        labels = {known[k][1] for k, _ in places} | {label_of[m[0]] for m in matches}
        longest = max([len(known[k][0]) for k, _ in places] + [weight[m[0]] for m in matches], default=0)
        return (
            len(words),
            [{"label": known[k][1], "first": i} for k, i in places],
            [{"label": label_of[n], "template": n, "first": a, "last": b} for n, a, b in matches],
            sorted(labels),
            certainty(longest),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                n, places, matches, labels, score = zip(*map(row, texts))
                arrays = [
                    batch.column(0)[a:b], pa.array(n, pa.int64()), pa.array(places, place_type), pa.array(matches, match_type),
                    pa.array(labels, pa.list_(pa.string())), pa.array(score, pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "places", "matches", "labels", "score"])

    return kept.mapInArrow(run, schema).withColumnRenamed("id", id)


def _pattern(parts: tuple) -> str:
    """A regular expression over words that each end in a space."""
    out = ""
    for part in parts:
        if isinstance(part, Optional):
            out += "(?:" + "|".join(_pattern(c) for c in part.choices) + ")?"
        elif isinstance(part, Region):
            out += f"(?:[^ ]+ ){{{part.low},{part.high}}}" if part.high else ""
        else:
            out += part.decode() + " "
    return out


def scan_sql(templates: Mapping[str, tuple[str, str]] = TEMPLATES, phrases: Mapping[str, str] = PHRASES) -> str:
    """The digest of a scan of ``documents`` in SQL, templates as regular expressions."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    wordings = ",\n    ".join(f"('{label}', {mandatory_words(parse(t))}, ' {_pattern(parse(t))}')" for label, t in templates.values())
    phrase = ",\n    ".join(f"('{label}', {p.split()})" for p, label in phrases.items())
    return rf"""
with patterns(label, mandatory, pattern) as (values {wordings}),
phrases(label, phrase) as (values {phrase}),
texts as (
    select row_number() over () as nr, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from documents),
lines as (select *, ' ' || array_to_string(words, ' ') || ' ' as line from texts),
base as (
    select nr, label, len(phrase) as mandatory,
        unnest(list_filter(range(len(words)), lambda i: words[i + 1 : i + len(phrase)] = phrase)) as first
    from lines, phrases where line like '% ' || array_to_string(phrase, ' ') || ' %'),
found as (
    select nr, label, mandatory from base
    union all
    select nr, label, mandatory from lines, patterns where regexp_matches(line, pattern)),
bases as (select nr, count(*) as n_base, min(first) as first_word, max(first) as last_word, list_sort(list_distinct(list(label))) as labels from base group by nr),
all_labels as (select nr, list_sort(list_distinct(list(label))) as labels, max(mandatory) as longest from found group by nr)
select doc_id, len(words) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
    coalesce(array_to_string(b.labels, ','), '') as base_labels, coalesce(array_to_string(a.labels, ','), '') as labels,
    1.0::double - 1.0::double / (1 + coalesce(longest, 0)) as score
from lines left join bases b using (nr) left join all_labels a using (nr)
"""
