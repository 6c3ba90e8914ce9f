"""License scans: templates with optional and replaceable regions, matched as automata over words.

A template is wording with markup: <<beginOptional>> ... <<endOptional>> may be left out, and
<<var words="0..9">> or <<var match="a|b c">> stands for so many words or one of some wordings. It is
compiled into an automaton over words. A place of a text is accepted when its mandatory wording
stands there word for word, whatever separates the words. Places where a template can begin are
found by its first two words, which are mandatory; the automaton runs from there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read_table

# Plain phrases with their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Wording of notices and license texts, by label.
TEMPLATES = {
    "apache-2.0-notice": "licensed under the Apache License <<beginOptional>>Version<<endOptional>> 2.0",
    "apache-2.0-header": "licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this <<var words=\"1..3\">> except in compliance with the License",
    "apache-2.0-text": "Apache License Version 2.0, January 2004 <<beginOptional>>http://www.apache.org/licenses/<<endOptional>> TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "bsd-2-clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<var words=\"0..1\">> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. <<var words=\"0..1\">> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED",
    "bsd-3-clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<var words=\"0..1\">> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. <<var words=\"0..1\">> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. <<var words=\"0..1\">> Neither the name of <<beginOptional>>the<<endOptional>> <<var words=\"1..12\">> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc-by-nc-4.0-notice": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> <<var match=\"CC BY NC|Creative Commons Attribution NonCommercial\">> 4.0 <<beginOptional>>International License<<endOptional>>",
    "gpl-3.0-header": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-3.0-notice": "licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License <<beginOptional>>version<<endOptional>> <<var match=\"3|v3|3.0|v3.0\">>",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mit-notice": "under the <<beginOptional>>terms of the<<endOptional>> MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this <<var match=\"software|font software\">> and associated documentation files (the <<var words=\"1..2\">>), to deal in the <<var words=\"1..2\">> without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the <<var words=\"1..2\">>, and to permit persons to whom the <<var words=\"1..2\">> is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the <<var words=\"1..2\">>",
    "unlicense-text": "This is free and unencumbered software released into the public domain <<beginOptional>>Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software<<endOptional>>",
}

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = rb"[^0-9a-z\x80-\xff]+"
_MARKUP = re.compile(r'<<(beginOptional|endOptional|var words="(\d+)\.\.(\d+)"|var match="([^"]*)")>>')
_in_word = np.zeros(256, bool)
_in_word[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True

#: A region: a word, the number range of any words, wordings to choose from, or optional regions.
Region = tuple[str, object]


def split_words(text: str) -> list[bytes]:
    """Words of a text, A-Z in lower case: runs of digits, letters and all that is not ASCII."""
    return _WORD.findall(text.encode().lower())


def parse(template: str) -> list[Region]:
    """Regions of a template; unknown or unbalanced markup, or one without two mandatory words to
    begin with, is an error."""
    stack: list[list[Region]] = [[]]
    at = 0
    for mark in [*_MARKUP.finditer(template), None]:
        plain = template[at : mark.start() if mark else len(template)]
        if "<<" in plain or ">>" in plain:
            raise ValueError(f"unknown markup: {plain}")
        stack[-1] += [("word", w) for w in split_words(plain)]
        if mark is None:
            break
        at = mark.end()
        if mark[1] == "beginOptional":
            stack.append([])
        elif mark[1] == "endOptional":
            if len(stack) == 1:
                raise ValueError("endOptional without its beginning")
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        elif mark[2] is not None:
            stack[-1].append(("any", (int(mark[2]), int(mark[3]))))
        else:
            stack[-1].append(("choice", [split_words(c) for c in mark[4].split("|")]))
    if len(stack) > 1:
        raise ValueError("beginOptional without its end")
    if [kind for kind, _ in stack[0][:2]] != ["word", "word"]:
        raise ValueError("a template begins with two mandatory words")
    return stack[0]


def mandatory_words(regions: list[Region]) -> int:
    """Words that stand in every accepted text, a replaceable region's least number among them."""
    least = {"word": lambda x: 1, "any": lambda x: x[0], "choice": lambda x: min(map(len, x)), "optional": lambda x: 0}
    return sum(least[kind](x) for kind, x in regions)


@dataclass(frozen=True)
class Automaton:
    """States with, for each, the words that lead on, the states that any word leads to, and those
    reached without a word."""

    label: str
    words: tuple[dict[bytes, tuple[int, ...]], ...]
    any_word: tuple[tuple[int, ...], ...]
    free: tuple[tuple[int, ...], ...]
    end: int
    first: tuple[bytes, bytes]
    mandatory: int

    def closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def longest_from(self, words: Iterator[bytes]) -> int:
        """Words of the longest accepted run from the start; 0: none."""
        states, best = self.closed({0}), 0
        for n, word in enumerate(words, 1):
            states = self.closed({t for s in states for t in (*self.words[s].get(word, ()), *self.any_word[s])})
            if self.end in states:
                best = n
            if not states:
                break
        return best


def compile_template(label: str, template: str) -> Automaton:
    words: list[dict[bytes, list[int]]] = [{}]
    any_word: list[list[int]] = [[]]
    free: list[list[int]] = [[]]

    def new() -> int:
        words.append({})
        any_word.append([])
        free.append([])
        return len(words) - 1

    def step(state: int, word: bytes) -> int:
        after = new()
        words[state].setdefault(word, []).append(after)
        return after

    def build(state: int, regions: list[Region]) -> int:
        for kind, x in regions:
            if kind == "word":
                state = step(state, x)
            elif kind == "optional":
                after = build(state, x)
                free[state].append(after)
                state = after
            elif kind == "any":
                least, most = x
                passed = [state]
                for _ in range(most):
                    after = new()
                    any_word[passed[-1]].append(after)
                    passed.append(after)
                state = new()
                for p in passed[least:]:
                    free[p].append(state)
            else:
                after = new()
                for choice in x:
                    last = state
                    for word in choice:
                        last = step(last, word)
                    free[last].append(after)
                state = after
        return state

    regions = parse(template)
    end = build(0, regions)
    frozen = tuple({w: tuple(t) for w, t in m.items()} for m in words)
    return Automaton(label, frozen, tuple(map(tuple, any_word)), tuple(map(tuple, free)), end, (regions[0][1], regions[1][1]), mandatory_words(regions))


@lru_cache(8)
def _compiled(templates: tuple[tuple[str, str], ...]) -> tuple[re.Pattern[bytes], dict[tuple[bytes, bytes], list[Automaton]]]:
    """Where a template may begin, as a pattern, and the automata by their first two words."""
    by_start: dict[tuple[bytes, bytes], list[Automaton]] = {}
    for label, template in templates:
        a = compile_template(label, template)
        by_start.setdefault(a.first, []).append(a)
    seconds: dict[bytes, list[bytes]] = {}
    for one, two in by_start:
        seconds.setdefault(one, []).append(two)
    starts = b"|".join(re.escape(one) + rb"(?=" + _GAP + rb"(?:" + b"|".join(map(re.escape, twos)) + rb")(?![0-9a-z\x80-\xff]))" for one, twos in seconds.items())
    return re.compile(rb"(?<![0-9a-z\x80-\xff])(?:" + starts + rb")"), by_start


def scan_text(text: str, templates: tuple[tuple[str, str], ...]) -> tuple[int, list[tuple[str, int, int]]]:
    """Number of words, and (label, first word, word after the last) of every accepted place."""
    raw = text.encode().lower()
    inside = _in_word[np.frombuffer(raw, np.uint8)]
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]])) if raw else np.zeros(0, int)
    begins, by_start = _compiled(templates)
    found = []
    for m in begins.finditer(raw):
        first = int(np.searchsorted(starts, m.start()))
        second = _WORD.search(raw, m.end())
        for automaton in by_start[m[0], second[0]]:
            n = automaton.longest_from(w[0] for w in _WORD.finditer(raw, m.start()))
            if n:
                found.append((automaton.label, first, first + n))
    return len(starts), found


def license_places(df: DataFrame, *, text: str = "text", key: str = "doc_id", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """A row per row of df: key, n_words and places, an array of (label, first_word, end_word).

    Words are counted from 0 over the whole text, A-Z in lower case. A label may be accepted at many
    places, each with its longest run; places of different templates may overlap. A null or empty
    text has no word and no place. Repeated rows get equal answers, a null key passes through, texts
    of any length are read whole, and an empty table gives an empty result. Other columns, whatever
    their names, are left out.
    """
    listed = tuple(templates.items())
    named = df.select(key, text).toDF("k", "t")
    place = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers = [scan_text(t or "", listed) for t in batch["t"].to_pylist()]
            places = [[dict(zip(("label", "first_word", "end_word"), p, strict=True)) for p in ps] for _, ps in answers]
            yield pa.record_batch({"k": batch["k"], "n_words": pa.array([n for n, _ in answers], pa.int64()), "places": pa.array(places, place)})

    kept = named.schema["k"].dataType.simpleString()
    return named.mapInArrow(scan, f"k {kept}, n_words long, places array<struct<label string, first_word long, end_word long>>").withColumnRenamed("k", key)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases are templates without markup, so that one scan finds them and the method's own.

    score: the mandatory words of all labels of a document, each label once, as a share of its words.
    """
    named = {f"phrase {label}": phrase for phrase, label in PHRASES.items()}
    mandatory = {label: compile_template(label, t).mandatory for label, t in (named | TEMPLATES).items()}
    found = license_places(read_table(spark, sf_dir, "documents"), templates=named | TEMPLATES)
    words = ", ".join(f"'{label}', {n}" for label, n in mandatory.items())
    return found.selectExpr("doc_id", "n_words", "filter(places, p -> p.label LIKE 'phrase %') AS base", "array_distinct(transform(places, p -> p.label)) AS every").selectExpr(
        "doc_id",
        "n_words",
        "cast(size(base) AS bigint) AS n_base",
        "array_min(transform(base, p -> p.first_word)) AS first_word",
        "array_max(transform(base, p -> p.first_word)) AS last_word",
        "array_join(array_sort(array_distinct(transform(base, p -> substr(p.label, 8)))), ',') AS base_labels",
        "array_join(array_sort(array_distinct(transform(every, x -> replace(x, 'phrase ', '')))), ',') AS labels",
        f"least(1.0D, coalesce(aggregate(every, 0, (n, x) -> n + map({words})[x]) / nullif(n_words, 0), 0.0D)) AS score",
    )


def template_pattern(regions: list[Region]) -> str:
    """A template as a regular expression over words that each follow a space."""
    made = {
        "word": lambda x: " " + x.decode(),
        "any": lambda x: f"(?: [^ ]+){{{x[0]},{x[1]}}}",
        "choice": lambda x: "(?:" + "|".join("".join(" " + w.decode() for w in c) for c in x) + ")",
        "optional": lambda x: f"(?:{template_pattern(x)})?",
    }
    return "".join(made[kind](x) for kind, x in regions)


def op13_sql() -> str:
    """The same rows by regular expressions and word lists."""
    hits = ", ".join(f"CASE WHEN regexp_matches(s, '{template_pattern(parse(t))} ') THEN {{'label': '{label}', 'n': {mandatory_words(parse(t))}}} END" for label, t in TEMPLATES.items())
    phrases = {label: phrase.split() for phrase, label in PHRASES.items()}
    starts = " UNION ALL ".join(f"SELECT r, '{label}' AS label, {len(ws)} AS n, unnest(list_filter(range(len(w)), lambda i: {' AND '.join(f'w[i + {1 + j}] = {x!r}' for j, x in enumerate(ws))})) AS place FROM d" for label, ws in phrases.items())
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
base AS (
  SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list_sort(list(DISTINCT label)) AS base_labels FROM ({starts}) GROUP BY r),
sizes AS (SELECT r, sum(n) AS n FROM (SELECT DISTINCT r, label, n FROM ({starts})) GROUP BY r),
own AS (SELECT r, list_filter([{hits}], lambda x: x IS NOT NULL) AS hits FROM (SELECT r, ' ' || array_to_string(w, ' ') || ' ' AS s FROM d))
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(base_labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_concat(coalesce(base_labels, []), list_transform(hits, lambda x: x.label))), ',') AS labels,
       least(1, CASE WHEN len(w) > 0 THEN (coalesce(n, 0) + coalesce(list_sum(list_transform(hits, lambda x: x.n)), 0))::DOUBLE / len(w) ELSE 0 END)::DOUBLE AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN sizes USING (r) LEFT JOIN own USING (r)
"""
