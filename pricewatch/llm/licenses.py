"""License scans by template markup (operator 11).

A template is a license's wording with marked regions: ``[...]`` may be left
out (regions nest) and ``{name 0..9}`` stands for any words, so many. It is
compiled into an automaton over words: each mandatory word is a step, an
optional region a way around, a replaceable region a row of steps that take any
word. A place in a text is accepted when the automaton reaches its end, so all
mandatory wording stands there word by word, in order, and nothing else but
what the regions allow. Plain phrases are templates without regions.

The texts are scanned once, without a shuffle. Words become numbers (those of
no template are all one), the leading wording of each template is looked for in
the whole batch at once, and the automata run only from there, all places of a
text together: a state keeps the earliest start that reached it, so the work of
a text is bounded by its words times the states. 64-bit hashes stand for words.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewatch.llm import textscan as ts
from pricewatch.llm.settle import spare, table

ANY, WAY, END = -2, -3, -4      # steps: takes any word; goes on here or elsewhere; accepts
LEAD = 4                # leading words that are looked for at once
MUCH = 4                # mandatory words that make a score of a half
PLACE = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()),
                      T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())])
FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("places", T.ArrayType(PLACE)),
                      T.StructField("score", T.DoubleType())])


class Template(NamedTuple):
    label: str
    wording: str
    base: bool = False


# The phrases of the contract, and wording of public licenses
# and of the notices that refer to them.
BASE = [
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
]
TEMPLATES = [
    Template("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of {work 1..12}
        to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
        the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice [(including the next paragraph)] shall be included in all copies or substantial
        portions of the Software. [THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND]"""),
    Template("mit-0", """Permission is hereby granted, free of charge, to any person obtaining a copy of {work 1..12}
        to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
        the Software is furnished to do so. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND"""),
    Template("isc", """Permission to use, copy, modify, and[/or] distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission notice appear
        in all copies."""),
    Template("0bsd", """Permission to use, copy, modify, and[/or] distribute this software for any purpose with or
        without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" """),
    Template("bsd-2-clause", """Redistribution and use in source and binary forms, with or without modification,
        are permitted provided that the following conditions are met: [1.] Redistributions of source code must
        retain the above copyright notice, this list of conditions and the following disclaimer. [2.]
        Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution. THIS
        SOFTWARE IS PROVIDED BY {holders 1..20} AS IS"""),
    Template("bsd-3-clause", """Redistribution and use in source and binary forms, with or without modification,
        are permitted provided that the following conditions are met: [1.] Redistributions of source code must
        retain the above copyright notice, this list of conditions and the following disclaimer. [2.]
        Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution. [3.]
        Neither the name of {holders 1..20} may be used to endorse or promote products derived from this software
        without specific prior written permission."""),
    Template("apache-2.0", """Licensed under the Apache License, Version 2.0 [(the "License"); you may not use this
        file except in compliance with the License. You may obtain a copy of the License at {address 1..12}]"""),
    Template("gpl-2.0", """GNU General Public License [as published by the Free Software Foundation][;] [either]
        version 2 [.0] [of the License] [only] [or (at your option) any later version]"""),
    Template("gpl-3.0", """GNU General Public License [as published by the Free Software Foundation][;] [either]
        version 3 [.0] [of the License] [only] [or (at your option) any later version]"""),
    Template("lgpl-2.1", """GNU Lesser General Public License [as published by the Free Software Foundation][;]
        [either] version 2.1 [of the License] [only] [or (at your option) any later version]"""),
    Template("lgpl-3.0", """GNU Lesser General Public License [as published by the Free Software Foundation][;]
        [either] version 3 [.0] [of the License] [only] [or (at your option) any later version]"""),
    Template("agpl-3.0", """GNU Affero General Public License [as published by the Free Software Foundation][;]
        [either] version 3 [.0] [of the License] [only] [or (at your option) any later version]"""),
    Template("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v[ersion]
        2.0."""),
    Template("epl-2.0", "made available under the terms of the Eclipse Public License [v] 2.0"),
    Template("unlicense", "This is free and unencumbered software released into the public domain."),
    Template("bsl-1.0", "Distributed under the Boost Software License, Version 1.0"),
    Template("zlib", """This software is provided as is, without any express or implied warranty. In no event will
        the authors be held liable for any damages arising from the use of this software. Permission is granted to
        anyone to use this software for any purpose, including commercial applications, and to alter it and
        redistribute it freely"""),
    Template("cc0-1.0", "Creative Commons [Legal Code] CC0 1.0 [Universal]"),
    Template("cc-by-4.0", """licensed under [a] [the] Creative Commons Attribution 4.0 International [Public]
        License"""),
    Template("cc-by-sa-4.0", """licensed under [a] [the] Creative Commons Attribution ShareAlike 4.0 International
        [Public] License"""),
    Template("cc-by-nc-4.0", """licensed under [a] [the] Creative Commons Attribution NonCommercial 4.0
        International [Public] License"""),
    Template("cc-by-nc-4.0", "licensed under [a] [the] CC BY NC 4.0 [license]"),
    Template("cc-by-4.0", "licensed under [a] [the] CC BY 4.0 [license]"),
    Template("cc-by-sa-4.0", "licensed under [a] [the] CC BY SA 4.0 [license]"),
]

_MARKUP = re.compile(r"(\[)|(\])|\{[^{}]*?(\d+)\.\.(\d+)\}|([^\[\]{}]+)")
_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text: str) -> list[str]:
    return _WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))


def parse(wording: str) -> list:
    """Nested markup: a word, a list (optional region), or (least, most)."""
    open_, at = [[]], 0
    for m in _MARKUP.finditer(wording):
        if m.start() != at:
            break
        if m[2] and len(open_) == 1:
            break
        at = m.end()
        if m[1]:
            open_.append([])
        elif m[2]:
            region = open_.pop()
            open_[-1].append(region)
        elif m[3]:
            open_[-1].append((int(m[3]), int(m[4])))
        else:
            open_[-1].extend(plain_words(m[5]))
    if at != len(wording) or len(open_) != 1:
        raise ValueError(f"template markup isn't closed, or not known: {wording!r}")
    return open_[0]


def mandatory(tree: list) -> int:
    return sum(isinstance(x, str) for x in tree)


class Automata:
    """All templates as one program: the word that a step takes, and from each
    step the steps that can be next and the template that is accepted there."""

    def __init__(self, templates: list[Template]):
        self.templates = templates
        trees = [parse(t.wording) for t in templates]
        self.size = [mandatory(t) for t in trees]
        words = sorted({w for t in trees for w in _words_of(t)})
        self.number = {w: i for i, w in enumerate(words)}
        self.step: list[int] = []
        self.to: dict[int, int] = {}            # of a WAY: where else; of an END: the template
        self.lead: list[tuple[list[int], int]] = []
        for i, tree in enumerate(trees):
            first = len(self.step)
            self._add(tree)
            self._step(END, i)
            run = next((j for j, x in enumerate(tree) if not isinstance(x, str)), len(tree))
            if not run:
                raise ValueError(f"a template starts with a mandatory word: {templates[i].wording!r}")
            lead = min(run, LEAD)
            self.lead.append((self.step[first:first + lead], first + lead))
        self.next = [self._reach(p) for p in range(len(self.step))]
        buf, off = ts.text_buffer(pa.array([" ".join(words)]))
        hashes = ts.words(buf, off, ts.PLAIN).hash
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order.astype(np.int64)

    def _step(self, kind: int, to: int | None = None) -> int:
        if to is not None:
            self.to[len(self.step)] = to
        self.step.append(kind)
        return len(self.step) - 1

    def _add(self, tree: list) -> None:
        for x in tree:
            if isinstance(x, str):
                self._step(self.number[x])
            elif isinstance(x, tuple):
                ways = []
                for n in range(x[1]):
                    if n >= x[0]:
                        ways.append(self._step(WAY))
                    self._step(ANY)
                self.to.update(dict.fromkeys(ways, len(self.step)))
            else:
                way = self._step(WAY)
                self._add(x)
                self.to[way] = len(self.step)

    def _reach(self, p: int) -> tuple[tuple[int, ...], int | None]:
        """The steps that take a word after ``p`` is reached, and the template
        that is accepted then."""
        steps, done, todo = set(), None, [p]
        while todo:
            q = todo.pop()
            if self.step[q] == WAY:
                todo += [q + 1, self.to[q]]
            elif self.step[q] == END:
                done = self.to[q]
            else:
                steps.add(q)
        return tuple(sorted(steps)), done

    def scan(self, buf: np.ndarray, off: np.ndarray):
        """Words of each row and all places: (row, template, start, end), with
        the longest end of each start."""
        w = ts.words(buf, off, ts.PLAIN)
        if not len(self.hashes) or not len(w.hash):
            return np.diff(w.first), []
        at = np.minimum(np.searchsorted(self.hashes, w.hash), len(self.hashes) - 1)
        ids = np.where(self.hashes[at] == w.hash, self.numbers[at], -1)
        enter: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for lead, step in self.lead:
            i = np.flatnonzero(ids[:max(0, len(ids) - len(lead) + 1)] == lead[0])
            for j, word in enumerate(lead[1:], 1):
                i = i[ids[i + j] == word]
            i = i[w.doc[i] == w.doc[i + len(lead) - 1]]
            for start, row in zip(i.tolist(), w.doc[i].tolist()):
                enter.setdefault(row, {}).setdefault(start + len(lead), []).append((step, start))
        found = []
        for row in sorted(enter):
            first, last = int(w.first[row]), int(w.first[row + 1])
            found += [(row, t, start - first, end - first)
                      for (t, start), end in sorted(self._run(ids, last, enter[row]).items())]
        return np.diff(w.first), found

    def _run(self, ids: np.ndarray, last: int, enter: dict[int, list[tuple[int, int]]]) -> dict:
        """(template, start) to end over a row's words up to ``last``, for the
        steps that are entered before a word."""
        ends: dict[tuple[int, int], int] = {}
        todo, live, i = sorted(enter, reverse=True), {}, 0

        def reach(p: int, start: int, into: dict[int, int], at: int) -> None:
            steps, done = self.next[p]
            for q in steps:
                into[q] = min(start, into.get(q, start))
            if done is not None:
                ends[done, start] = at

        while todo or live:
            if not live:
                i = todo[-1]
            if todo and todo[-1] == i:
                todo.pop()
                for p, start in enter[i]:
                    reach(p, start, live, i)
            if i >= last:
                break
            word, after = ids[i], {}
            for p, start in live.items():
                if self.step[p] == ANY or self.step[p] == word:
                    reach(p + 1, start, after, i + 1)
            live, i = after, i + 1
        return ends


def _words_of(tree: list):
    for x in tree:
        if isinstance(x, str):
            yield x
        elif isinstance(x, list):
            yield from _words_of(x)


def scan(docs: DataFrame, templates: list[Template] | None = None, name: str = "_license") -> DataFrame:
    """``docs`` with its columns and a struct of n_words, places (label, start
    and end in words, end exclusive, base: whether the template is a plain
    phrase of the contract; by row of the template list, then by start) and
    score. It is called ``name``, with underscores added while that is taken.

    The score is m / (m + 4) for the m mandatory words of the longest wording
    found, 0 without any. Null, empty and wordless texts have no words and no
    places. Places of different templates, and plain phrases with themselves,
    may overlap; of places of a template that meet in a state, the earliest
    counts. Rows are judged one by one; no rows give no rows.
    """
    templates = BASE + TEMPLATES if templates is None else templates
    Automata(templates)                         # markup errors show here, not in a task
    name = spare(docs, name)
    rows = docs.withColumn("text", F.col("text").cast("string"))
    text = rows.columns.index("text")

    def run(batches):
        automata = Automata(templates)
        for piece in ts.slices(batches):
            buf, off = ts.text_buffer(piece.column(text))
            n, found = automata.scan(buf, off)
            of = np.array([f[0] for f in found], np.int64)
            size = np.zeros(len(n))
            np.maximum.at(size, of, np.array([automata.size[f[1]] for f in found], float))
            places = pa.StructArray.from_arrays(
                [pa.array([templates[f[1]].label for f in found], pa.string()),
                 pa.array([f[2] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.int64()),
                 pa.array([templates[f[1]].base for f in found], pa.bool_())], PLACE.fieldNames())
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(n) + 1)), pa.int32()), places)
            both = pa.StructArray.from_arrays([pa.array(n, pa.int64()), lists, pa.array(size / (size + MUCH))],
                                              FOUND.fieldNames())
            yield pa.RecordBatch.from_arrays([*piece.columns, both], [*piece.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, FOUND)]))


def joined_labels(places):
    return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))))


def op11(spark, sf_dir):
    found, f = scan(table(spark, sf_dir, "documents").select("doc_id", "text")), F.col("_license")
    base = F.filter(f["places"], lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    return found.select(
        "doc_id", f["n_words"].alias("n_words"), F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined_labels(base).alias("base_labels"), joined_labels(f["places"]).alias("labels"),
        f["score"].alias("score"))


def regex(tree: list) -> str:
    """The template over words that a space follows."""
    return "".join(f"{x} " if isinstance(x, str) else f"(?:[^ ]+ ){{{x[0]},{x[1]}}}" if isinstance(x, tuple)
                   else f"(?:{regex(x)})?" for x in tree)


def twin(base=BASE, templates=TEMPLATES) -> str:
    """The same in SQL: places of phrases by comparing lists, templates as
    regular expressions."""
    trees = [(t, parse(t.wording)) for t in base + templates]
    rules = ",\n  ".join(f"('{t.label}', {mandatory(tree)}, ' {regex(tree)}')" for t, tree in trees)
    spots = " || ".join(
        f"list_transform(list_filter(range(1, len(w) + 1), lambda i: w[i:i + {len(tree) - 1}] = {tree}), "
        f"lambda i: {{'label': '{t.label}', 'start': i - 1}})" for t, tree in trees if t.base)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), p AS (SELECT row, doc_id, len(w) AS n_words, ' ' || array_to_string(w, ' ') || ' ' AS t, {spots} AS spots FROM d),
rules(label, size, pattern) AS (VALUES
  {rules}
), hits AS (
  SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(size) / (max(size) + {MUCH}) AS score
  FROM p, rules WHERE regexp_matches(t, pattern) GROUP BY row
)
SELECT doc_id, n_words, len(spots) AS n_base,
  list_min(list_transform(spots, lambda s: s.start)) AS first_word,
  list_max(list_transform(spots, lambda s: s.start)) AS last_word,
  array_to_string(list_sort(list_distinct(list_transform(spots, lambda s: s.label))), ',') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM p LEFT JOIN hits USING (row)
"""
