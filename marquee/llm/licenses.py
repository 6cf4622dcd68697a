"""License wording: fixed phrases, and templates with optional and replaceable regions.

A template is words with two kinds of markup: ``[[ ... ]]`` encloses wording
that may be left out (it may nest), and ``{{name:min-max}}`` stands for so many
words of any kind.  Each template becomes an automaton over words whose states
are numbered; the text between two places is accepted when the mandatory words
stand there exactly and in order.  Of the accepted ends the longest counts, and
a template is looked for again after the end of its last match.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.registry import documents, query
from marquee.llm.words import folded, map_texts

# The phrases and labels of the contract.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wording of the published license notices, with the regions their publishers leave open.
TEMPLATES = [
    ("gpl-3.0", "licensed under [[the terms of]] the gnu general public license [[version]] 3 [[0]]"),
    ("gpl-3.0-or-later",
     "is free software you can redistribute it and or modify it under the terms of the gnu general public license "
     "as published by the free software foundation either version 3 of the license or [[at your option]] any later "
     "version"),
    ("apache-2.0", "licensed under [[the terms of]] the apache license [[version]] 2 0"),
    ("apache-2.0",
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
     "the license you may obtain a copy of the license at [[http www apache org licenses license 2 0]] unless "
     "required by applicable law or agreed to in writing software distributed under the license is distributed on "
     "an as is basis without warranties or conditions of any kind either express or implied see the license for the "
     "specific language governing permissions and limitations under the license"),
    ("mit", "released under [[the terms of]] the mit license"),
    ("mit",
     "permission is hereby granted free of charge to any person obtaining a copy of {{work:1-8}} to deal in "
     "{{work:1-4}} without restriction including without limitation the rights to use copy modify merge publish "
     "distribute sublicense and or sell copies of {{work:1-4}} and to permit persons to whom {{work:1-4}} is "
     "furnished to do so subject to the following conditions the above copyright notice and this permission notice "
     "[[including the next paragraph]] shall be included in all copies or substantial portions of {{work:1-4}} "
     "the software is provided as is without warranty of any kind express or implied including but not limited to the "
     "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall "
     "{{holder:1-8}} be liable for any claim damages or other liability whether in an action of contract tort or "
     "otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("isc",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies the software is "
     "provided as is and {{holder:1-8}} disclaims all warranties with regard to this software including all implied "
     "warranties of merchantability and fitness in no event shall {{holder:1-8}} be liable for any special direct "
     "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in "
     "an action of contract negligence or other tortious action arising out of or in connection with the use or "
     "performance of this software"),
    ("cc-by-4.0", "licensed under [[a]] [[creative commons]] cc by 4 0 [[international]] [[license]]"),
    ("cc-by-nc-4.0", "licensed under [[a]] [[creative commons]] cc by nc 4 0 [[international]] [[license]]"),
    ("cc-by-sa-4.0", "licensed under [[a]] [[creative commons]] cc by sa 4 0 [[international]] [[license]]"),
]

COLUMNS = ("n_words long, base array<struct<label:string,start:long,end:long>>, "
           "matches array<struct<label:string,start:long,end:long,fixed:long>>")


class Automaton(NamedTuple):
    """``steps[s]``: (word or None for any word, next state, whether the word is mandatory wording); ``skips[s]``:
    states reached without a word.  State 0 starts, ``final`` accepts.  ``lead``: the words every match begins with."""

    label: str
    steps: list
    skips: list
    final: int
    lead: tuple

    @classmethod
    def compile(cls, label: str, template: str) -> Automaton:
        steps, skips, open_at, lead, leading = [[]], [[]], [], [], True

        def state() -> int:
            steps.append([])
            skips.append([])
            return len(steps) - 1

        here = 0
        for part in re.findall(r"\[\[|\]\]|\{\{\w+:\d+-\d+\}\}|[^\s\[\]{}]+", template):
            if part == "[[":
                leading = False
                open_at.append(here)
            elif part == "]]":
                if not open_at:
                    raise ValueError(f"{label}: ]] without [[")
                skips[open_at.pop()].append(here)
            elif part.startswith("{{"):
                leading = False
                low, high = map(int, part[:-2].split(":")[1].split("-"))
                optional = []
                for k in range(high):
                    if k >= low:
                        optional.append(here)
                    after = state()
                    steps[here].append((None, after, False))
                    here = after
                for s in optional:
                    skips[s].append(here)
            else:
                after = state()
                steps[here].append((part.encode(), after, not open_at))
                here = after
                if leading:
                    lead.append(part.encode())
        if open_at or not lead:
            raise ValueError(f"{label}: a template begins with mandatory words and closes what it opens")
        return cls(label, steps, skips, here, tuple(lead))

    def _closure(self, states: dict[int, int]) -> dict[int, int]:
        todo = list(states)
        while todo:
            s = todo.pop()
            for t in self.skips[s]:
                if states.get(t, -1) < states[s]:
                    states[t] = states[s]
                    todo.append(t)
        return states

    def accept(self, tokens: list[bytes], start: int) -> tuple[int, int] | None:
        """(end, number of mandatory words) of the longest match from ``start``."""
        now, best, at = self._closure({0: 0}), None, start
        while now:
            if self.final in now:
                best = (at, now[self.final])
            if at == len(tokens):
                break
            word, after = tokens[at], {}
            for s, fixed in now.items():
                for wanted, t, mandatory in self.steps[s]:
                    if wanted is None or wanted == word:
                        after[t] = max(after.get(t, -1), fixed + mandatory)
            now = self._closure(after)
            at += 1
        return best


def places(line: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which the phrase stands in ``line``: words with one blank before, between and after."""
    out, at, seen, word = [], line.find(phrase), 0, 0
    while at >= 0:
        word += line.count(b" ", seen, at)
        out.append(word)
        seen = at
        at = line.find(phrase, at + 1)
    return out


class Scanner:
    """Finds phrases and templates in one text."""

    def __init__(self, phrases: dict[str, str], templates: list[tuple[str, str]]):
        self.phrases = [(b" " + p.encode() + b" ", label, len(p.split())) for p, label in phrases.items()]
        self.automata = [Automaton.compile(*t) for t in templates]
        self.leads = {a.lead: b" " + b" ".join(a.lead) + b" " for a in self.automata}

    def scan(self, text: str | None) -> tuple[int, list, list]:
        tokens = folded(text).split()
        if not tokens:
            return 0, [], []
        line = b" " + b" ".join(tokens) + b" "
        base = [(label, at, at + n) for phrase, label, n in self.phrases for at in places(line, phrase)]
        matches = set()
        for lead, phrase in self.leads.items():
            if phrase not in line:
                continue
            starts = places(line, phrase)
            for automaton in self.automata:
                if automaton.lead != lead:
                    continue
                free = 0
                for start in starts:
                    if start >= free and (found := automaton.accept(tokens, start)):
                        free = found[0]
                        matches.add((automaton.label, start, *found))
        by = lambda m: (m[1], m[0], m[2])
        return len(tokens), sorted(base, key=by), sorted(matches, key=by)


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None,
                  templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, n_words, ``base`` phrase places and template ``matches`` as word spans, one row per input row.

    NULL or empty text: no words, no spans.  NULL and repeated ids keep their
    rows.  A whole text is read once, row-local; there is no shuffle.
    """
    scanner = Scanner(phrases or PHRASES, templates or TEMPLATES)
    return map_texts(docs, lambda: scanner.scan, COLUMNS)


def with_labels(scanned: DataFrame) -> DataFrame:
    """Digest of the spans: counts, first and last phrase, label lists and a score (template 1, phrase alone 0.5)."""
    names = lambda *cols: F.array_join(F.array_sort(F.array_distinct(F.concat(*cols))), ",")
    return scanned.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"),
        names("base.label").alias("base_labels"), names("base.label", "matches.label").alias("labels"),
        F.when(F.size("matches") > 0, 1.0).when(F.size("base") > 0, 0.5).otherwise(0.0).alias("score"), "matches")


def _as_regex(template: str) -> str:
    """The same wording as a regular expression over words with a blank after each; for the SQL check."""
    out = []
    for part in re.findall(r"\[\[|\]\]|\{\{\w+:\d+-\d+\}\}|[^\s\[\]{}]+", template):
        if part == "[[":
            out.append("(")
        elif part == "]]":
            out.append(")?")
        elif part.startswith("{{"):
            low, high = part[:-2].split(":")[1].split("-")
            out.append(f"([^ ]+ ){{{low},{high}}}")
        else:
            out.append(f"{part} ")
    return " " + "".join(out)


def _oracle() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    place, base, method = [], [], []
    for phrase, label in PHRASES.items():
        test = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(phrase.split()))
        place.append(f"list_filter(generate_series(1, len(w)), lambda i: {test})")
        base.append(f"CASE WHEN contains(line, ' {phrase} ') THEN '{label}' END")
    for label, template in TEMPLATES:
        method.append(f"CASE WHEN regexp_matches(line, '{_as_regex(template)}') THEN '{label}' END")
    names = lambda xs: f"array_to_string(list_sort(list_distinct([{', '.join(xs)}])), ',')"
    return f"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), l AS (
  SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS line FROM t
), p AS (
  SELECT *, list_concat({place[0]}, list_concat({place[1]}, list_concat({place[2]}, {place[3]}))) AS found,
         {names(base)} AS base_labels, {names(base + method)} AS labels,
         list_count([{', '.join(method)}]) AS hits
  FROM l
)
SELECT doc_id, len(w)::BIGINT AS n_words, len(found)::BIGINT AS n_base, (list_min(found) - 1)::BIGINT AS first_word,
       (list_max(found) - 1)::BIGINT AS last_word, base_labels, labels,
       CASE WHEN hits > 0 THEN 1.0 WHEN len(found) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM p"""


@query("op3_license_templates", _oracle())
def op3(spark, sf):
    """License phrases and template matches of every whole document."""
    return with_labels(scan_licenses(documents(spark, sf))).drop("matches")
