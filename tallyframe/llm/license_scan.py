"""License scans: templates with optional and replaceable regions, compiled into token automata.

A template is license wording with public template markup: ``<<beginOptional>> ... <<endOptional>>`` may be missing, and
``<<var;name="who";match="[a-z]+";words="20">>`` stands for up to ``words`` words that each match ``match`` in full (any, if not given).
All other wording is mandatory and must match word by word. Templates are compiled to automata over words; their deterministic
states are made when a text first needs them. A text can contain any number of matches; one template's leftmost start with its
longest end is a match, and the search goes on behind it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.shared import byte_texts, over_batches, picked

# Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Public license wording, in template markup.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and <<beginOptional>>to any <<endOptional>>associated documentation files "
            "<<beginOptional>>(the \"Software\")<<endOptional>>, to deal in the <<var;name=\"what\";words=\"2\">> without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the <<var;name=\"what\";words=\"2\">>"),
    ("mit", "<<beginOptional>>Licensed <<endOptional>>under the <<beginOptional>>terms of the <<endOptional>>MIT <<beginOptional>>open source <<endOptional>>license"),
    ("isc", "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
            "notice and this permission notice appear in all copies"),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<beginOptional>>1. <<endOptional>>"
                     "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2. <<endOptional>>Redistributions in binary "
                     "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd-3-clause", "<<beginOptional>>3. <<endOptional>>Neither the name of <<var;name=\"holder\";words=\"20\">> nor the names of its contributors may be used to endorse or promote products derived from this "
                     "software without specific prior written permission"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 <<beginOptional>>(the \"License\")<<endOptional>>"),
    ("apache-2", "Apache <<beginOptional>>Software <<endOptional>>License <<var;name=\"version\";match=\"version|v\";words=\"1\">> 2"),
    ("gpl-3", "<<beginOptional>>licensed under the <<endOptional>>GNU General Public License<<beginOptional>> as published by the Free Software Foundation<<endOptional>>, "
              "<<beginOptional>>either <<endOptional>>version 3"),
    ("gpl-2", "<<beginOptional>>licensed under the <<endOptional>>GNU General Public License<<beginOptional>> as published by the Free Software Foundation<<endOptional>>, "
              "<<beginOptional>>either <<endOptional>>version 2"),
    ("lgpl", "GNU Lesser General Public License <<beginOptional>>as published by the Free Software Foundation<<endOptional>>"),
    ("lgpl", "GNU Library General Public License <<beginOptional>>as published by the Free Software Foundation<<endOptional>>"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "Creative Commons Attribution<<beginOptional>>-<<endOptional>>NonCommercial <<var;name=\"variant\";match=\"sharealike|noderivatives|noderivs\";words=\"1\">> "
                 "<<var;name=\"version\";match=\"[0-9]\";words=\"2\">> <<beginOptional>>International <<endOptional>>License"),
    ("cc-by-sa", "Creative Commons Attribution ShareAlike <<var;name=\"version\";match=\"[0-9]\";words=\"2\">> <<beginOptional>>International <<endOptional>>License"),
    ("cc-by", "Creative Commons Attribution <<var;name=\"version\";match=\"[0-9]\";words=\"2\">> <<beginOptional>>International <<endOptional>>License"),
    ("cc0", "<<beginOptional>>Creative Commons <<endOptional>>CC0 1.0 Universal"),
]

# Bytes of words (digits, lower-case letters, everything beyond ASCII) stay, capitals become lower case, all else separates words.
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_MARKUP = re.compile(r"<<(.*?)>>", re.S)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


@dataclass
class Automaton:
    """Words' automaton of one template. ``anchor``: the first mandatory words; ``lead``: the most words that can stand before them."""

    label: str
    template: str
    edges: list[dict[bytes, list[int]]] = field(default_factory=lambda: [{}])
    loose: list[list[tuple[re.Pattern, int]]] = field(default_factory=lambda: [[]])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    depth: list[int] = field(default_factory=lambda: [0])
    anchor: bytes = b""
    lead: int = 0
    mandatory: int = 0

    def __post_init__(self):
        at, optional, run, anchored = 0, [], [], False
        parts = _MARKUP.split(self.template)
        for i, part in enumerate(parts):
            if i % 2 == 0:
                for word in words_of(part.encode()):
                    self.mandatory += not optional
                    to = self._state(self.depth[at] + (not optional))
                    self.edges[at].setdefault(word, []).append(to)
                    at = to
                    if not optional and not anchored:
                        run.append(word)
                        anchored = len(run) == 4
                    elif not anchored and not run:
                        self.lead += 1
            else:
                anchored = anchored or bool(run)
                if part == "beginOptional":
                    optional.append(at)
                elif part == "endOptional":
                    self.free[optional.pop()].append(at)
                elif part.startswith("var"):
                    given = dict(re.findall(r'(\w+)="([^"]*)"', part))
                    most = int(given.get("words", 20))
                    end, pattern = self._state(self.depth[at]), re.compile(given.get("match", ".*").encode(), re.S)
                    for _ in range(most):
                        to = self._state(self.depth[at])
                        self.loose[at].append((pattern, to))
                        self.free[at].append(end)
                        at = to
                    self.free[at].append(end)
                    at = end
                    self.lead += 0 if run else most
                else:
                    raise ValueError(f"unknown markup <<{part}>>")
        if optional or not run:
            raise ValueError("a template needs mandatory words and closed regions")
        self.anchor, self.last = b" " + b" ".join(run) + b" ", at
        self.start = self._closed({0})
        self.known: dict[frozenset, dict[bytes, frozenset]] = {}

    def _state(self, depth: int) -> int:
        self.edges.append({}), self.loose.append([]), self.free.append([]), self.depth.append(depth)
        return len(self.edges) - 1

    def _closed(self, states: set[int]) -> frozenset:
        todo = list(states)
        while todo:
            for to in self.free[todo.pop()]:
                if to not in states:
                    states.add(to)
                    todo.append(to)
        return frozenset(states)

    def step(self, states: frozenset, word: bytes) -> frozenset:
        moves = self.known.setdefault(states, {})
        if word not in moves:
            if len(moves) > 1000:
                moves.clear()
            moves[word] = self._closed({to for s in states for to in self.edges[s].get(word, ())} | {to for s in states for pattern, to in self.loose[s] if pattern.fullmatch(word)})
        return moves[word]

    def longest(self, words: list[bytes], start: int) -> tuple[int, float]:
        """(end of the longest match from ``start`` or -1, share of the mandatory words passed)."""
        states, end, deepest = self.start, -1, 0
        for at in range(start, len(words)):
            states = self.step(states, words[at])
            if not states:
                break
            deepest = max(deepest, max(self.depth[s] for s in states))
            if self.last in states:
                end = at + 1
        return end, 1.0 if end >= 0 else deepest / self.mandatory

    def matches(self, words: list[bytes], line: bytes) -> tuple[list[tuple[int, int]], float]:
        """All matches as (start, end), and the largest share passed; ``line`` is the words with single spaces, at both ends too."""
        found, best, behind, counted, at, pos = [], 0.0, 0, 0, 0, line.find(self.anchor)
        while pos >= 0:
            at += line.count(b" ", counted, pos)
            counted = pos
            for start in range(max(behind, at - self.lead), at + 1):
                end, share = self.longest(words, start)
                best = max(best, share)
                if end >= 0:
                    found.append((start, end))
                    behind = end
                    break
            pos = line.find(self.anchor, pos + 1)
        return found, best


def places(line: bytes, phrase: bytes) -> list[int]:
    """Starts, in words, of all places of a phrase."""
    found, pos, counted, words = [], line.find(phrase), 0, 0
    while pos >= 0:
        words += line.count(b" ", counted, pos)
        counted = pos
        found.append(words)
        pos = line.find(phrase, pos + 1)
    return found


def license_scan(docs: DataFrame, templates=None, phrases: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licenses named or quoted in every text.

    Result: doc_id, n_words, base (array of {label, start}: all places of the phrases), found (array of {label, start, end}: matches of
    the templates), score (1 if anything was found, else the largest share of a template's mandatory words that stand in a row, and 0
    if not even its first words do). Positions count words. Null and empty texts have no words; repeated rows are scanned each; an
    empty table gives an empty result; other columns are ignored.
    """
    automata = [Automaton(label, text) for label, text in (TEMPLATES if templates is None else templates)]
    wanted = [(b" " + b" ".join(words_of(phrase.encode())) + b" ", label) for phrase, label in (PHRASES if phrases is None else phrases).items()]
    spot, span = pa.struct([("label", pa.string()), ("start", pa.int64())]), pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, base, found, scores = [], [], [], []
        for text in byte_texts(batch, "text"):
            words = words_of(text)
            line = b" " + b" ".join(words) + b" "
            spots = [{"label": label, "start": start} for phrase, label in wanted for start in places(line, phrase)]
            spans, best = [], 1.0 if spots else 0.0
            for automaton in automata:
                if automaton.anchor in line:
                    matches, share = automaton.matches(words, line)
                    spans += [{"label": automaton.label, "start": start, "end": end} for start, end in matches]
                    best = max(best, share)
            counts.append(len(words)), base.append(spots), found.append(spans), scores.append(best)
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(base, pa.list_(spot)), pa.array(found, pa.list_(span)),
                                           pa.array(scores, pa.float64())], names=["doc_id", "n_words", "base", "found", "score"])

    schema = "doc_id long, n_words long, base array<struct<label:string,start:long>>, found array<struct<label:string,start:long,end:long>>, score double"
    return over_batches(picked(docs, doc_id=id_col, text=text_col), work, schema)


def summary(scanned: DataFrame) -> DataFrame:
    """One line per document: counts, first and last place of the phrases, labels sorted and comma-joined."""
    def labels(*arrays):
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*arrays))), ",")

    return scanned.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"),
                          labels("base.label").alias("base_labels"), labels("base.label", "found.label").alias("labels"), "score")
