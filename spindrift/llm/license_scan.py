"""License scans by template markup.

A template is license wording with two kinds of regions: `<<optional>> ... <</optional>>` may be missing,
and `<<any min max>>` stands for min to max words of any kind (names, years, titles). A template is
compiled once into a token automaton; a text holds the license if the automaton accepts words standing
consecutively somewhere in it, that is if all mandatory wording is there exactly and in order. Beside the
templates there are fixed base phrases, found wherever their words stand consecutively.

Words are runs of letters and digits, A-Z lower-cased, so punctuation and layout do not matter. An
automaton runs only from places where its first mandatory words stand, and holds a set of states, so the
work per place is bounded by the template's length, whatever the text.

Results for odd input: null, empty or wordless text has no words, places or labels and a null first and
last word; null doc_ids and repeated rows keep their rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}

#: Fixed base phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

_WARRANTY = """the software is provided as is without warranty of any kind express or implied including but not limited to the
warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be
liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection
with the software or the use or other dealings in the software"""
_BSD_HEAD = """redistribution and use in source and binary forms with or without modification are permitted provided that the following
conditions are met <<optional>> 1 <</optional>> redistributions of source code must retain the above copyright notice this list of
conditions and the following disclaimer <<optional>> 2 <</optional>> redistributions in binary form must reproduce the above copyright
notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"""
_BSD_TAIL = """this software is provided by <<any 1 12>> as is and any express or implied warranties including but not limited to the
implied warranties of merchantability and fitness for a particular purpose are disclaimed"""

#: Fixed templates: public license texts and the notices by which they are applied.
TEMPLATES = (
    ("mit", f"""permission is hereby granted free of charge to any person obtaining a copy of this software and associated
documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify
merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so
subject to the following conditions the above copyright notice and this permission notice <<optional>> including the next paragraph
<</optional>> shall be included in all copies or substantial portions of the software <<optional>> {_WARRANTY} <</optional>>"""),
    ("mit", "<<optional>> is <</optional>> <<optional>> are <</optional>> released under the <<optional>> terms of the <</optional>> mit license"),
    ("mit", "licensed under the <<optional>> terms of the <</optional>> mit license"),
    ("mit", "distributed under the <<optional>> terms of the <</optional>> mit license"),
    ("isc", """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
provided that the above copyright notice and this permission notice appear in all copies"""),
    ("bsd-2-clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    ("bsd-3-clause", f"""{_BSD_HEAD} <<optional>> 3 <</optional>> neither the name of <<any 1 12>> nor the names of its contributors may
be used to endorse or promote products derived from this software without specific prior written permission {_BSD_TAIL}"""),
    ("apache-2", """licensed under the apache license version 2 0 <<optional>> the license you may not use this file except in
compliance with the license you may obtain a copy of the license at <</optional>>"""),
    ("apache-2", "<<any 0 3>> apache license version 2 0 january 2004"),
    ("gpl-2", """is free software you can redistribute it and or modify it under the terms of the gnu general public license as published
by the free software foundation <<optional>> either <</optional>> version 2"""),
    ("gpl-3", """is free software you can redistribute it and or modify it under the terms of the gnu general public license as published
by the free software foundation <<optional>> either <</optional>> version 3"""),
    ("gpl-2", "licensed under the <<optional>> terms of the <</optional>> gnu general public license <<optional>> gpl <</optional>> <<any 0 1>> version 2"),
    ("gpl-3", "licensed under the <<optional>> terms of the <</optional>> gnu general public license <<optional>> gpl <</optional>> <<any 0 1>> version 3"),
    ("lgpl-3", "licensed under the <<optional>> terms of the <</optional>> gnu lesser general public license <<any 0 1>> version 3"),
    ("agpl-3", "licensed under the <<optional>> terms of the <</optional>> gnu affero general public license <<any 0 1>> version 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any
damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial
applications and to alter it and redistribute it freely subject to the following restrictions"""),
    ("cc0", "cc0 1 0 universal"),
    ("cc-by", "licensed under <<optional>> a <</optional>> creative commons attribution <<any 0 1>> <<optional>> international <</optional>> license"),
    ("cc-by", "licensed under <<optional>> a <</optional>> cc by <<optional>> 4 0 <</optional>> <<optional>> 3 0 <</optional>> license"),
    ("cc-by-sa", "licensed under <<optional>> a <</optional>> cc by sa"),
    ("cc-by-nc", "licensed under <<optional>> a <</optional>> cc by nc <<optional>> 4 0 <</optional>>"),
    ("cc-by-nc", "licensed under <<optional>> a <</optional>> creative commons attribution noncommercial"),
)


class Automaton:
    """States 0..n over a template's words: step[i] is the word out of i to i + 1 (None: any), jump[i] the states that i reaches free."""

    def __init__(self, template: str):
        self.step: list[str | None] = []
        free: list[tuple[int, int]] = []
        opened: list[int] = []
        for piece in re.findall(r"<<.*?>>|[^\s<>]+", template):
            if piece == "<<optional>>":
                opened.append(len(self.step))
            elif piece == "<</optional>>":
                free.append((opened.pop(), len(self.step)))
            elif piece.startswith("<<any"):
                least, most = map(int, piece[5:-2].split())
                self.step += [None] * most
                free += [(len(self.step) - k, len(self.step)) for k in range(1, most - least + 1)]
            else:
                self.step.append(piece)
        self.end = len(self.step)
        self.jump = [{i} for i in range(self.end + 1)]
        for _ in range(len(free) + 1):
            for a, b in free:
                for s in self.jump:
                    if a in s:
                        s |= self.jump[b]
        #: The first run of mandatory words, and how many words may stand before it.
        inside = {i for a, b in free for i in range(a, b)}
        first = next(i for i in range(self.end) if i not in inside and self.step[i] is not None)
        last = first
        while last < self.end and last not in inside and self.step[last] is not None and last - first < 4:
            last += 1
        self.anchor, self.lead = tuple(self.step[first:last]), first

    def longest(self, words: list[str], at: int) -> int:
        """The end of the longest accepted run of words from `at`, or -1."""
        states, best, step, jump = set(self.jump[0]), -1, self.step, self.jump
        while states:
            if self.end in states:
                best = at
            if at >= len(words):
                break
            w, nxt = words[at], set()
            for s in states:
                if s < self.end and (step[s] is None or step[s] == w):
                    nxt |= jump[s + 1]
            states, at = nxt, at + 1
        return best


class Scanner:
    """All templates and base phrases, found by the first word of each."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, base: tuple[tuple[str, str], ...] = BASE):
        self.automata = [(label, Automaton(t)) for label, t in templates]
        self.base = [(tuple(p.split()), label) for p, label in base]
        self.by_word: dict[str, list[tuple[str, Automaton]]] = {}
        for label, a in self.automata:
            self.by_word.setdefault(a.anchor[0], []).append((label, a))
        self.base_by_word: dict[str, list[tuple[tuple[str, ...], str]]] = {}
        for p, label in self.base:
            self.base_by_word.setdefault(p[0], []).append((p, label))
        #: No phrase or template can match a text that lacks all of these.
        self.quick = re.compile("|".join(sorted({re.escape(max(a.anchor, key=len)) for _, a in self.automata} | {re.escape(max(p, key=len)) for p, _ in self.base})))

    def scan(self, words: list[str]) -> tuple[list[tuple[int, str]], list[tuple[int, int, str]]]:
        """(base places: start and label; template spans: start, end, label) in `words`."""
        places, spans = [], []
        starts = self.by_word.keys() | self.base_by_word.keys()
        for i, w in enumerate(words):
            if w not in starts:
                continue
            for p, label in self.base_by_word.get(w, ()):
                if tuple(words[i : i + len(p)]) == p:
                    places.append((i, label))
            for label, a in self.by_word.get(w, ()):
                if tuple(words[i : i + len(a.anchor)]) == a.anchor:
                    for at in range(max(0, i - a.lead), i + 1):
                        if (end := a.longest(words, at)) > i:
                            spans.append((at, end, label))
                            break
        return places, spans


def report(text: str | None, scanner: Scanner) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text.

    score: 1 if a template accepts, else 0.5 if a base phrase stands there, else 0.
    """
    low = (text or "").translate(LOWER)
    words = WORD.findall(low)
    if not scanner.quick.search(low):
        return len(words), 0, None, None, "", "", 0.0
    places, spans = scanner.scan(words)
    base = sorted({label for _, label in places})
    more = sorted({*base, *(label for _, _, label in spans)})
    first, last = (min(i for i, _ in places), max(i for i, _ in places)) if places else (None, None)
    return len(words), len(places), first, last, ",".join(base), ",".join(more), 1.0 if spans else 0.5 if places else 0.0


def license_report(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """One row per row of `docs` (doc_id, text), as `report` gives it."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates)
        for b in batches:
            out = pd.DataFrame([report(t, scanner) for t in b["text"]], columns=names)
            for c in ("first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            yield pd.concat([b[["doc_id"]].reset_index(drop=True), out], axis=1)

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")


def license_spans(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(doc_id, label, start, end): the words that templates accept, one row per span."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates)
        for b in batches:
            rows = []
            for i, t in zip(b["doc_id"], b["text"]):
                low = (t or "").translate(LOWER)
                if scanner.quick.search(low):
                    rows += [(i, label, a, e) for a, e, label in scanner.scan(WORD.findall(low))[1]]
            yield pd.DataFrame(rows, columns=["doc_id", "label", "start", "end"])

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, label string, start bigint, end bigint")
