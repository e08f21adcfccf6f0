"""Licence detection with a generalised suffix automaton of licence texts.

The templates are whole licence texts (``licences/*.txt``, named by their label)
and the notice lines that name a licence.  All templates and the base phrases
are put into one automaton over words.  A file's words are streamed through it once, which gives the matching
statistics: at every word the longest stretch, ending there, that stands in
some template.  Stretches of ``MIN_MATCH`` words or more that cannot be
extended are chained, template by template, from every place where they end in
it, as long as both the file and the template move forward by at most
``MAX_GAP`` words; a chain is a span of the file that covers a share of the
template.  A share of ``MIN_SHARE`` or ``MIN_COVER`` covered words give the
template's label, unless a span around it covers more: licences share passages.

The base phrases come out of the same pass: a phrase ends at a word if its
state is on the suffix-link path of the state reached there.

The automaton is small and fixed by the templates; the files are read in one
pass without a shuffle.  Defined results: a null text is empty; without base
places first_word and last_word are null and the labels are empty strings;
every row is judged by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from importlib import resources

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from strata.llm.text import alnum_words

MIN_MATCH, MAX_GAP, MIN_SHARE, MIN_COVER = 4, 6, 0.6, 16
#: Base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Opening or notice lines of well-known licences, as the licences recommend them.
TEMPLATES = [
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
             "general public license as published by the free software foundation"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the "
                   "license at http www apache org licenses license 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by-nc-nd", "licensed under cc by nc nd 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def whole_texts() -> list[tuple[str, str]]:
    """The licence texts that lie beside this module, with their labels; read on the driver only."""
    found = [f for f in (resources.files("strata.llm") / "licences").iterdir() if f.name.endswith(".txt")]
    return [(f.name[:-len(".txt")], f.read_text(encoding="utf-8")) for f in sorted(found, key=lambda f: f.name)]


class Automaton:
    """Generalised suffix automaton: the states of all word sequences inside the templates."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.words: dict[bytes, int] = {}
        self.next, self.link, self.length = [{}], [-1], [0]
        self.ends: list[dict[int, list[int]]] = [{}]  # by state: all places where it ends, by template
        self.templates = [(label, [self._id(w) for w in alnum_words(text)]) for label, text in templates]
        sequences = [ids for _, ids in self.templates] + [[self._id(w) for w in alnum_words(p)] for p in phrases]
        for which, ids in enumerate(sequences):
            last = 0
            for at, word in enumerate(ids):
                last = self._extend(last, word)
                if which < len(self.templates):
                    self.ends[last].setdefault(which, []).append(at)
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True)
        for state in order:  # what ends with a longer sequence ends with its suffix too
            if self.length[self.link[state]] < MIN_MATCH:
                continue
            for which, places in self.ends[state].items():
                self.ends[self.link[state]].setdefault(which, []).extend(places)
        self.phrases = [(len(ids), label, self._state(ids)) for ids, label in
                        zip(sequences[len(self.templates):], phrases.values())]
        self.heard: list[list[int]] = [[] for _ in self.next]  # phrases on the suffix-link path
        for state in reversed(order):
            own = [k for k, (_, _, home) in enumerate(self.phrases) if home == state]
            self.heard[state] = own + self.heard[self.link[state]]

    def _id(self, word: bytes) -> int:
        return self.words.setdefault(word, len(self.words))

    def _new(self, length: int, after: dict, link: int) -> int:
        self.next.append(after)
        self.length.append(length)
        self.link.append(link)
        self.ends.append({})
        return len(self.next) - 1

    def _split(self, source: int, word: int, target: int) -> int:
        """The state for ``source`` followed by ``word``, taken out of ``target`` if that holds longer sequences."""
        if self.length[target] == self.length[source] + 1:
            return target
        copy = self._new(self.length[source] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while source >= 0 and self.next[source].get(word) == target:
            self.next[source][word] = copy
            source = self.link[source]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        state = self._new(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._split(at, word, self.next[at][word])
        return state

    def _state(self, ids: list[int]) -> int:
        state = 0
        for word in ids:
            state = self.next[state][word]
        return state

    def statistics(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(place, length of the longest stretch ending there, its state), where that length is above 0."""
        get, after, link, length = self.words.get, self.next, self.link, self.length
        state = size = 0
        for at, word in enumerate(map(get, words)):
            if word is None:
                state = size = 0
                continue
            while state and word not in after[state]:
                state = link[state]
                size = length[state]
            if word in after[state]:
                state = after[state][word]
                size += 1
                yield at, size, state

    def scan(self, text) -> tuple:
        """(n_words, base places as (start, label), spans as (label, first, last, covered, share))."""
        words = alnum_words(text)
        base, stretches, before = [], [], None
        for at, size, state in self.statistics(words):
            for k in self.heard[state]:
                if self.phrases[k][0] <= size:
                    base.append((at - self.phrases[k][0] + 1, self.phrases[k][1]))
            if before and (at, size) != (before[0] + 1, before[1] + 1) and before[1] >= MIN_MATCH:
                stretches.append(before)
            before = (at, size, state)
        if before and before[1] >= MIN_MATCH:
            stretches.append(before)
        return len(words), base, self._chains(stretches)

    def _matches(self, size: int, state: int) -> Iterator[tuple[int, int, list[int]]]:
        """(template, length, end places) of the longest match in each template that ends with the stretch."""
        seen = set()
        while size >= MIN_MATCH:
            for which, places in self.ends[state].items():
                if which not in seen:
                    seen.add(which)
                    yield which, size, places
            state = self.link[state]
            size = self.length[state]

    def _chains(self, stretches: list[tuple[int, int, int]]) -> list[tuple]:
        open_: dict[int, dict[int, tuple]] = {}  # by template and the place reached there: first, last, covered
        done = []
        for at, longest, state in stretches:
            for which, size, places in self._matches(longest, state):
                start, chains = at - size + 1, open_.setdefault(which, {})
                for end in [e for e, c in chains.items() if start - c[1] - 1 > MAX_GAP]:
                    done.append((which, chains.pop(end)))
                grown = {}
                for end in places:
                    best = (start, at, size)
                    for before, (first, last, cover) in chains.items():
                        if before < end and end - size - before <= MAX_GAP and abs(end - before - at + last) <= MAX_GAP:
                            more = cover + min(at - last, end - before, size)
                            if more > best[2]:
                                best = (first, at, more)
                    grown[end] = best
                done += [(which, chains[end]) for end in grown.keys() & chains.keys()]
                chains.update(grown)
        done += [(which, chain) for which, chains in open_.items() for chain in chains.values()]
        spans = []
        for which, (first, last, cover) in done:
            label, ids = self.templates[which]
            share = min(1.0, cover / len(ids))
            if share >= MIN_SHARE or cover >= MIN_COVER:
                spans.append((label, first, last, cover, share))
        return self._widest(spans)

    @staticmethod
    def _widest(spans: list[tuple]) -> list[tuple]:
        """The spans that do not lie in one that covers more; a passage that licences share word for word gives each label."""
        kept, around = [], []
        for span in sorted(set(spans), key=lambda s: (s[1], -s[2], -s[3], -s[4], s[0])):
            label, first, last, cover, _ = span
            around = [s for s in around if s[2] >= first]
            if not any(s[2] >= last and (s[3] > cover or s[0] == label and s[3] >= cover) for s in around):
                kept.append(span)
                around.append(span)
        return sorted(kept, key=lambda s: (s[1], s[2], s[0]))


SCHEMA = ("struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,labels:string,"
          "score:double,spans:array<struct<label:string,first:bigint,last:bigint,covered:bigint,share:double>>>")


def scan(docs: DataFrame, templates=None, phrases=None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: words, base places and labels, all labels, the best share of a template, the spans."""
    shared = docs.sparkSession.sparkContext.broadcast(
        Automaton(TEMPLATES + whole_texts() if templates is None else templates, PHRASES if phrases is None else phrases))

    def row(value) -> tuple:
        n, base, spans = shared.value.scan(value)
        starts, labels = [s for s, _ in base], {label for _, label in base}
        return (n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
                ",".join(sorted(labels | {s[0] for s in spans})), max((s[4] for s in spans), default=0.0),
                [dict(zip(("label", "first", "last", "covered", "share"), s)) for s in spans])

    @F.pandas_udf(SCHEMA)
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for texts in batches:
            found = pd.DataFrame([row(t) for t in texts], columns=names)
            yield found.astype({"first_word": "Int64", "last_word": "Int64"})
    return docs.select(id_col, look(F.col(text)).alias("found")).select(id_col, "found.*")
