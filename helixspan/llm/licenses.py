"""Licence scan with a generalised suffix automaton over the words of templates.

The automaton holds every run of words of every template. Streaming a file through it
gives, at each word, the longest run ending there that some template contains. Maximal
runs of at least ``MIN_RUN`` words are chained per template in the order of both sides;
a template is reported where the chained runs cover enough of it. Short phrases are
templates that must be covered whole.

Defined cases: a null text is an empty one; without words all counts are 0, places null
and labels empty; repeated rows are scanned each; very long texts need memory in
proportion to their own length only.
"""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import DataFrame

from helixspan.llm.texts import per_text, pick

#: Bytes that belong to words, after A-Z became lower case: digits, a-z, all non-ASCII.
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Phrases that name a licence, each with its label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Opening passages of public licences, by label.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files the software to deal in the software without "
    "restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software",
    "apache-2": "licensed under the apache license version 2 0 the license you may not use this "
    "file except in compliance with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms "
    "of the gnu general public license as published by the free software foundation",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0 if "
    "a copy of the mpl was not distributed with this file you can obtain one at",
    "cc-by-nc": "you are free to share copy and redistribute the material in any medium or format "
    "you may not use the material for commercial purposes",
}
#: Shortest run that is chained, widest gap between chained runs in words, least cover.
MIN_RUN, MAX_GAP, MIN_COVER = 4, 20, 0.6


class Automaton:
    """Suffix automaton of several word sequences; words are small integers."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self.extend(last, word)
                self.ends[last].add((number, at + 1))
        # A state's runs also end where those of the states linking to it end.
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[state]] |= self.ends[state]

    def add(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def split(self, state: int, word: int, target: int) -> int:
        """The runs of ``target`` that also follow ``state`` become a state of their own."""
        twin = self.add(self.length[state] + 1, dict(self.next[target]), self.link[target])
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = twin
            state = self.link[state]
        self.link[target] = twin
        return twin

    def extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            whole = self.length[known] == self.length[last] + 1
            return known if whole else self.split(last, word, known)
        state, at = self.add(self.length[last] + 1, {}, 0), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            target = self.next[at][word]
            whole = self.length[target] == self.length[at] + 1
            self.link[state] = target if whole else self.split(at, word, target)
        return state

    def statistics(self, words: list[int | None]):
        """(position after the word, state, length of the longest known run ending there)."""
        state = length = 0
        follow, link, size = self.next, self.link, self.length
        for at, word in enumerate(words, 1):
            if word is None:
                state = length = 0
                continue
            while state and word not in follow[state]:
                state = link[state]
                length = size[state]
            if word in follow[state]:
                state = follow[state][word]
                length += 1
                yield at, state, length
            else:
                length = 0


class Scanner:
    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        texts = [*phrases.items(), *((text, label) for label, text in templates.items())]
        self.labels = [label for _, label in texts]
        self.n_phrases = len(phrases)
        split = [WORDS.findall(text.encode().lower()) for text, _ in texts]
        self.vocabulary: dict[bytes, int] = {}
        for word in (w for words in split for w in words):
            self.vocabulary.setdefault(word, len(self.vocabulary))
        coded = [[self.vocabulary[w] for w in words] for words in split]
        self.sizes = [len(words) for words in coded]
        self.automaton = Automaton(coded)
        self.whole = self.phrases_of_states()
        self.short = min(self.sizes[: self.n_phrases], default=1)

    def phrases_of_states(self) -> list[list[int]]:
        """Phrases that the longest run of a state ends with.

        A phrase belongs to the state that holds its whole run, and to all states whose
        links lead there: their runs are longer and end with it.
        """
        size, link = self.automaton.length, self.automaton.link
        whole: list[list[int]] = [[] for _ in size]
        for state in sorted(range(1, len(size)), key=size.__getitem__):
            own = [
                n
                for n, end in self.automaton.ends[state]
                if n < self.n_phrases and end == self.sizes[n] and size[link[state]] < end <= size[state]
            ]
            whole[state] = own + whole[link[state]]
        return whole

    def scan(self, text: str | None) -> tuple:
        words = WORDS.findall((text or "").encode().lower())
        places: list[tuple[int, int]] = []
        runs: list[tuple[int, int, int]] = []
        before = (0, 0, 0)
        for at, state, length in self.automaton.statistics(list(map(self.vocabulary.get, words))):
            if length >= self.short and self.whole[state]:
                places += [
                    (at - self.sizes[n], n) for n in self.whole[state] if self.sizes[n] <= length
                ]
            if before[2] >= MIN_RUN and (at != before[0] + 1 or length != before[2] + 1):
                runs.append(before)
            before = (at, state, length)
        if before[2] >= MIN_RUN:
            runs.append(before)
        covers = self.covers(runs)
        base = {self.labels[n] for _, n in places}
        found = base | {self.labels[n] for n, share in covers.items() if share[0] >= MIN_COVER}
        score = 1.0 if base else max((share[0] for share in covers.values()), default=0.0)
        starts = [start for start, _ in places]
        spans = [
            (self.labels[n], first, last, share)
            for n, (share, first, last) in sorted(covers.items())
            if share >= MIN_COVER
        ]
        return (
            len(words),
            len(places),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(found)),
            score,
            [f"{label}:{first}:{last}" for label, first, last, _ in spans],
        )

    def covers(self, runs: list[tuple[int, int, int]]) -> dict[int, tuple[float, int, int]]:
        """Per template the best chain of runs: (share covered, first word, word after the last)."""
        pieces = defaultdict(list)
        for at, state, length in runs:
            for number, end in self.automaton.ends[state]:
                if number >= self.n_phrases:
                    pieces[number].append((at - length, at, max(0, end - length), end))
        best = {}
        for number, found in pieces.items():
            found.sort()
            open_chains: list[tuple[int, int, int, int]] = []  # end here, end there, covered, start
            top = (0, 0, 0)
            for start, stop, t_start, t_stop in found:
                open_chains = [c for c in open_chains if start - c[0] <= MAX_GAP]
                chain = (t_stop - t_start, start)
                for stop0, t_stop0, covered, start0 in open_chains:
                    lap = max(0, stop0 - start, t_stop0 - t_start)
                    gain = t_stop - t_start - lap
                    if stop > stop0 and t_stop > t_stop0 and gain > 0:
                        chain = max(chain, (covered + gain, start0))
                open_chains.append((stop, t_stop, *chain))
                top = max(top, (chain[0], chain[1], stop))
            best[number] = (min(1.0, top[0] / self.sizes[number]), top[1], top[2])
        return best


def scan_licenses(docs: DataFrame, phrases=None, templates=None) -> DataFrame:
    """Per document its licence phrases, labels and the covered spans of templates.

    The templates are parameters of a few kB and travel with the tasks.
    """
    scanned = per_text(
        lambda: scan_all(Scanner(phrases or PHRASES, templates or TEMPLATES)),
        "n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double, template_spans array<string>",
    )
    return pick(docs, "doc_id", "text").select("doc_id", scanned("text").alias("s")).select(
        "doc_id", "s.*"
    )


def scan_all(scanner: Scanner):
    return lambda texts: [scanner.scan(text) for text in texts]
