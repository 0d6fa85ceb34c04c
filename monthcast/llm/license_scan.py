"""License scans (operator 1): a generalised suffix automaton of licence tokens.

The licence templates (a fixed, small parameter) are turned into one
generalised suffix automaton over word ids. Each text is streamed through it,
which gives its matching statistics: at every word, the longest run of words
ending there that stands in some template. Each template's own maximal runs of
at least ``min_match`` words are chained, in order in both texts and with
gaps of at most ``max_gap`` words, into covered spans; a span that covers
``min_cover`` of its template adds the template's label if the template's
telling words, if it has any, stand in the span or within ``max_gap`` words
after it. ``score`` is the best cover, with or without them. Base phrases are
further strings of the same automaton: they end wherever the state reached
has the phrase among its suffixes.

A narrow job: each row's result depends on that row alone, so it needs no
shuffle and no memory beyond a block of texts.

Null or empty text: no words, no labels, score 0. Repeated rows give repeated
results; a null doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .automaton import SuffixAutomaton
from .common import LOWER_ALNUM, batches, words_of

# The contract's base phrases, in the order phrase, label.
BASE_PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

# Opening or identifying sentences of public licences (label, words).
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the "
                   "license at http www apache org licenses license 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc", "this work is licensed under a creative commons attribution license"),
    ("warranty", "the software is provided as is without warranty of any kind express or implied"),
]

# What tells a label's licence from others with the same words (label, a word of the templates
# meant, pattern over words at single spaces). Of versions, the first number counts.
TELLING = [
    ("apache-2.0", "licensed", r"apache license\D*\b(version 2|v2|2 0)\b"),
    ("apache-2.0", "apache", r"\bapache (org|license)\b\D*\b(license|version|v) ?2\b|\bapache license\D*\b2 0\b"),
    ("gpl-3.0", "3", r"general public license\D*\bv?3\b"),
    ("gpl", "gnu", r"\bgnu general public license\b"),
    ("lgpl", "lesser", r"\b(lesser|lgpl|lgplv[23])\b"),
    ("agpl", "affero", r"\b(affero|agpl|agplv3)\b"),
    ("mpl-2.0", "mozilla", r"\bmozilla public license\D*\bv?2\b"),
    ("cc-by-nc", "nc", r"\bby nc\b"),
    ("cc-by-sa", "sa", r"\b(by|nc) sa\b"),
    ("cc", "creative", r"\bcreative commons\b"),
]

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, spans array<struct<label:string,start:int,end:int,cover:double>>")
_SPAN = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                            ("cover", pa.float64())]))


class LicenceAutomaton(SuffixAutomaton):
    """A suffix automaton of templates and phrases over word ids, with for each
    state the places in templates where its strings end and the phrases among
    its suffixes."""

    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]):
        super().__init__()
        self.templates = [(label, words.split()) for label, words in templates]
        self.phrases = [(phrase.split(), label) for phrase, label in phrases]
        if any(len(p) < 2 for p, _ in self.phrases):
            raise ValueError("a phrase needs two words at least")
        strings = [w for _, w in self.templates] + [p for p, _ in self.phrases]
        vocabulary = sorted({w for s in strings for w in s})
        self.ids = {w: i for i, w in enumerate(vocabulary)}
        self.strings = [[self.ids[w] for w in s] for s in strings]
        for s in self.strings:
            for _ in self.add(s):
                pass
        # places and phrases by walking each string once more: states no longer change
        ends: list[set[tuple[int, int]]] = [set() for _ in self.next]
        stop: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for t, s in enumerate(strings):
            v = 0
            for at, w in enumerate(s):
                v = self.next[v][self.ids[w]]
                if t < len(self.templates):
                    ends[v].add((t, at + 1))
            if t >= len(self.templates):
                stop[v].append((len(s), t - len(self.templates)))
        by_length = sorted(range(1, len(self.next)), key=lambda v: self.length[v])
        for v in reversed(by_length):
            ends[self.link[v]] |= ends[v]
        self.ends = [sorted(e) for e in ends]
        # places that a state's suffix link has beyond its own: there only the link's string ends
        self.more = [sorted(ends[self.link[v]] - ends[v]) if v else [] for v in range(len(self.next))]
        # of a template's patterns the first that means it
        self.telling = [next((re.compile(p) for x, word, p in TELLING if x == label and word in words), None)
                        for label, words in self.templates]
        self.phrase_ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for v in by_length:
            self.phrase_ends[v] = stop[v] + self.phrase_ends[self.link[v]]
        # word hashes in sorted order, and the pairs of words that stand together
        blocks = words_of(pa.array([" ".join(vocabulary)]), LOWER_ALNUM).hashes()
        self.order = np.argsort(blocks)
        self.hashes = blocks[self.order]
        self.pairs = np.array(sorted({self.ids[a] * len(vocabulary) + self.ids[b]
                                      for s in strings for a, b in zip(s, s[1:], strict=False)}), np.int64)

    def runs(self, v: int, length: int, least: int) -> Iterator[tuple[int, int, int]]:
        """(template, end, length) of every place where the last ``least`` words
        at least stand, given the state and the statistic."""
        yield from ((t, to, length) for t, to in self.ends[v])
        while v and self.length[self.link[v]] >= least:
            n = self.length[self.link[v]]
            yield from ((t, to, n) for t, to in self.more[v])
            v = self.link[v]

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Template word id of each word hash, -1 for other words."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)


def _chain(matches: list[tuple[int, int, int]], size: int) -> tuple[int, int, int]:
    """Heaviest chain of (doc start, doc end, template end) matches that go
    on in both texts: (weight, start, end). A prefix-maximum tree over
    template places; matches enter it once the text is past their end."""
    tree: list[tuple[int, int]] = [(0, -1)] * (size + 1)
    waiting: list[tuple[int, int, int, int]] = []
    best = (0, 0, 0)
    for start, end, to in sorted(matches):
        while waiting and waiting[0][0] <= start:
            _, at, weight, first = heapq.heappop(waiting)
            while at <= size:
                tree[at] = max(tree[at], (weight, -first))
                at += at & -at
        at, before = to - (end - start), (0, 0)
        while at > 0:
            before = max(before, tree[at])
            at -= at & -at
        weight = before[0] + end - start
        first = -before[1] if before[0] else start
        heapq.heappush(waiting, (end, to, weight, first))
        best = max(best, (weight, first, end), key=lambda x: (x[0], -x[1], -x[2]))
    return best


def scan_words(sam: LicenceAutomaton, ids: np.ndarray, min_match: int, max_gap: int, min_cover: float,
               text_of: Callable[[int, int], str]) -> dict:
    """Base places and covered spans of one text's word ids; ``text_of`` gives
    a range of its words at single spaces."""
    base: list[tuple[int, int]] = []
    by_template: dict[int, list[tuple[int, int, int]]] = {}
    joined = np.zeros(len(ids), bool)   # word i and i+1 stand together in some template
    if len(ids) > 1:
        pair = ids[:-1] * len(sam.ids) + ids[1:]
        at = np.minimum(np.searchsorted(sam.pairs, pair), len(sam.pairs) - 1)
        joined[:-1] = (sam.pairs[at] == pair) & (ids[:-1] >= 0) & (ids[1:] >= 0)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], joined.view(np.int8), [0]])))
    for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        steps = list(sam.statistics(ids[lo: hi + 1].tolist()))
        for k, (v, length) in enumerate(steps):
            for size, phrase in sam.phrase_ends[v]:
                if size <= length:
                    base.append((lo + k + 1 - size, phrase))
            if length >= min_match:
                after = int(ids[lo + k + 1]) if k + 1 < len(steps) else -1
                for t, to, n in sam.runs(v, length, min_match):
                    if to == len(sam.strings[t]) or sam.strings[t][to] != after:   # goes no further in this template
                        by_template.setdefault(t, []).append((lo + k + 1 - n, lo + k + 1, to))
    spans, best = [], 0.0
    for t, matches in by_template.items():
        label, words = sam.templates[t]
        matches.sort()
        block, reach = [], None
        for m in [*matches, None]:
            if block and (m is None or m[0] - reach > max_gap):
                weight, start, end = _chain(block, len(words))
                cover = weight / len(words)
                best = max(best, cover)
                told = sam.telling[t]
                if cover >= min_cover and (told is None or told.search(text_of(start, end + max_gap))):
                    spans.append({"label": label, "start": start, "end": end, "cover": cover})
                block, reach = [], None
            if m is not None:
                block.append(m)
                reach = max(m[1], reach or 0)
    return {"base": base, "spans": sorted(spans, key=lambda s: (s["start"], s["end"], s["label"])), "best": best}


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 templates: Sequence[tuple[str, str]] = TEMPLATES,
                 phrases: Sequence[tuple[str, str]] = BASE_PHRASES,
                 min_match: int = 4, max_gap: int = 12, min_cover: float = 0.6) -> DataFrame:
    """One row per row of ``docs``; see the module text for the columns."""
    for label in [*(x for x, _ in templates), *(x for _, x in phrases)]:
        if re.search("[,:]", label):
            raise ValueError(f"label {label!r} holds a separator")
    templates, phrases = list(templates), list(phrases)

    def scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sam = LicenceAutomaton(templates, phrases)
        for b in batches(it):
            words = words_of(b.column(1), LOWER_ALNUM)
            ids = sam.word_ids(words.hashes())
            rows = {n: [] for n in ("n_base", "first", "last", "base", "labels", "score", "spans")}
            for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                def text_of(a: int, b: int, lo: int = lo, hi: int = hi) -> str:
                    b = min(lo + b, hi)
                    return " ".join(words.data[words.start[lo + a]: words.end[b - 1]].tobytes().decode().split())

                found = scan_words(sam, ids[lo:hi], min_match, max_gap, min_cover, text_of)
                starts = [s for s, _ in found["base"]]
                named = {sam.phrases[p][1] for _, p in found["base"]}
                rows["n_base"].append(len(starts))
                rows["first"].append(min(starts, default=None))
                rows["last"].append(max(starts, default=None))
                rows["base"].append(",".join(sorted(named)))
                rows["labels"].append(",".join(sorted(named | {s["label"] for s in found["spans"]})))
                rows["score"].append(1.0 if starts else found["best"])
                rows["spans"].append(found["spans"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(words.counts, pa.int64()), pa.array(rows["n_base"], pa.int64()),
                 pa.array(rows["first"], pa.int64()), pa.array(rows["last"], pa.int64()),
                 pa.array(rows["base"], pa.string()), pa.array(rows["labels"], pa.string()),
                 pa.array(rows["score"], pa.float64()), pa.array(rows["spans"], _SPAN)],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                       "spans"])

    return docs.select(id_col, text_col).mapInArrow(scan, SCHEMA)
