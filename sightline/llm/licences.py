"""Licence scans by a positional index of rare words.

The notices to look for are short texts, inverted into postings (word, notice, position). A first pass counts in how many documents each of
their words occurs. In the second, every file's RARE licence words of the highest inverse document frequency are looked up: a word at
place p of the file that stands at q of a notice votes for the notice's start at p - q. Starts that at least AGREEING of the words agree on
are held against the file: all mandatory key phrases must stand in place, and SHARE of the notice's words. The base phrases are in the index
under their own rarest word, which is looked up in every file, so that none of their places is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.tables import bounded_batches
from sightline.llm.words import Vocabulary, hashed_words

RARE, AGREEING, SHARE = 8, 2, 0.6
# Phrases that count wherever they stand, with their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# Label, wording of a public licence's notice, and the phrases of it that must be there.
NOTICES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted", "any person obtaining a copy")),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("apache-2.0", "you may not use this file except in compliance with the license", ("except in compliance with the license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms", "are permitted provided")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license",)),
    ("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", ("cc0 1 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("reserved", "no part of this publication may be reproduced without prior written permission", ("may be reproduced", "written permission")),
)
RESULT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, notices array<struct<label:string,first_word:long,last_word:long,share:double>>"


@dataclass(frozen=True)
class Notice:
    label: str
    words: tuple[str, ...]
    needed: tuple[int, ...]  # positions of the words of its mandatory phrases


def notice(label: str, text: str, phrases: tuple[str, ...]) -> Notice:
    words, needed = tuple(text.split()), set()
    for phrase in phrases:
        own = tuple(phrase.split())
        at = next(i for i in range(len(words)) if words[i : i + len(own)] == own)
        needed |= set(range(at, at + len(own)))
    return Notice(label, words, tuple(sorted(needed)))


class Index:
    """Postings of the notices and base phrases by word; `rank` orders words by how few documents hold them, then by spelling."""

    def __init__(self, base: list[Notice], notices: list[Notice], holding: dict[str, int] | None = None):
        self.base, self.notices = base, notices
        self.words = sorted({w for n in base + notices for w in n.words})
        self.known, number = Vocabulary(self.words), {w: i for i, w in enumerate(self.words)}
        self.rank = np.zeros(len(self.words), np.int64)
        self.rank[sorted(range(len(self.words)), key=lambda i: ((holding or {}).get(self.words[i], 0), i))] = np.arange(len(self.words))
        self.numbers = [np.array([number[w] for w in n.words]) for n in base + notices]
        postings = sorted((number[w], t, q) for t, n in enumerate(notices) for q, w in enumerate(n.words))
        self.notice, self.position = (np.array([p[k] for p in postings], np.int64) for k in (1, 2))
        self.ends = np.searchsorted([p[0] for p in postings], np.arange(len(self.words) + 1))
        self.longest = max((len(n.words) for n in base + notices), default=0)


PLACE = 1 << 40  # places of a text's words stay below


def _hits(column: pa.Array, known: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row, and (row * PLACE + place, number) of its licence words in order."""
    n, codes, numbers = np.zeros(len(column), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row, place, value in hashed_words(column):
        n += np.bincount(row, minlength=len(column))
        number = known.numbers(value)
        codes.append((row * PLACE + place)[number >= 0])
        numbers.append(number[number >= 0])
    return n, np.concatenate(codes), np.concatenate(numbers)


def document_frequencies(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """In how many whole texts each word occurs; one number a word comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Vocabulary(words), np.zeros(len(words), np.int64)
        for batch in batches:
            _, code, number = _hits(batch.column("text"), known)
            total += np.bincount(np.unique(code // PLACE * len(words) + number) % len(words), minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(words))), pa.array(total)], ["number", "holding"])

    rows = bounded_batches(docs.select(F.col("text").cast("string").alias("text"))).mapInArrow(run, "number long, holding long")
    return {words[r.number]: r.holding for r in rows.groupBy("number").agg(F.sum("holding").alias("holding")).collect()}


def _in_place(code: np.ndarray, number: np.ndarray, start: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Starts by words of a notice: whether the word stands at its place."""
    if not len(code):
        return np.zeros((len(start), len(wanted)), bool)
    there = start[:, None] + np.arange(len(wanted))
    at = np.minimum(np.searchsorted(code, there), len(code) - 1)
    return (code[at] == there) & (number[at] == wanted)


def base_places(index: Index, code: np.ndarray, number: np.ndarray) -> list[np.ndarray]:
    """For each base phrase the codes at which it starts."""
    out = []
    for phrase, wanted in zip(index.base, index.numbers):
        anchor = min(range(len(wanted)), key=lambda q: index.rank[wanted[q]])
        start = code[number == wanted[anchor]] - anchor
        out.append(start[_in_place(code, number, start, wanted).all(axis=1)])
    return out


def found_notices(index: Index, rows: int, code: np.ndarray, number: np.ndarray) -> list[list[tuple[str, int, int, float]]]:
    """For each row the notices that stand in it: label, first and last word, share of the words in place."""
    row, rank = code // PLACE, index.rank[number]
    # The rarest licence words of each row.
    size = max(1, len(index.words))
    own = np.unique(row * size + rank)
    nth = np.arange(len(own)) - np.searchsorted(own, own // size * size)
    looked_up = own[nth < RARE]
    at = np.minimum(np.searchsorted(looked_up, row * size + rank), max(0, len(looked_up) - 1))
    keep = np.flatnonzero(looked_up[at] == row * size + rank) if len(looked_up) else np.zeros(0, np.int64)
    # Votes: one a word and posting, of which a start counts each word once.
    degree = (index.ends[1:] - index.ends[:-1])[number[keep]]
    ends = np.cumsum(degree)
    posting = np.repeat(index.ends[number[keep]] - (ends - degree), degree) + np.arange(ends[-1] if len(ends) else 0)
    start = np.repeat(code[keep], degree) - index.position[posting] + index.longest
    words = np.repeat(number[keep], degree)
    order = np.lexsort((words, start, index.notice[posting]))
    t, start, words = index.notice[posting][order], start[order], words[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (start[1:] != start[:-1])
    other = new.copy()
    other[1:] |= words[1:] != words[:-1]
    first = np.flatnonzero(new)
    agreeing = np.add.reduceat(other.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    t, start = t[first][agreeing >= AGREEING], start[first][agreeing >= AGREEING]
    out: list[list[tuple[str, int, int, float]]] = [[] for _ in range(rows)]
    for k in np.unique(t):
        this, own = index.notices[k], start[t == k]
        there = _in_place(code, number, own - index.longest, index.numbers[len(index.base) + k])
        share = there.mean(axis=1)
        good = there[:, list(this.needed)].all(axis=1) & (share >= SHARE)
        for s, part in zip(own[good].tolist(), share[good].tolist()):
            out[s // PLACE].append((this.label, s % PLACE - index.longest, s % PLACE - index.longest + len(this.words) - 1, part))
    return out


def scan(docs: DataFrame, base: tuple = BASE, notices: tuple = NOTICES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, notices) of every row of docs.

    n_base counts all places of the base phrases, first_word and last_word are the smallest and largest (null without one). labels adds those
    of the notices found, which notices lists with their first and last word and the share of their words in place; a notice that starts
    before the text has a first word below 0. score is 1 with a base phrase, else the largest share, else 0. Null texts count as empty and
    have no labels (the empty string). Words are equally rare with equal counts and go by spelling then. Repeated rows give repeated
    rows; columns beside doc_id and text are not looked at; an empty table gives no rows.
    """
    phrases, texts = [Notice(label, tuple(p.split()), ()) for p, label in base], [notice(*n) for n in notices]
    holding = document_frequencies(docs, Index(phrases, texts).words)
    labels = np.array([p.label for p in phrases], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(phrases, texts, holding)
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"]
        for batch in batches:
            n, code, number = _hits(batch.column("text"), index.known)
            places = base_places(index, code, number)
            found = found_notices(index, batch.num_rows, code, number)
            which = np.repeat(np.arange(len(places)), [len(p) for p in places])
            every = np.concatenate([np.zeros(0, np.int64), *places])
            order = np.argsort(every, kind="stable")
            which, every = which[order], every[order]
            cut = np.searchsorted(every, np.arange(batch.num_rows + 1) * PLACE)
            rows = []
            for i in range(batch.num_rows):
                a, b = cut[i], cut[i + 1]
                if a == b and not found[i]:
                    rows.append((0, None, None, "", "", 0.0, []))
                    continue
                own = set(labels[which[a:b]])
                ends = (int(every[a] % PLACE), int(every[b - 1] % PLACE)) if a < b else (None, None)
                score = 1.0 if a < b else max(f[3] for f in found[i])
                listed = [dict(zip(("label", "first_word", "last_word", "share"), f)) for f in sorted(found[i], key=lambda f: (f[1], f[2], f[0]))]
                rows.append((int(b - a), *ends, ",".join(sorted(own)), ",".join(sorted(own | {f[0] for f in found[i]})), score, listed))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("share", pa.float64())])))
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), *columns], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bounded_batches(rows).mapInArrow(run, RESULT)
