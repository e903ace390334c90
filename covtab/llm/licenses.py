"""License scans: an exact set-similarity join of text blocks and templates.

A text's words are cut into blocks of ``BLOCK_WORDS``, each beginning half a
block after the one before, so that any passage of up to half a block and one
word lies whole in one of them. A block matches a template if it contains at
least ``MIN_PERCENT`` of the template's distinct words (its containment); the
join finds every such pair:

1. One pass over all documents counts the templates' words. They are numbered
   by that count, rarest first: one order for all sets. Other words are in no
   template and cannot change what a block shares with one.
2. A template of ``n`` words needs ``least`` of them. Blocks with fewer are out
   (length filter). If a block shares that many, it shares one of the
   template's first ``n - least + 1`` and one of its own first (prefix filter):
   only these words look each other up, in an index of the templates' prefixes.
3. Words found at places i and j leave at most as many shared words as follow
   either of them; pairs that cannot reach ``least`` so are out (positional
   filter). The rest is counted in full.

The templates are a fixed, small table that goes to the tasks with the code.
Besides them, the places of exact phrases are found. Words are made of letters,
digits and everything above ASCII, with A-Z lower-cased, and compared by 64-bit
hashes.

Cases: a null text is empty and has neither words nor labels; a very long text
is worked on as a whole, in memory proportional to its words; repeated rows are
scanned each; of words with equal counts the smaller one comes first; an empty
table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covtab.llm.textcore import ASCII_LOWER, segment_hashes, text_slices, word_hashes, words

BLOCK_WORDS = 32
MIN_PERCENT = 85

# The phrases of the base rule and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"),
           ("all rights reserved", "reserved"))
# License statements in common use, at most half a block of words each.
TEMPLATES = (
    ("agpl", "licensed under the gnu affero general public license version 3"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("bsd", "released under the bsd 3 clause license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "waived all copyright and related or neighboring rights to this work"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu"),
    ("lgpl", "licensed under the gnu lesser general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl", "subject to the terms of the mozilla public license version 2 0"),
    ("reserved", "no part of this publication may be reproduced without prior written permission"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

# Bytes of lower-cased text that stand between words.
_GAPS = np.ones(256, bool)
_GAPS[ord("0"):ord("9") + 1] = False
_GAPS[ord("a"):ord("z") + 1] = False
_GAPS[0x80:] = False


def _least(n: int, percent: int) -> int:
    """Words of ``n`` that make up the threshold, rounded up."""
    return -(-n * percent // 100)


def _hash(word: str) -> np.ndarray:
    raw = np.frombuffer(word.encode(), np.uint8)
    return segment_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def _text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the first word of each row."""
    lower = ASCII_LOWER[data]
    start, end, first = words(lower, offsets, _GAPS)
    return word_hashes(lower, start, end), first


class _Vocabulary:
    """Words and their hashes, for looking up which of them a text has."""

    def __init__(self, names: list[str]):
        hashes = np.array([_hash(w) for w in names], np.uint64)
        order = np.argsort(hashes)
        self.sorted, self.number = hashes[order], order
        if (self.sorted[1:] == self.sorted[:-1]).any():
            raise ValueError("two words of the templates share a hash")

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the vocabulary's words in ``hashes``, and their numbers."""
        at = np.searchsorted(self.sorted, hashes)
        at[at == len(self.sorted)] = 0
        hit = np.flatnonzero(self.sorted[at] == hashes)
        return hit, self.number[at[hit]]


@dataclass(frozen=True)
class Index:
    """The templates under one order of their words, rarest first."""
    order: tuple[str, ...]
    templates: tuple[tuple[str, str], ...]
    phrases: tuple[tuple[str, str], ...]
    block_words: int
    percent: int

    def sets(self) -> list[list[int]]:
        rank = {w: k for k, w in enumerate(self.order)}
        return [sorted({rank[w] for w in text.split()}) for _, text in self.templates]


def _vocabulary(templates: tuple[tuple[str, str], ...]) -> list[str]:
    return sorted({w for _, text in templates for w in text.split()})


def build_index(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES,
                phrases: tuple[tuple[str, str], ...] = PHRASES,
                block_words: int = BLOCK_WORDS, percent: int = MIN_PERCENT) -> Index:
    """The index whose order follows the counts of the templates' words in all
    documents. The driver sees one count for each of these words, no more."""
    names = _vocabulary(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Vocabulary(names), np.zeros(len(names), np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text")):
                _, number = known.find(_text_words(data, offsets)[0])
                total += np.bincount(number, minlength=len(names))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(names))), pa.array(total)], ["number", "n"])
    counted = (docs.select(F.col("text").cast("string").alias("text"))
               .mapInArrow(run, "number long, n long").groupBy("number").agg(F.sum("n").alias("n")))
    times = {r["number"]: r["n"] for r in counted.collect()}
    order = sorted(range(len(names)), key=lambda k: (times.get(k, 0), names[k]))
    return Index(tuple(names[k] for k in order), templates, phrases, block_words, percent)


class _Join:
    """A task's side of the join: postings of the templates' prefixes, and
    which words each template has."""

    def __init__(self, index: Index):
        self.index = index
        self.known = _Vocabulary(list(index.order))
        sets = index.sets()
        self.size = np.array([len(s) for s in sets])
        self.least = np.array([_least(len(s), index.percent) for s in sets])
        self.has = np.zeros((len(index.order), len(sets)), np.int32)
        postings: list[list[tuple[int, int]]] = [[] for _ in index.order]
        for t, s in enumerate(sets):
            self.has[s, t] = 1
            for i, word in enumerate(s[:len(s) - self.least[t] + 1]):
                postings[word].append((t, i))
        self.first = np.concatenate(([0], np.cumsum([len(p) for p in postings])))
        flat = np.array([x for p in postings for x in p], np.int64).reshape(-1, 2)
        self.template, self.place = flat[:, 0], flat[:, 1]

    def matches(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rows (row, block, template, shared) of all matching blocks."""
        half = self.index.block_words // 2
        none = np.zeros((0, 4), np.int64)
        at, word = self.known.find(hashes)
        row = np.searchsorted(first, at, side="right") - 1
        # Blocks of the slice are numbered through; each word is in two.
        blocks = -(-np.diff(first) // half)
        base = np.concatenate(([0], np.cumsum(blocks)))
        own = (at - first[row]) // half
        block = np.concatenate((base[row] + own, (base[row] + own - 1)[own > 0]))
        word = np.concatenate((word, word[own > 0]))
        entry = np.unique(block * len(self.index.order) + word)
        if not len(entry):
            return none
        block, word = np.divmod(entry, len(self.index.order))
        new = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        size = np.diff(np.concatenate((new, [len(block)])))
        n = np.repeat(size, size)
        j = np.arange(len(block)) - np.repeat(new, size)
        # Look every word up in the prefixes.
        hits = self.first[word + 1] - self.first[word]
        k = np.repeat(np.arange(len(block)), hits)
        posting = np.arange(len(k)) - np.repeat(np.cumsum(hits) - hits, hits) + self.first[word[k]]
        t, i = self.template[posting], self.place[posting]
        need = self.least[t]
        keep = ((n[k] >= need) & (j[k] <= n[k] - need)
                & (np.minimum(self.size[t] - i, n[k] - j[k]) >= need))
        pair = np.unique(block[k[keep]] * len(self.size) + t[keep])
        if not len(pair):
            return none
        b, t = np.divmod(pair, len(self.size))
        which = np.searchsorted(block[new], b)
        shared = np.concatenate(
            [np.zeros(0, np.int64)]
            + [np.add.reduceat(self.has[word, x], new)[which[t == x]]
               for x in range(len(self.size)) if (t == x).any()])
        order = np.argsort(t, kind="stable")
        b, t = b[order], t[order]
        good = shared >= self.least[t]
        b, t, shared = b[good], t[good], shared[good]
        row = np.searchsorted(base, b, side="right") - 1
        out = np.stack((row, b - base[row], t, shared), axis=1)
        return out[np.lexsort((out[:, 2], out[:, 1], out[:, 0]))]


class _Phrases:
    def __init__(self, phrases: tuple[tuple[str, str], ...]):
        self.words = [np.array([_hash(w) for w in text.split()], np.uint64) for text, _ in phrases]

    def places(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rows (row, word, phrase) where a phrase's words stand together."""
        out = [np.zeros((0, 3), np.int64)]
        for p, phrase in enumerate(self.words):
            at = np.flatnonzero(hashes[:max(0, len(hashes) - len(phrase) + 1)] == phrase[0])
            for k in range(1, len(phrase)):
                at = at[hashes[at + k] == phrase[k]]
            row = np.searchsorted(first, at, side="right") - 1
            whole = at + len(phrase) <= first[row + 1]
            at, row = at[whole], row[whole]
            out.append(np.stack((row, at - first[row], np.full(len(at), p)), axis=1))
        rows = np.concatenate(out)
        return rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]


def _lists(rows: np.ndarray, n: int, names: list[str]) -> pa.ListArray:
    """Rows, of which the first column is the list they belong to, as structs."""
    upto = np.searchsorted(rows[:, 0], np.arange(n + 1))
    columns = [pa.array(rows[:, k + 1]) for k in range(len(names))]
    return pa.ListArray.from_arrays(pa.array(upto, pa.int32()),
                                    pa.StructArray.from_arrays(columns, names))


def license_matches(docs: DataFrame, index: Index) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``places`` (of phrases: word,
    phrase) and ``blocks`` (matches: block, template, shared words). Phrases
    and templates are numbered as in the index; block b begins at word
    ``b * block_words / 2``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join, phrases = _Join(index), _Phrases(index.phrases)
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column("text")):
                hashes, first = _text_words(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(np.diff(first)),
                     _lists(phrases.places(hashes, first), j - i, ["word", "phrase"]),
                     _lists(join.matches(hashes, first), j - i, ["block", "template", "shared"])],
                    ["doc_id", "n_words", "places", "blocks"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, places array<struct<word: long, "
                             "phrase: long>>, blocks array<struct<block: long, template: long, "
                             "shared: long>>"))


def license_labels(found: DataFrame, index: Index) -> DataFrame:
    """What ``license_matches`` found, as numbers and labels a document.
    ``score`` is 1 with a phrase, else the greatest containment of a template."""
    phrase = F.array(*[F.lit(label) for _, label in index.phrases])
    template = F.array(*[F.lit(label) for label, _ in index.templates])
    size = F.array(*[F.lit(float(len(s))) for s in index.sets()])
    base = F.transform("places", lambda p: F.get(phrase, p["phrase"].cast("int")))
    more = F.transform("blocks", lambda b: F.get(template, b["template"].cast("int")))
    share = F.transform("blocks", lambda b: b["shared"] / F.get(size, b["template"].cast("int")))

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places")["word"].alias("first_word"),
        F.array_max("places")["word"].alias("last_word"), joined(base).alias("base_labels"),
        joined(F.concat(base, more)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(share), F.lit(0.0)))
        .alias("score"))
