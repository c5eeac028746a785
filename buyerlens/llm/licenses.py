"""License scans: exact phrases, and an exact set-similarity join with templates.

A text block (any two spans of consecutive words, whatever lines they stand on;
a span is the template's number of words) meets a template if it holds at least
``threshold`` of the template's distinct words. Words are
ordered by their frequency over all documents, rarest first. A block that
meets a template of n words shares at least o = ceil(threshold * n) of them,
so it holds one of the n - o + 1 rarest (prefix filter), has at least o words
of the vocabulary (length filter), and from the place of the first shared one
on, enough words must be left (positional filter). What passes is verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.base import prepare

# Bytes of words: digits, letters (A-Z lower-cased) and everything beyond ASCII.
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
           " following conditions are met",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
                " documentation files, to deal in the Software without restriction",
    "public-domain": "This work has been released into the public domain",
}


@dataclass(frozen=True)
class ScanParams:
    phrases: dict[str, str] = field(default_factory=lambda: dict(PHRASES))
    templates: dict[str, str] = field(default_factory=lambda: dict(TEMPLATES))
    threshold: float = 0.85


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Word indices at which ``phrase`` stands in words joined (and framed) by single spaces."""
    out, at = [], joined.find(b" " + phrase + b" ")
    before, last = 0, 0
    while at >= 0:
        before += joined.count(b" ", last, at)
        last = at
        out.append(before)
        at = joined.find(b" " + phrase + b" ", at + 1)
    return out


def blocks(text: bytes, span: int) -> Iterator[list[bytes]]:
    """All windows of two spans of words (the words of a shorter text)."""
    words = words_of(text)
    for i in range(max(1, len(words) - 2 * span + 1)):
        yield words[i:i + 2 * span]


def held_ranks(words: list[bytes], span: int, rank: dict[bytes, int], least: int) -> set[tuple[int, ...]]:
    """The ranks that the :func:`blocks` hold, where at least ``least`` of them: of the windows that begin with a ranked
    word, those that hold one more than the window before."""
    at = [(i, rank[w]) for i, w in enumerate(words) if w in rank]
    held: set[tuple[int, ...]] = set()
    inside: dict[int, int] = {}
    end = 0
    for i, r in at:
        before = end
        while end < len(at) and at[end][0] < i + 2 * span:
            inside[at[end][1]] = inside.get(at[end][1], 0) + 1
            end += 1
        if end > before and len(inside) >= least:
            held.add(tuple(sorted(inside)))
        if inside[r] == 1:
            del inside[r]
        else:
            inside[r] -= 1
    return held


def needed(n: int, threshold: float) -> int:
    return math.ceil(n * threshold - 1e-9)


def scan(docs: DataFrame, p: ScanParams = ScanParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of the whole text.

    ``score``: the largest share of a template that a block holds, where it
    reaches the threshold; one if a phrase stands in the text; else zero. A null
    text is an empty one (no words, null places, empty labels); repeated rows
    and null ids each come out. The templates' words bound what is broadcast.
    """
    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    sets = {name: sorted(set(words_of(t.encode()))) for name, t in p.templates.items()}
    sets = {name: w for name, w in sets.items() if w}
    rank = _ranks(src, sorted(set().union(*sets.values())) if sets else [])
    digest = src.mapInArrow(_digest(p, sets, rank), "id long, n_words long, n_base long, first_word long, last_word long,"
                            " base array<string>, blocks array<struct<span:int,held:array<int>>>")
    labelled = digest.withColumn("__met", _join(sets, _spans(p), rank, p.threshold))
    names = F.array_sort(F.array_distinct(F.concat("base", F.transform("__met", lambda m: m["label"]))))
    best = F.coalesce(F.array_max(F.transform("__met", lambda m: m["share"])), F.lit(0.0))
    return labelled.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(names, ",").alias("labels"), F.when(F.col("n_base") > 0, 1.0).otherwise(best).alias("score"))


def _ranks(src: DataFrame, vocabulary: list[bytes]) -> dict[bytes, int]:
    """Rank of each template word by the number of documents that hold it, over all documents; ties by the word."""
    index = {w: i for i, w in enumerate(vocabulary)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(index), np.int64)
        known = index.keys()
        for b in batches:
            for t in b.column(0).to_pylist():
                for w in known & set(words_of(t or b"")):
                    total[index[w]] += 1
        yield pa.record_batch([pa.array(range(len(index)), pa.int32()), pa.array(total)], ["word", "n"])

    sums = src.select("text").mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n = {r["word"]: r["n"] for r in sums}
    order = sorted(vocabulary, key=lambda w: (n.get(index[w], 0), w))
    return {w: i for i, w in enumerate(order)}


def _digest(p: ScanParams, sets: dict[str, list[bytes]], rank: dict[bytes, int]):
    """Counts and phrases of each text, and of its blocks the ranks of their template words, rarest first, where a
    block's words can suffice for the smallest template."""
    spans = _spans(p)
    least = {name: needed(len(w), p.threshold) for name, w in sets.items()}
    phrases = {b" ".join(words_of(k.encode())): v for k, v in p.phrases.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = rank.keys()
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = t or b""
                words = words_of(t)
                joined = b" " + b" ".join(words) + b" "
                at, base = [], []
                for phrase, label in phrases.items():
                    if here := places(joined, phrase):
                        at += here
                        base.append(label)
                held = []
                got = known & set(words)
                may = [name for name, w in sets.items() if len(got.intersection(w)) >= least[name]]
                # Templates of one length share their windows.
                for span in sorted({spans[name] for name in may}):
                    own = [name for name in may if spans[name] == span]
                    some = {w: rank[w] for name in own for w in sets[name]}
                    held += [{"span": span, "held": h} for h in sorted(held_ranks(words, span, some, min(least[name] for name in own)))]
                rows.append((i, len(words), len(at), min(at, default=None), max(at, default=None), sorted(set(base)), held))
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = (*[pa.int64()] * 5, pa.list_(pa.string()),
                     pa.list_(pa.struct([("span", pa.int32()), ("held", pa.list_(pa.int32()))])))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)],
                                  ["id", "n_words", "n_base", "first_word", "last_word", "base", "blocks"])

    return run


def _spans(p: ScanParams) -> dict[str, int]:
    return {name: max(1, len(words_of(t.encode()))) for name, t in p.templates.items()}


def _join(sets: dict[str, list[bytes]], spans: dict[str, int], rank: dict[bytes, int], threshold: float):
    """``array<struct<label, share>>``: the templates that a row's blocks meet."""
    none = F.array().cast("array<struct<label:string,share:double>>")
    met = none
    for label, words in sorted(sets.items()):
        share = F.array_max(_shares(sorted(rank[w] for w in words), spans[label], threshold))
        met = F.concat(met, F.when(share.isNotNull(), F.array(F.struct(F.lit(label).alias("label"), share.alias("share")))).otherwise(none))
    return met


def _shares(ranks: list[int], span: int, threshold: float):
    """Of the template's blocks that meet it: the share they hold; by prefix, length and position, then verified."""
    n, o = len(ranks), needed(len(ranks), threshold)
    prefix, whole = F.array(*[F.lit(r) for r in ranks[:n - o + 1]]), F.array(*[F.lit(r) for r in ranks])
    common = lambda block: F.size(F.array_intersect(block, whole))

    def meets(block):
        first = F.element_at(F.array_intersect(block, prefix), 1)  # the rarest shared word
        left = F.size(block) - F.array_position(block, first) + 1  # words of the block from there on
        of = n - F.array_position(whole, first) + 1  # and of the template
        may = (F.size(block) >= o) & F.arrays_overlap(block, prefix)
        return F.when(may, F.when(F.least(left, of) >= o, common(block) >= o)).otherwise(False)

    own = F.transform(F.filter("blocks", lambda b: b["span"] == span), lambda b: b["held"])
    return F.transform(F.filter(own, meets), lambda block: common(block) / n)
