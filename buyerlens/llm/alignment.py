"""Two tokenizers' tokens aligned over the bytes they share.

A text's tokens are the arrays of their end offsets, kept as increments: ahead
of a common end, equal ends are equal increments. Where both arrays go on alike
at the present shift between the indexes, one token answers one token: such a
stretch is jumped over by probes that double while the slices are equal and
halve after the first that is not. What is left until the next common end is an
irregular group, resolved by a local walk, after which the shift is another.
Equal-offset groups, and every pair of tokens that overlap (links), come out of
this one pass.

How often an id pair is linked is a count over the whole corpus. A task keeps
its texts in blocks (a bounded number of links each, as places in the block's
list of distinct pairs); only those lists are shuffled to be counted and looked
up, and a block meets its own lookups again.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.base import prepare
from buyerlens.llm.bytebpe import Decoder, rank_encoder, segments, tokenizer_file
from buyerlens.session import materialize

SPACE_MARK = "▁"


@dataclass(frozen=True)
class AlignParams:
    block_links: int = 1 << 18  # a block is closed once it has so many links
    block_docs: int = 1 << 16  # or so many rows


CACHE = 150_000  # segments whose ids a process keeps
Run = tuple[int, int, int, int]  # A tokens [i, k), B tokens [j, m): a group, or as many groups as tokens where they answer one to one


def runs(a: Sequence[int], b: Sequence[int]) -> Iterator[tuple[Run, list[bool] | None]]:
    """Groups of two token sequences of the same bytes, given the tokens' lengths (none is empty).

    ``(run, None)`` is a stretch that answers one to one; ``(run, steps)`` one
    irregular group: a step to each further overlapping pair, True where the A
    token ends first.
    """
    i = j = 0
    end = len(a)
    while i < end:
        n, step = 0, 4
        while i + n < end and a[i + n:i + n + step] == b[j + n:j + n + step]:
            n += step
            step *= 2
        while step > 1 and i + n < end:
            step //= 2
            if a[i + n:i + n + step] == b[j + n:j + n + step]:
                n += step
        if n:
            n = min(n, end - i)
            yield (i, i + n, j, j + n), None
            i, j = i + n, j + n
        if i < end:
            k, m, x, y = i, j, a[i], b[j]
            steps = []
            while x != y:
                if x < y:
                    k += 1
                    x += a[k]
                    steps.append(True)
                else:
                    m += 1
                    y += b[m]
                    steps.append(False)
            yield (i, k + 1, j, m + 1), steps
            i, j = k + 1, m + 1


def links(n: int, inner: list[int], by_a: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """The A and the B index of each of ``n`` links in order. From one to the next both tokens change, but at the
    places ``inner`` to a group, where one alone does (``by_a``: the A token)."""
    steps = np.ones((2, n), np.int64)
    steps[:, :1] = 0
    steps[np.where(by_a, 1, 0) if inner else [], inner] = 0
    return tuple(steps.cumsum(1))


class Aligner:
    """Ids of both tokenizers and their alignment, for whole texts.

    No piece of B has a space behind another character, so what a single space
    between visible characters parts is never joined: B's ids of a text are
    those of its segments, and each distinct segment is encoded once.
    """

    def __init__(self, a_path: str, pattern: str, b_path: str):
        import sentencepiece

        self.a = rank_encoder(a_path, pattern)
        self.a_bytes = Decoder(tokenizer_file(a_path)).table
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(x) for x in range(self.b_size)]
        sample = "ﬁ ½  x\t Å "
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces) or self.b.normalize(sample) != (" " + sample).replace(" ", SPACE_MARK):
            raise ValueError("a piece reaches over a space, or texts are normalised: they cannot be cut at spaces")
        self.b_bytes = [piece_bytes(p, self.b.is_byte(x)) for x, p in enumerate(pieces)]
        lengths = [np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes)]
        if max(x.max() for x in lengths) > 255:
            raise ValueError("a token of more than 255 bytes")
        self.a_len, self.b_len = (x.astype(np.uint8) for x in lengths)
        self.names = np.array([str(x) for x in range(max(len(self.a_bytes), self.b_size))], object)
        self.b_names = np.array(["|" + x for x in self.names], object)
        self.known: list[dict[str, bytes | None]] = [{}, {}]  # segments of late, and of the time before

    def _learn(self, parts: list[list[str]]) -> dict[str, bytes | None]:
        """B's ids of every segment, as bytes; None where they do not spell it."""
        if len(self.known[0]) > CACHE:
            self.known = [{}, self.known[0]]
        seen, before = self.known
        fresh = []
        for x in set().union(*parts):
            if x not in seen:
                if x in before:
                    seen[x] = before[x]
                else:
                    fresh.append(x)
        spelling = self.b_bytes.__getitem__
        for x, ids in zip(fresh, self.b.encode(fresh, num_threads=1)):
            seen[x] = array("I", ids).tobytes() if b"".join(map(spelling, ids)) == b" " + x.encode() else None
        return seen

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of ``" " + text`` and of the text; none where either's bytes are not those of ``" " + text``."""
        texts = [t or "" for t in texts]
        parts = [segments(t) for t in texts]
        known = self._learn(parts)
        none = np.zeros(0, "<u4")
        for t, p in zip(texts, parts):
            b = [known[x] for x in p]
            if not b or None in b:
                yield none, none
                continue
            a, b = self.a.encode(" " + t, max(map(len, p)) >= self.a.RUN), np.frombuffer(b"".join(b), "<u4")
            # Byte-level tokens spell whatever they are cut from; B's spell each segment, so the bytes are the same.
            yield (a, b) if self.a_len[a].sum(dtype=np.int64) == self.b_len[b].sum(dtype=np.int64) else (none, none)

    def runs(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[Run, list[bool] | None]]:
        return runs(self.a_len[a].tobytes(), self.b_len[b].tobytes())

    def aligned(self, a: np.ndarray, b: np.ndarray) -> tuple[int, str, np.ndarray]:
        """Number of groups, their text, and the code of every link (A id times B's size plus B id)."""
        a_names, b_names = self.names[a].tolist(), self.b_names[b].tolist()
        n = n_links = 0
        parts, inner, by_a = [], [], []
        for (i, k, j, m), steps in self.runs(a, b):
            if steps is None:
                n += k - i
                n_links += k - i
                parts += map(add, a_names[i:k], b_names[j:m])
            else:
                n += 1
                inner += range(n_links + 1, n_links + 1 + len(steps))
                by_a += steps
                n_links += 1 + len(steps)
                parts.append(",".join(a_names[i:k]) + b_names[j] + "".join(["," + y[1:] for y in b_names[j + 1:m]]))
        x, y = links(n_links, inner, by_a)
        return n, ";".join(parts), a[x].astype(np.int64) * self.b_size + b[y]


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace(SPACE_MARK, " ").encode()


_ALIGNERS: dict[tuple, Aligner] = {}  # a worker process keeps its tables from task to task


def aligner(*paths: str) -> Aligner:
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


BLOCK = ("block long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
         "sha array<string>, pairs array<long>, times array<long>, places binary")
FIGURES = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def place_type(n_pairs: int) -> str:
    """Of the links' places in a block of so many distinct pairs: two bytes where they suffice."""
    return "<u2" if n_pairs <= 1 << 16 else "<u4"


def blocks(docs: DataFrame, a_path: str, pattern: str, b_path: str, p: AlignParams = AlignParams(), id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """The aligned texts in blocks: per text its figures, per block its distinct id pairs (A id times
    B's size plus B id), how many links each has, and every link's place among them."""
    def block(number: int, rows: list[tuple], codes: list[np.ndarray]) -> pa.RecordBatch:
        places, pairs = pd.factorize(np.concatenate(codes))
        order = np.argsort(pairs)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        places, pairs = rank[places], pairs[order]
        times = np.bincount(places, minlength=len(pairs))
        ids, *figures, sha = zip(*rows)
        longs, lists = pa.int64(), pa.list_(pa.int64())
        return pa.record_batch([
            pa.array([number], longs), pa.array([ids], lists), *[pa.array([x], lists) for x in figures],
            pa.array([sha], pa.list_(pa.string())), pa.array([pairs], lists), pa.array([times.astype(np.int64)], lists),
            pa.array([places.astype(place_type(len(pairs))).tobytes()], pa.binary())],
            ["block", "ids", "n_a", "n_b", "n_groups", "n_links", "sha", "pairs", "times", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(a_path, pattern, b_path)
        number = TaskContext.get().partitionId() << 32
        rows, codes, links = [], [], 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, (a, b) in zip(ids, al.encode(batch.column(1).to_pylist())):
                n, text, code = al.aligned(a, b)
                rows.append((i, len(a), len(b), n, len(code), hashlib.sha256(text.encode()).hexdigest() if text else ""))
                codes.append(code)
                links += len(code)
                if links >= p.block_links or len(rows) >= p.block_docs:
                    yield block(number, rows, codes)
                    rows, codes, links, number = [], [], 0, number + 1
        if rows:
            yield block(number, rows, codes)

    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, BLOCK)


def pair_counts(table: DataFrame, b_size: int) -> DataFrame:
    """``(pair, count, best)`` over all blocks: how many links hold the id pair, and whether none of
    its B id is held by more."""
    counts = (table.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
              .agg(F.sum("x.times").alias("count")))
    counts = materialize(counts.withColumn("b", F.col("pair") % b_size))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def digests(docs: DataFrame, a_path: str, pattern: str, b_path: str, p: AlignParams = AlignParams(), id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per row ``(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``.

    Null and empty texts, and those whose tokens do not spell them, have zeros
    and an empty digest. Ties for a B id's highest count are all best. Repeated
    rows count and come out each, null ids too; other columns are not read. An
    empty table gives no rows. The paths are opened by every executor (files of
    the installed package).
    """
    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    table = materialize(blocks(docs, a_path, pattern, b_path, p, id_col, text_col))
    asked = table.select(F.col("block").alias("asking"), F.explode("pairs").alias("pair"))
    found = asked.join(pair_counts(table, b_size), "pair")

    def figures(block: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        order = np.argsort(known.column("pair").to_numpy())
        count, best = (known.column(c).to_numpy()[order].astype(np.int64) for c in ("count", "best"))
        for r in block.to_pylist():
            ends = np.cumsum([0, *r["n_links"]])
            places = np.frombuffer(r["places"], place_type(len(count)))
            sums = [np.concatenate([[0], np.cumsum(x[places])]) if len(places) else np.zeros(1, np.int64) for x in (best, count)]
            n_best, count_sum = (np.diff(x[ends]) for x in sums)
            out.append(pa.table({
                "id": pa.array(r["ids"], pa.int64()), **{c: pa.array(r[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")},
                "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()),
                "groups_sha256": pa.array(r["sha"], pa.string())}))
        return pa.concat_tables(out)

    own = table.select("block", "ids", "n_a", "n_b", "n_groups", "n_links", "sha", "places")
    return (own.groupBy("block").cogroup(found.groupBy("asking")).applyInArrow(figures, FIGURES)
            .withColumnRenamed("id", id_col))


def alignments(docs: DataFrame, a_path: str, pattern: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per group of a text ``(id_col, start, end, a_ids, b_ids)``, offsets in the bytes of a space and the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(a_path, pattern, b_path)
        ints = pa.list_(pa.int32())
        for batch in batches:
            for i, (a, b) in zip(batch.column(0).to_pylist(), al.encode(batch.column(1).to_pylist())):
                ends = [0, *al.a_len[a].cumsum(dtype=np.int64).tolist()]
                rows = []
                for (x, k, y, m), steps in al.runs(a, b):
                    rows += [(x, k, y, m)] if steps else [(x + s, x + s + 1, y + s, y + s + 1) for s in range(k - x)]
                yield pa.record_batch([
                    pa.array([i] * len(rows), pa.int64()), pa.array([ends[x] for x, *_ in rows], pa.int64()),
                    pa.array([ends[k] for _, k, *_ in rows], pa.int64()), pa.array([a[x:k] for x, k, *_ in rows], ints),
                    pa.array([b[y:m] for *_, y, m in rows], ints)], ["id", "start", "end", "a_ids", "b_ids"])

    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "id long, start long, end long, a_ids array<int>, b_ids array<int>").withColumnRenamed("id", id_col)
