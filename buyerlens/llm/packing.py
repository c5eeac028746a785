"""Best-fit packing planned on the histogram of lengths.

Pieces of documents are counted by length; best fit runs over those counts
(at most ``size`` of them, whatever the number of documents) and gives slots:
"the pieces of length L with ranks lo..hi go to sequences s, s+1, ..., m to
each, from offset o on". A piece finds its slot by joining on its length and
its rank within the length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from buyerlens.llm.base import cut, prepare
from buyerlens.llm.bytebpe import rank_encoder

PIECES = "id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class PackParams:
    size: int = 1024  # tokens of a sequence
    end_id: int = 2  # closes a document
    part_rows: int = 200_000  # pieces of one length that are ranked in one task
    slot_ranks: int = 4_096  # ranks of a length that share their slots


@dataclass(frozen=True)
class Slot:
    length: int
    lo: int  # ranks lo <= r < hi
    hi: int
    sequence: int  # of rank lo
    per: int  # pieces to each sequence
    offset: int  # of a sequence's first one


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole ones, but for a shorter first one."""
    if n <= size:
        return [(0, n)]
    first = n % size or size
    return [(0, first), *((s, size) for s in range(first, n, size))]


def pieces(docs: DataFrame, tokenizer: str, pattern: str, p: PackParams = PackParams(), id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(id_col, piece, start, length, ids_crc32)``: every document's ids and the end id, cut. A null text has the end id alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = rank_encoder(tokenizer, pattern)
        end = p.end_id.to_bytes(4, "little")
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = (enc.encode(t).tobytes() if t else b"") + end
                rows += [(i, k, s, n, zlib.crc32(ids[4 * s:4 * (s + n)])) for k, (s, n) in enumerate(cuts(len(ids) // 4, p.size))]
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                  ["id", "piece", "start", "length", "ids_crc32"])

    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, PIECES).withColumnRenamed("id", id_col)


def plan(counts: dict[int, int], size: int) -> tuple[list[Slot], int]:
    """Best fit, longest first, over counts: the slots, and the number of sequences.

    ``open_`` holds runs of sequences with equal room. A length goes to the
    run with the least room that holds it, as often as it fits, then to the
    next; what no run holds opens new sequences.
    """
    open_: dict[int, list[tuple[int, int]]] = {}
    slots: list[Slot] = []
    used = 0
    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]

        def place(first: int, number: int, room: int) -> int:
            """Fill up to ``number`` sequences from ``first`` on; how many were touched."""
            nonlocal rank
            per = room // length
            full = min(number, (total - rank) // per)
            if full:
                slots.append(Slot(length, rank, rank + full * per, first, per, size - room))
                rank += full * per
                put(first, full, room - per * length)
            if full < number and rank < total:
                rest = total - rank
                slots.append(Slot(length, rank, total, first + full, rest, size - room))
                rank = total
                put(first + full, 1, room - rest * length)
                full += 1
            return full

        def put(first: int, number: int, room: int) -> None:
            if room > 0:
                open_.setdefault(room, []).append((first, number))

        for room in sorted(r for r in open_ if r >= length):
            runs = open_.pop(room)
            while runs and rank < total:
                first, number = runs.pop()
                done = place(first, number, room)
                if done < number:
                    runs.append((first + done, number - done))
            if runs:
                open_.setdefault(room, []).extend(runs)
            if rank == total:
                break
        if rank < total:
            number = -(-(total - rank) // (size // length))
            used += place(used, number, size)
    return slots, used


def place(parts: DataFrame, p: PackParams = PackParams(), id_col: str = "doc_id") -> DataFrame:
    """``parts`` (made once, with ``length``) with ``sequence_id`` and ``offset``.

    A piece of the whole size is a sequence by itself (a negative number, by
    its place in the table) and needs no rank. The others are counted by
    length, which is all that best fit needs. Ranks: a length's pieces fall by
    hash into as many parts as its count asks for, are numbered there, and
    start where the parts before end. The slots of a length are cut at every
    ``slot_ranks`` ranks, so that a piece meets those about its own rank alone,
    however many there are.
    """
    spark = parts.sparkSession
    whole = (parts.where(F.col("length") == p.size)
             .select(*parts.columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    rest = parts.where(F.col("length") != p.size)
    counts = {r["length"]: r["n"] for r in rest.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return whole
    slots, _ = plan(counts, p.size)
    deals = spark.createDataFrame([(n, 1 + c // p.part_rows) for n, c in counts.items()], "length long, __parts long")
    # At most one row per length below ``size``.
    salted = rest.join(F.broadcast(deals), "length").withColumn("__salt", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.col("__parts")))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("__salt")) - F.col("n")
    starts = (salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("n"))
              .select("length", "__salt", before.alias("__before")))
    w = Window.partitionBy("length", "__salt").orderBy(id_col, "piece", "ids_crc32")
    ranked = (salted.withColumn("__r", F.row_number().over(w) - 1).join(starts, ["length", "__salt"])
              .withColumn("__rank", F.col("__r") + F.col("__before")).withColumn("__block", F.expr(f"__rank div {p.slot_ranks}")))
    table = spark.createDataFrame([(s.length, s.lo, s.hi, s.sequence, s.per, s.offset) for s in slots],
                                  "__l long, __lo long, __hi long, __seq long, __per long, __off long")
    table = table.withColumn("__b", F.explode(F.expr(f"sequence(__lo div {p.slot_ranks}, (__hi - 1) div {p.slot_ranks})")))
    fit = ((F.col("length") == F.col("__l")) & (F.col("__block") == F.col("__b"))
           & (F.col("__rank") >= F.col("__lo")) & (F.col("__rank") < F.col("__hi")))
    step = F.col("__rank") - F.col("__lo")
    return whole.unionByName(ranked.join(table, fit).select(
        *parts.columns, (F.col("__seq") + F.expr("(__rank - __lo) div __per")).alias("sequence_id"),
        (F.col("__off") + (step % F.col("__per")) * F.col("length")).alias("offset")))


def pack(docs: DataFrame, tokenizer: str, pattern: str, p: PackParams = PackParams(), id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per piece ``(id_col, piece, start, length, ids_crc32, sequence_id, offset)``.

    Null and empty texts are one piece, the end id. Repeated rows are packed
    each; null ids are kept; an empty table packs to no rows; other columns are
    not read. Tokens are counted once: the pieces are checkpointed.
    """
    return place(cut(pieces(docs, tokenizer, pattern, p, id_col, text_col)), p, id_col)
