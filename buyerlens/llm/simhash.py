"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint's 64 bits are three segments of 22, 21 and 21 bits. Of at most
two differing bits, some segment has none, and the segment after it (in a
ring) has at most one: if the two bits share a segment, one of the other two
segments is followed by the third, and if they do not, both neighbours of the
equal segment have one each. So a key is one segment as it is and the index of
a Golay codeword near the next one. The 23-bit Golay code is perfect: a word
is within three bits of exactly one codeword, so the codeword nearest to one
word is within four bits of every word one bit away. One side is stored under
its nearest codeword, the other under all codewords within four bits (about
five), and a shared key is certain for every pair that must link; the bit
distance is then verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.base import cut, prepare
from buyerlens.llm.components import connected_components

SEED = 42
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # (lowest bit, bits)
RING = ((0, 1), (1, 2), (2, 0))
GENERATOR = 0b101011100011  # x^11+x^9+x^7+x^6+x^5+x+1, the binary Golay code's
REACH = 4
MAX_BITS = 2
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
CHUNK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats counted; 0 if it has no word."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first = np.concatenate(([0], ends[:-shingle]))
    last = ends[shingle - 1:] - 1
    digest, n = xxhash.xxh64_intdigest, len(first)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first[i:i + CHUNK].tolist(), last[i:i + CHUNK].tolist())),
                        np.uint64, min(CHUNK, n - i))
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += _column_sums(bits)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _column_sums(bits: np.ndarray) -> np.ndarray:
    """Sums of the columns of a 0/1 byte matrix: runs of 255 rows are added as bytes, eight at a time."""
    total = np.zeros(64, np.int64)
    words = np.ascontiguousarray(bits).view(np.uint64)
    whole = len(words) // 255 * 255
    if whole:
        total += words[:whole].reshape(-1, 255, 8).sum(axis=1, dtype=np.uint64).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    if whole < len(words):
        total += words[whole:].sum(axis=0, dtype=np.uint64).view(np.uint8).astype(np.int64)
    return total


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id_col, fp long)`` for every row; a null text is an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.record_batch([b.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return src.mapInArrow(run, "id long, fp long").withColumnRenamed("id", id_col)


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(syndrome of each 23-bit word, nearest error per syndrome, all errors of weight 4 per syndrome, 0-padded)."""
    rest = np.zeros(23, np.int64)
    for i in range(23):
        r = 1 << i
        for k in range(22, 10, -1):
            if r >> k & 1:
                r ^= GENERATOR << (k - 11)
        rest[i] = r
    words = np.arange(1 << 23, dtype=np.int32)
    syn = np.zeros(1 << 23, np.int16)
    for i in range(23):
        syn ^= ((words >> i & 1) * rest[i]).astype(np.int16)
    leader = np.zeros(2048, np.int64)
    far: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(1, REACH + 1):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            if weight < REACH:
                leader[syn[e]] = e
            else:
                far[syn[e]].append(e)
    most = max(map(len, far))
    return syn, leader, np.array([x + [0] * (most - len(x)) for x in far], np.int64)


def golay_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit words: the nearest codeword's index, and of all codewords within four bits (-1: none)."""
    syn, leader, far = _golay()
    s = syn[words].astype(np.int64)
    nearest = (words ^ leader[s]) >> 11
    errors = far[s]
    others = np.where(errors != 0, (words[:, None] ^ errors) >> 11, -1)
    return nearest, np.concatenate([nearest[:, None], others], axis=1)


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """For fingerprints (uint64): one key per ring place (n x 3), and all near keys by fingerprint."""
    seg = [((fps >> np.uint64(lo)) & np.uint64((1 << n) - 1)).astype(np.int64) for lo, n in SEGMENTS]
    one, many = [], []
    for place, (exact, fuzzy) in enumerate(RING):
        nearest, near = golay_indices(seg[fuzzy])
        base = (place << 40 | seg[exact] << 12)
        one.append(base | nearest)
        many.append(np.where(near >= 0, base[:, None] | near, -1))
    allkeys = np.concatenate(many, axis=1)
    return np.stack(one, axis=1), [r[r >= 0] for r in allkeys]


def _keyed(fps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            one, many = keys_of(b["fp"].to_numpy(np.int64).view(np.uint64))
            yield pd.DataFrame({"fp": b["fp"], "one": list(one), "many": many})

    return fps.select("fp").mapInPandas(run, "fp long, one array<long>, many array<long>")


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``: all pairs of distinct fingerprints (column ``fp``) that differ in at most ``max_bits`` (<= 2) bits."""
    if max_bits > MAX_BITS:
        raise ValueError("the segments' ring reaches two bits at most")
    keyed = cut(_keyed(fps))
    left = keyed.select(F.col("fp").alias("a"), F.explode("one").alias("key"))
    right = keyed.select(F.col("fp").alias("b"), F.explode("many").alias("key"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    pairs = left.join(right, (left["key"] == right["key"]) & near).select("a", "b")
    return pairs.distinct()


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
               max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: ``(id_col, fingerprint, component_id)``.

    Rows with one fingerprint are one node; nodes link at ``max_bits`` or fewer
    differing bits; ``component_id`` is the smallest id reachable. Null and
    empty texts have fingerprint zero and link like any other. Repeated rows
    each come out. A null id takes part but never names a component (a
    component of null ids alone has a null one). Other columns are not read.
    """
    fp = cut(fingerprints(docs, id_col, text_col, shingle))
    nodes = cut(fp.groupBy("fp").agg(F.min(id_col).alias("low")))
    linked = connected_components(near_pairs(nodes, max_bits))
    rooted = nodes.join(linked.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = rooted.join(names, "root").select("fp", "component_id")
    return fp.join(by_fp, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """``docs`` without the rows whose id is not their component's smallest.

    Columns, null ids and repeated rows of a kept id stay as they are.
    """
    gone = components(docs, id_col, **kw).where(F.col(id_col) != F.col("component_id")).select(
        F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
