"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A vocabulary's tokens are byte strings, which tokenizers keep as strings of
visible characters, one per byte. The text pattern cuts a text into pieces
that are encoded apart, so each distinct piece need be encoded only once. No
piece reaches over the place before a single space between two visible
characters, nor does the pattern look ahead past one, so a text's ids are also
those of its space-bounded segments one after the other: a text is split at
spaces, known segments are looked up, and only new ones are cut by the pattern.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.base import prepare

SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]
_PLACE = re.compile(r"(?<=\S) (?=\S)")
CACHE = 250_000  # segments, and pieces, that an encoder keeps


def byte_chars() -> list[str]:
    """The visible character of each byte: the byte's own where Latin-1 shows one, else the next from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in own}
    for k, b in enumerate(b for b in range(256) if b not in chars):
        chars[b] = chr(256 + k)
    return [chars[b] for b in range(256)]


def tokenizer_file(path: str):
    """A tokenizer file of the library; special tokens in a text are ordinary text."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def tokenizer_of_ranks(path: str, pattern: str):
    """A tokenizer with the merges that a file of ranks implies: every two tokens whose joint bytes
    are a token merge, in the order of that token's rank; a piece that is a token stays whole."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks = read_ranks(path)
    chars = byte_chars()
    shown = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = [(shown[t[:i]], shown[t[i:]]) for t in sorted(ranks, key=ranks.get) for i in range(1, len(t))
              if t[:i] in ranks and t[i:] in ranks]
    tok = Tokenizer(models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    tok.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "removed", invert=True),
                                                 pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tok


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def segments(text: str) -> list[str]:
    """``text`` cut at each single space between two visible characters; joined by spaces they are the text."""
    if not text:
        return []
    if text[0] == " " or text[-1] == " " or any(f" {c}" in text or f"{c} " in text for c in SPACES if c in text):
        return _PLACE.split(text)
    return text.split(" ")


_ENCODERS: dict[tuple, Encoder] = {}  # a worker process keeps its encoders and their bounded caches from task to task


def encoder(path: str, pattern: str, ranks: bool) -> Encoder:
    """The process's encoder for a file of ranks, or a tokenizer file of the library."""
    key = (path, pattern, ranks)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(tokenizer_of_ranks(path, pattern) if ranks else tokenizer_file(path), pattern)
    return _ENCODERS[key]


class Encoder:
    """Whole texts to ids, as little-endian unsigned 32-bit bytes, by distinct segments and pieces."""

    def __init__(self, tokenizer, pattern: str):
        import regex
        from tokenizers import pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.by_pattern = regex.compile(pattern).findall
        self.shown = dict(enumerate(byte_chars()))
        self.tokenizer = tokenizer
        # New pieces go to the library many at a time, as shown bytes with spaces between.
        self.tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.segments: list[dict[str, bytes]] = [{}, {}]  # those of late, and those of the time before
        self.pieces: list[dict[str, bytes]] = [{}, {}]

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [segments(t) for t in texts]
        seen, before = self._room(self.segments)
        # A text's first segment has no space before it.
        heads = [p[0] if p else "" for p in parts]
        fresh = []
        for x in set().union(*(p[1:] for p in parts)):
            if x not in seen:
                if x in before:
                    seen[x] = before[x]
                else:
                    fresh.append(x)
        cuts = [self.pieces_of(x) for x in heads] + [self.pieces_of(" " + x) for x in fresh]
        self._learn(cuts)
        piece = self.pieces[0].__getitem__
        seen.update((x, b"".join(map(piece, c))) for x, c in zip(fresh, cuts[len(heads):]))
        known = seen.__getitem__
        return [b"".join(map(piece, c)) + b"".join(map(known, p[1:])) for c, p in zip(cuts, parts)]

    def pieces_of(self, segment: str) -> list[str]:
        """The pattern's pieces; of a space, a word and one closing mark they are known without it."""
        if segment[1:].isalpha() and segment[0] == " ":
            return [segment]
        if segment[-1:] in (".", ",") and segment[1:-1].isalpha() and segment[0] == " ":
            return [segment[:-1], segment[-1]]
        return self.by_pattern(segment)

    def show(self, piece: str) -> str:
        if piece[0] == " " and piece.isascii() and piece[1:].isalnum():
            return self.shown[32] + piece[1:]
        return piece.encode("utf-8", "replace").decode("latin-1").translate(self.shown)

    @staticmethod
    def _room(kept: list[dict]) -> list[dict]:
        if len(kept[0]) > CACHE:
            kept[:] = [{}, kept[0]]
        return kept

    def _learn(self, cuts: list[list[str]]) -> None:
        seen, before = self._room(self.pieces)
        fresh = []
        for x in set().union(*cuts):
            if x not in seen:
                if x in before:
                    seen[x] = before[x]
                else:
                    fresh.append(x)
        for i in range(0, len(fresh), 512):
            part = fresh[i:i + 512]
            shown = " ".join(map(self.show, part))
            e = self.tokenizer.encode(shown, add_special_tokens=False)
            ids, words = np.array(e.ids, "<u4"), np.array(e.word_ids, np.int64)
            ends = np.searchsorted(words, np.arange(len(part)), side="right").tolist()
            raw = ids.tobytes()
            at = 0
            for x, end in zip(part, ends):
                seen[x] = raw[4 * at:4 * end]
                at = end


class RankEncoder:
    """The ids that a tokenizer file of the library gives, by tiktoken over the file's vocabulary.

    In a vocabulary whose merged tokens are numbered in the order of their
    merges the numbers are the ranks (checked). A text with a very long run
    without, or of, white space goes to the library itself, whose time does not
    grow with the square of a piece.
    """

    RUN = 2000

    def __init__(self, path: str, pattern: str):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
        vocab = model["vocab"]
        numbers = [vocab[m] for m in merges]
        if numbers != sorted(numbers) or (numbers and numbers[0] < len(byte_chars())):
            raise ValueError("the file's numbers are not the ranks of its merges")
        back = {c: b for b, c in enumerate(byte_chars())}
        merged = set(merges)
        ranks = {bytes(back[c] for c in t): i for t, i in vocab.items() if t in merged or (len(t) == 1 and t in back)}
        self.encoding = tiktoken.Encoding("by-file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.path = path
        self.pattern = pattern

    def _long(self, text: str) -> bool:
        """True for any text with a run of ``RUN`` characters without, or of, white space."""
        if len(text) < self.RUN:
            return False
        words = text.split()
        lengths = list(map(len, words))
        return max(lengths, default=0) >= self.RUN or len(text) - sum(lengths) - len(words) + 2 >= self.RUN

    def encode(self, text: str, long: bool | None = None) -> np.ndarray:
        """Ids of a whole text, little-endian unsigned 32-bit; ``long`` passes whether it has such a run, where known."""
        if self._long(text) if long is None else long:
            return np.frombuffer(encoder(self.path, self.pattern, False).encode([text])[0], "<u4")
        return self.encoding.encode_to_numpy(text, disallowed_special=())


_RANK_ENCODERS: dict[tuple, RankEncoder] = {}


def rank_encoder(path: str, pattern: str) -> RankEncoder:
    """The process's encoder for a tokenizer file of the library."""
    if (path, pattern) not in _RANK_ENCODERS:
        _RANK_ENCODERS[path, pattern] = RankEncoder(path, pattern)
    return _RANK_ENCODERS[path, pattern]


class Decoder:
    """Ids to the bytes they stand for: the byte table reversed over the vocabulary."""

    def __init__(self, tokenizer):
        back = {c: b for b, c in enumerate(byte_chars())}
        vocab = tokenizer.get_vocab(with_added_tokens=True)
        self.table = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.table[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()

    def decode(self, ids: bytes) -> bytes:
        """Characters split over tokens come together again, as the bytes are joined before any is read as text."""
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def digests(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``(id_col, n_tokens, ids_sha256, decoded_sha256)`` of the whole text, encoded and decoded again.

    A null text is an empty one: no ids, and the digest of no bytes. Repeated
    rows each come out, null ids too; other columns are not read. ``ranks`` is
    a path that every executor can open (the installed package's file).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks, pattern, True)
        dec = Decoder(enc.tokenizer)
        for b in batches:
            ids = enc.encode([t or "" for t in b.column(1).to_pylist()])
            yield pa.record_batch([b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                                   pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                                   pa.array([hashlib.sha256(dec.decode(x)).hexdigest() for x in ids])],
                                  ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def encoded(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``(id_col, ids array<int>, starts array<int>, ends array<int>)``, character offsets of every token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer_of_ranks(ranks, pattern)
        for b in batches:
            full = [tok.encode(t or "", add_special_tokens=False) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array([e.ids for e in full], pa.list_(pa.int32())),
                                   pa.array([[o[0] for o in e.offsets] for e in full], pa.list_(pa.int32())),
                                   pa.array([[o[1] for o in e.offsets] for e in full], pa.list_(pa.int32()))],
                                  ["id", "ids", "starts", "ends"])

    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "id long, ids array<int>, starts array<int>, ends array<int>").withColumnRenamed("id", id_col)


def decoded(ids: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: ``(id_col, text)`` of an ``array<int>`` of ids; bytes that are no whole character become U+FFFD. Null: empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec = Decoder(tokenizer_of_ranks(ranks, pattern))
        for b in batches:
            texts = [dec.decode(np.array(x or [], "<u4").tobytes()).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(texts, pa.string())], ["id", "text"])

    prepare(ids.sparkSession)
    src = ids.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return src.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)
