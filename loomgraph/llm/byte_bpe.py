"""Byte-level BPE encoding and decoding with the tokenizers library.

The rank file lists byte strings by rank. The library's BPE model works on
characters, so every byte gets one printable character (the byte-to-character
table), each way of cutting a ranked string into two ranked strings becomes a
merge, and merges are ordered by the rank of what they make. Whole matches
that are ranked themselves are taken as they are (``ignore_merges``).

One case needs care: a ranked string with two different cuts whose halves
overlap (``er+e`` and ``e+re`` in ``erere``). By rank alone the leftmost of
the two goes first; the library prefers the merge listed first. Matches that
hold such an overlap are merged by :meth:`ByteBPE._leftmost`.

Texts repeat their words, so matches are cached: a text is cut at single
spaces between non-space characters (a match can only begin there), each
distinct chunk is matched and encoded once per cache, and a document is the
concatenation of its chunks' ids. Caches are bounded and only ever save work.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.caches import Cache

CHUNKS, MATCHES = 400_000, 600_000  # entries of the two caches


def byte_table() -> list[str]:
    """The character of each byte: printable Latin-1 stands for itself, the
    other bytes take the characters from U+0100 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, free = [], 0x100
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


class ByteBPE:
    """Encoder and decoder for one rank file and match pattern."""

    def __init__(self, rank_path: str, pattern: str):
        import ahocorasick
        import regex
        from tokenizers import models

        with open(rank_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.table = dict(enumerate(byte_table()))
        self.token_bytes = [b""] * (max(self.ranks.values()) + 1)
        merges, overlaps = [], []
        for token, rank in sorted(self.ranks.items(), key=lambda kv: kv[1]):
            self.token_bytes[rank] = token
            cuts = [i for i in range(1, len(token)) if token[:i] in self.ranks and token[i:] in self.ranks]
            merges += [(self._chars(token[:i]), self._chars(token[i:])) for i in cuts]
            for i in cuts:  # token = A+B = B+C with both cuts ranked: A+B+C is ambiguous
                j = len(token) - i
                if i != j and j in cuts and token[:j] == token[i:]:
                    overlaps.append(token + token[j:])
        vocab = {self._chars(t): r for t, r in self.ranks.items()}
        self.token_chars = [self._chars(t) for t in self.token_bytes]
        self.byte_of = np.zeros(1 + max(map(ord, self.table.values())), np.uint8)  # the byte table reversed
        for byte, char in self.table.items():
            self.byte_of[ord(char)] = byte
        self.model = models.BPE(vocab=vocab, merges=merges, ignore_merges=True, cache_capacity=0)
        self.pattern = regex.compile(pattern)
        self.overlaps = ahocorasick.Automaton()
        for x in overlaps:
            self.overlaps.add_word(self._chars(x), True)
        self.overlaps.make_automaton()
        self.decimal = [str(i) for i in range(len(self.token_bytes))]
        self.first = Cache(lambda chunk: self._chunk_ids("", chunk), CHUNKS // 10)
        self.later = Cache(lambda chunk: self._chunk_ids(" ", chunk), CHUNKS)
        self.matches = Cache(self._match_ids, MATCHES)

    def _chars(self, data: bytes) -> str:
        return data.decode("latin-1").translate(self.table)

    def _overlaps(self, chars: str) -> bool:
        return bool(self.overlaps) and next(self.overlaps.iter(chars), None) is not None

    def _leftmost(self, data: bytes) -> list[int]:
        """Merge the lowest ranked adjacent pair, leftmost first, until none is left."""
        if data in self.ranks:
            return [self.ranks[data]]
        n = len(data)
        end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def push(i: int) -> None:
            j = end[i]
            if j < n and (r := self.ranks.get(data[i:end[j]])) is not None:
                heapq.heappush(heap, (r, i, j, end[j]))
        heap: list = []
        for i in range(n):
            push(i)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if not alive[i] or j >= n or not alive[j] or end[i] != j or end[j] != k:
                continue
            end[i], alive[j] = k, False
            if k < n:
                before[k] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [self.ranks[data[i:end[i]]] for i in range(n) if alive[i]]

    def _match_ids(self, match: str) -> bytes:
        data = match.encode()
        chars = self._chars(data)
        if len(chars) > 2 and self._overlaps(chars):
            ids = self._leftmost(data)
        else:
            ids = [t.id for t in self.model.tokenize(chars)]
        return array("I", ids).tobytes()

    def _part_ids(self, text: str) -> bytes:
        return b"".join(map(self.matches.__getitem__, self.pattern.findall(text)))

    def _chunk_ids(self, lead: str, chunk: str) -> bytes | None:
        """Ids of a chunk that follows ``lead``; none where a blank at an end
        of the chunk may belong to a longer match."""
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return None
        return self._part_ids(lead + chunk)

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids of the whole text (null: none), as unsigned 32-bit."""
        if not text:
            return np.empty(0, "<u4")
        first, *later = text.split(" ")
        ids = [self.first[first], *map(self.later.__getitem__, later)]
        if None in ids:  # white space beside a space
            return np.frombuffer(self._part_ids(text), "<u4")
        return np.frombuffer(b"".join(ids), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids: the characters of all tokens together go back
        through the byte table, so a character split over tokens comes whole."""
        chars = "".join(map(self.token_chars.__getitem__, ids.tolist()))
        return self.byte_of[np.frombuffer(chars.encode("utf-16-le"), "<u2")].tobytes()

    def offsets(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Per token the half-open character span it touches in the decoded
        text; tokens that split a character both include it."""
        data = np.frombuffer(self.decode(ids), np.uint8)
        char = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters begun before each byte
        ends = np.cumsum([len(self.token_bytes[i]) for i in ids.tolist()], dtype=np.int64)
        starts = ends - [len(self.token_bytes[i]) for i in ids.tolist()]
        return [(int(char[s + 1]) - 1, int(char[e])) for s, e in zip(starts, ends)]


_MODELS: dict[tuple[str, str], ByteBPE] = {}


def model(rank_path: str, pattern: str) -> ByteBPE:
    """The process-wide encoder (Python workers serve many tasks)."""
    key = (rank_path, pattern)
    if key not in _MODELS:
        _MODELS[key] = ByteBPE(rank_path, pattern)
    return _MODELS[key]


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>, starts array<int>, ends array<int>)``: token ids
    of every whole text and the character span of each token.

    A null or empty text gives empty arrays; repeated rows and null ids are
    kept as they are; other columns are ignored; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(rank_path, pattern)
        for batch in batches:
            ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            spans = [bpe.offsets(x) for x in ids]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([x.tolist() for x in ids], pa.list_(pa.int32())),
                pa.array([[a for a, _ in s] for s in spans], pa.list_(pa.int32())),
                pa.array([[b for _, b in s] for s in spans], pa.list_(pa.int32()))],
                ["id", "ids", "starts", "ends"])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    out = rows.mapInArrow(run, "id long, ids array<int>, starts array<int>, ends array<int>")
    return out.withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """``(id, data binary, text string)``: the bytes of the ids (null: none)
    and their text, where bytes that are no valid UTF-8 become U+FFFD."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(rank_path, pattern)
        for batch in batches:
            data = [bpe.decode(np.array(x or [], dtype="<u4")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(data, pa.binary()),
                pa.array([x.decode("utf-8", "replace") for x in data], pa.string())], ["id", "data", "text"])
    rows = tokens.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("i"))
    return rows.mapInArrow(run, "id long, data binary, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` per row: every whole text
    is encoded and its ids are decoded again in the same task, so the ids do
    not travel. Nulls, empty tables and extra columns as in :func:`encode`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(rank_path, pattern)
        for batch in batches:
            counts, enc, dec = [], [], []
            for value in batch.column(1):
                ids = bpe.encode(value.as_py())
                counts.append(len(ids))
                enc.append(hashlib.sha256(",".join(map(bpe.decimal.__getitem__, ids.tolist())).encode()).hexdigest())
                dec.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(enc, pa.string()), pa.array(dec, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    out = rows.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
