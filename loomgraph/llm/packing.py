"""Packing documents into fixed-length sequences along a Hilbert curve.

Each document becomes token ids (plus an end id), a hashed bag-of-tokens
vector, and a Hilbert key of that vector's projection to a few dimensions.
The rows are range-sorted by the key, so neighbours on the curve have similar
contents, and the sorted stream of ids is cut every ``length`` tokens: all
sequences but the last are full. Where a document begins in the stream is the
prefix sum of the rows before it: a running sum inside each written partition
plus the totals of the partitions before (one row per partition).

Copies share a key; ties are cut by id, so a group of copies spreads over as
many range partitions as its size asks for.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.llm.byte_bpe import byte_table
from loomgraph.llm.caches import Cache
from loomgraph.session import materialize

WORDS, PIECES = 500_000, 600_000  # entries of the two caches
PLAIN = re.compile("[\t-\r -~\u00c0-\u024f]*")  # blanks, marks and Latin letters in composed form
HASHED, DIMS, BITS = 64, 4, 15    # vector width, projected width, bits a dimension


class WordBPE:
    """Ids of whole texts by a tokenizer file, with cached words.

    Blank-separated words do not influence each other in a tokenizer that
    drops white space, so each distinct word goes through the tokenizer once
    per cache. :meth:`_fits` checks that the file is of that kind; for any
    other file whole texts go through the library.
    """

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.fits = self._fits(spec)
        if self.fits:
            self.cut = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
            self.table = dict(enumerate(byte_table()))
            self.model = self.tokenizer.model
        self.words, self.pieces = Cache(self.word, WORDS), Cache(self.piece, PIECES)
        self.others = Cache(self.other, WORDS // 10)

    def forget(self) -> None:
        """Empty the caches, which would fill the worker through later stages."""
        for cache in (self.words, self.pieces, self.others):
            cache.clear()
            cache.older = {}

    @staticmethod
    def _fits(spec: dict) -> bool:
        steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        return (steps == ["NFC", "Replace", "Lowercase"] and [c.get("type") for c in cuts] == ["Split", "ByteLevel"]
                and cuts[0].get("behavior") == "Removed" and bool(cuts[0].get("invert"))
                and all(t["content"].startswith("<") and not t["lstrip"] and not t["rstrip"] for t in spec["added_tokens"]))

    def _ids(self, ids: list[int]) -> bytes:
        return array(self.kind.char, ids).tobytes()

    def word(self, word: bytes) -> bytes:
        """A word of a plain text in lower case."""
        text = word.decode()
        if text.isalpha():
            return self.pieces[text]
        return b"".join(map(self.pieces.__getitem__, self.cut.findall(text)))

    def piece(self, piece: str) -> bytes:
        chars = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.table)
        return self._ids([t.id for t in self.model.tokenize(chars)])

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, self.kind)
        if not self.fits:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)
        if "<" not in text and PLAIN.fullmatch(text):
            words = text.lower().encode().split()  # cuts at ASCII blanks only
            return np.frombuffer(b"".join(map(self.words.__getitem__, words)), self.kind)
        return np.frombuffer(b"".join(map(self.others.__getitem__, text.encode().split())), self.kind)

    def other(self, word: bytes) -> bytes:
        """A word of a text with other scripts, marks or special tokens."""
        text = word.decode()
        if "<" not in text and PLAIN.fullmatch(text):
            return self.words[text.lower().encode()]
        return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)


_MODELS: dict[str, WordBPE] = {}


def model(path: str) -> WordBPE:
    if path not in _MODELS:
        _MODELS[path] = WordBPE(path)
    return _MODELS[path]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: well spread hashes of small integers."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def vectors(rows: list[np.ndarray], vocab: int) -> np.ndarray:
    """Unit vectors of signed token counts hashed to ``HASHED`` cells and damped."""
    h = _mixed(np.arange(vocab))
    cell, sign = (h % np.uint64(HASHED)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)
    out = np.zeros((len(rows), HASHED))
    for i, ids in enumerate(rows):
        out[i] = np.bincount(cell[ids], weights=sign[ids], minlength=HASHED)
    out = np.sign(out) * np.log1p(np.abs(out))
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions on the Hilbert curve of points with integer coordinates below
    ``2**bits`` (rows are points): the transform of coordinates to transposed
    index bits, for all points at once, then the bits interleaved."""
    x = points.astype(np.int64).T.copy()
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn, q = np.zeros_like(x[0]), top
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(rows: list[np.ndarray], vocab: int) -> np.ndarray:
    """Hilbert keys of documents given by their token ids."""
    project = np.random.default_rng(17).standard_normal((HASHED, DIMS)) * 2.0
    flat = np.clip(vectors(rows, vocab) @ project / 6 + 0.5, 0, 1)  # coordinates have deviation 2
    return hilbert_keys(np.minimum((flat * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = 2048,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])``
    per piece of a document; ``ids`` (array of int) are the piece's tokens.

    A null or empty text is the end id alone. Each token lies in exactly one
    piece; pieces of a sequence are gapless from 0, and every sequence but
    the last holds ``length`` tokens. Rows with equal keys go by id (nulls
    first) and text; repeated rows are packed each. Other columns are ignored;
    an empty table gives no rows. A very long text is many pieces.
    """
    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(tokenizer_path)
        for batch in batches:
            ids = [np.append(bpe.encode(v.as_py()), bpe.kind.type(end_id)) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(curve_keys(ids, bpe.size)),
                pa.array(list(map(len, ids)), pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                ["id", "key", "n", "ids"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            before = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("p"), pa.array(before), batch.column("n"), batch.column("ids")],
                ["id", "p", "before", "n", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(tokenizer_path)
        kind = bpe.kind
        bpe.forget()  # all texts are tokenized
        for batch in batches:
            out: list[tuple] = []
            for doc, begin, n, raw in zip(*(batch.column(c).to_pylist() for c in ("id", "begin", "n", "ids"))):
                ids, at = np.frombuffer(raw, kind).astype("<u4"), 0
                while at < n:
                    seq, off = divmod(begin + at, length)
                    some = ids[at:at + length - off]
                    out.append((doc, at, len(some), zlib.crc32(some.tobytes()), n, seq, off,
                                *([some] if with_ids else [])))
                    at += len(some)
            cols = list(zip(*out)) or [()] * (8 if with_ids else 7)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(c, pa.list_(pa.int32())) for c in cols[7:]],
                [c.split()[0] for c in schema])

    schema = ["id long", "start long", "length long", "ids_crc32 long", "doc_tokens long", "sequence_id long",
              "offset long", *(["ids array<int>"] if with_ids else [])]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    # written first: sorting by range samples its input, which would tokenize twice
    keyed = materialize(rows.mapInArrow(tokenized, "id long, key long, n long, ids binary"), "pack-tokens", codec="zstd")
    order = ["key", "id", "n"]
    table = (keyed.repartitionByRange(*order).sortWithinPartitions(*order, "ids")
             .select("id", F.spark_partition_id().alias("p"), "n", "ids")
             .mapInArrow(placed, "id long, p int, before long, n long, ids binary"))
    table = materialize(table, "pack-stream", codec="zstd")
    totals = table.groupBy("p").agg(F.sum("n").alias("s"))  # one row per partition
    base = totals.select("p", F.coalesce(F.sum("s").over(W.orderBy("p").rowsBetween(W.unboundedPreceding, -1)),
                                         F.lit(0)).alias("b"))
    located = table.join(F.broadcast(base), "p").select("id", (F.col("b") + F.col("before")).alias("begin"), "n", "ids")
    return located.mapInArrow(cut, ", ".join(schema)).withColumnRenamed("id", id_col)
