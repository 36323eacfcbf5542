"""Tokenizing, packing, sharding and exact deduplication against brute force."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from loomgraph.llm import byte_bpe, packing
from loomgraph.llm.exact_dedup import exact_dedup
from loomgraph.llm.sharding import byte_shards

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
ODD = [None, "", " ", "a", "a  b", "it's\n\n x", "erere ereerere .....  !!!!", "\t a b  c ", "don't we'll",
       "naïve Ünï ΑΣ σς İI", "é café", "<|endoftext|> x<|startoftext|>y", "中文 12345 ½", "x" * 5000,
       "\x1c a \x1d", "a​b", "🙂🙃 ok", "000000 ana banana anana", "\n", "a \n b", " lead", "trail "]
SCHEMA = "doc_id long, text string, ids string, size int, _id int, key string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, 2, "k") for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    rng = random.Random(3)
    alphabet = "aber .,!\n\té0'  "
    return ODD + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(300)] + [r[0] for r in rows]


def test_byte_bpe_equals_tiktoken(spark, texts):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in byte_bpe.round_trip(frame(spark, texts), RANKS, P.PATTERN).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((t or "").encode()).hexdigest())
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want, repr(t)[:80]


def test_byte_bpe_every_character_and_overlaps():
    import tiktoken
    bpe = byte_bpe.model(RANKS, P.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    for c in map(chr, [*range(1, 0x3000), *range(0xA000, 0xAC00), 0xFEFF, 0x1F600]):
        t = f"a{c}b {c}{c} 1{c}"
        assert bpe.encode(t).tolist() == enc.encode_ordinary(t), hex(ord(c))
    rng = random.Random(5)
    for _ in range(3000):
        t = "".join(rng.choices(["er", "e", "re", "an", "a", ".", "0", "es", "se", "!"], k=rng.randrange(2, 9)))
        assert bpe.encode(t).tolist() == enc.encode_ordinary(t), t


def test_encode_and_decode_frames(spark):
    toks = byte_bpe.encode(frame(spark, ODD), RANKS, P.PATTERN)
    back = {r.doc_id: r for r in byte_bpe.decode(toks, RANKS, P.PATTERN).collect()}
    spans = {r.doc_id: r for r in toks.collect()}
    for i, t in enumerate(ODD):
        assert back[i].text == (t or "")
        r = spans[i]
        bpe = byte_bpe.model(RANKS, P.PATTERN)
        for k, a, b in zip(r.ids, r.starts, r.ends):
            assert bpe.token_bytes[k] in t[a:b].encode()


def test_packing(spark, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORDS)
    rows = packing.pack(frame(spark, texts), WORDS).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert len(by_doc) == len(texts)
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        parts = sorted(by_doc[i], key=lambda r: r.start)
        assert [x for r in parts for x in r.ids] == ids, repr(t)[:80]
        at = 0
        for r in parts:
            assert r.start == at and r.length == len(r.ids) and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            at += r.length
    for seq, parts in by_seq.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 2048 or seq == max(by_seq)


def test_hilbert_neighbours():
    side = 8
    grid = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    path = grid[np.argsort(packing.hilbert_keys(grid, bits=3))]
    assert sorted(packing.hilbert_keys(grid, bits=3)) == list(range(side ** 3))
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_exact_dedup(spark):
    rng = random.Random(1)
    texts = ODD + ["same  text"] * 40 + ["same text", "same\ttext", "samE text"] + \
        ["p" * 64 + c for c in "abcabc"] + ["".join(rng.choices("ab ", k=6)) for _ in range(300)]
    got = {r.doc_id: r for r in exact_dedup(frame(spark, texts), digest=True).collect()}
    import re
    groups = {}
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    for i, t in enumerate(norm):
        groups.setdefault(t, []).append(i)
    for i, t in enumerate(norm):
        r = got[i]
        assert (r.keep_id, r.group_size, r.kept) == (groups[t][0], len(groups[t]), i == groups[t][0])
        assert r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()
    nulls = spark.createDataFrame([(None, "a"), (None, "a"), (3, "b"), (None, "b"), (3, "b")], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in exact_dedup(nulls).collect())
    assert got == [("3", "3", 3, True), ("3", "3", 3, True), ("None", "3", 3, False),
                   ("None", "None", 2, True), ("None", "None", 2, True)]


def test_byte_shards(spark):
    rng = random.Random(2)
    texts = ODD + ["é" * rng.randrange(200) for _ in range(2000)]
    rows = sorted(byte_shards(frame(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    assert [r.size for r in rows] == [len((t or "").encode()) + 16 for t in texts]
    assert [r.text_crc32 for r in rows] == [zlib.crc32((t or "").encode()) for t in texts]
    shards = [r.shard for r in rows]
    assert shards == sorted(shards) and set(shards) <= set(range(40))
    total, most = sum(r.size for r in rows), max(r.size for r in rows)
    for k in range(40):
        own = [r for r in rows if r.shard == k]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 40) <= most
    again = spark.createDataFrame([(None, None), (1, "a"), (1, "a")], "doc_id long, text string")
    assert len({(r.shard, r.slot) for r in byte_shards(again).collect()}) == 3


def test_empty_tables(spark):
    none = frame(spark, []) if False else spark.createDataFrame([], SCHEMA)
    for out in (byte_bpe.round_trip(none, RANKS, P.PATTERN), byte_bpe.encode(none, RANKS, P.PATTERN),
                packing.pack(none, WORDS), exact_dedup(none), byte_shards(none)):
        assert out.count() == 0
    assert byte_shards(none).where(F.col("shard").isNotNull()).count() == 0
