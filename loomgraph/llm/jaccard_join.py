"""Similarity join on word shingles: grouped prefix filter and verification.

Two documents link when the Jaccard similarity of their sets of distinct
shingles reaches ``percent``/100. The steps:

1. *Order.* A count-min sketch of all shingles (see ``blocktable``) orders
   them by estimated number of documents, rare first, ties by hash. Any one
   order serves the prefix filter; rare first keeps prefixes apart.
2. *Prefixes.* Of a set of ``n`` shingles the first ``n - ceil(t n) + 1``
   are its prefix; sets that link share a shingle of both prefixes. Shingles
   counted once cannot be shared and are left out of the index.
3. *Groups.* Equal sets are one unit. Units with identical prefixes and size
   are one group, and only groups are indexed.
4. *Filter.* Each group takes the most common shingle of its prefix as its
   home; all groups that hold a home shingle meet there. Group pairs that
   share a shingle but no home are few and are listed.
5. *Expand and verify.* The units of the groups at a home are cut into tiles
   of bounded size, and each pair of tiles counts all overlaps by a product
   of membership matrices. Only a spanning forest of the links leaves a tile
   pair, so large families of near copies do not become lists of pairs. At a
   home of several tiles all units are verified against its first one before,
   and those that this connects to the home's largest part meet only the rest:
   a family of ``m`` units of which ``r`` stay apart costs ``m * r``, not ``m * m``.
6. *Components* of the links by rounds of minimum labels and label jumps.

No set, partner or candidate is capped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.blocktable import LAST, block_table, magnitudes, ordered, received, repeated_cells
from loomgraph.llm.shingles import RUN_BASES, Words, blocks, mixed
from loomgraph.session import materialize, release

TILE = 256  # units in a tile
TILE_BYTES = 8 << 20  # of their sets, about
VERIFY_BYTES = 24 << 20  # of sets that one call of the verification gets, about
COLUMNS = 4096  # shingles of a membership matrix at once
NAMELESS = 1 << 62  # rows with a null id go by a number from here on, made of their set


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text: runs of ``words``
    lower-cased words, or all words of a shorter text, or none."""
    out: list[np.ndarray] = []
    for a, b in blocks(texts):
        w = Words(texts[a:b], lower=True)
        run = w.runs(words)
        for first, n in zip(w.first.tolist(), w.count.tolist()):
            if n >= words:
                out.append(np.unique(run[first:first + n - words + 1]))
            elif n:
                h = n
                for x in w.hash[first:first + n].tolist():
                    h = (h * RUN_BASES[1] + x) & (1 << 64) - 1
                out.append(mixed(np.array([h], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(h: np.ndarray) -> bytes:
    """128 bits of a sequence of hashes."""
    import hashlib
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = (np.cumsum(shared) - 1)[inverse]
    use = shared[inverse]
    owner, column = owner[use], column[use]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for c in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [c, c + COLUMNS])
        m = np.zeros((len(sets), COLUMNS), np.float32)
        m[owner[a:b], column[a:b] - c] = 1
        out += m @ m.T
    return out.astype(np.int64)


def links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Pairs of set numbers that link."""
    n = np.array([len(s) for s in sets])
    both = overlaps(sets)
    hit = 100 * both >= percent * (n[:, None] + n[None, :] - both)
    return np.argwhere(np.triu(hit, 1))


def linked(x: bytes, y: bytes, percent: int) -> bool:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def forest(pairs, names: list) -> list[tuple]:
    """The pairs that join what was apart, in names."""
    up = list(range(len(names)))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i
    out = []
    for i, j in pairs:
        a, b = top(int(i)), top(int(j))
        if a != b:
            up[max(a, b)] = min(a, b)
            out.append((names[i], names[j]))
    return out


def components(edges: DataFrame) -> DataFrame:
    """``(u, label)`` for the ends of ``(u, v)``: smallest name reachable.

    Each round takes the smallest label among neighbours and then the label
    of that label; rounds go on until nothing changes, each written to the
    shared folder. The number of rounds is logarithmic in practice.
    """
    ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    both = materialize(edges.select(F.inline(ends)).distinct(), "link-ends")
    labels = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("u", "v"), "v")
                .groupBy("u").agg(F.min("label").alias("near")))
        step = (labels.join(near, "u")
                .select("u", F.col("label").alias("old"), F.least("label", "near").alias("mid")))
        jump = labels.select(F.col("u").alias("mid"), F.col("label").alias("far"))
        new = materialize(step.join(jump, "mid", "left")
                          .select("u", F.least("mid", F.coalesce("far", "mid")).alias("label"), "old"), "labels")
        changed = new.where("label <> old").limit(1).count()
        release(labels)
        labels = new
        if not changed:
            return labels.select("u", "label")


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 75, block_bytes: int = 12 << 20,
                       id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``(id, n_shingles, component_id[, row, kept])`` per row.

    ``component_id`` is the smallest id reachable over links, the row's own
    included. Words are lower-cased (A-Z) runs of non-blank bytes. Texts with
    fewer than ``words`` words have one shingle, texts without words or null
    texts none, and those link with nothing. Rows with equal sets are linked
    and take part once; rows that repeat an id are linked like any others;
    null ids come after all others and stand as a component's name only where
    all ids in it are null. With ``row_col``, a long that tells rows apart,
    ``kept`` marks one row of each component, the smallest by (id, row), and
    every row without shingles. Other columns are ignored; an empty table gives
    no rows. Whole texts are read, however long.
    """
    table, grid = block_table(docs, id_col, text_col, block_bytes, {row_col: "_row"} if row_col else {})

    def items(block: pa.Table) -> np.ndarray:
        sets = shingle_sets(ordered(block)[2], words)
        return np.concatenate(sets) if sets else np.zeros(0, np.uint64)

    def signatures(key: tuple[pa.Scalar, ...], block: pa.Table, sent: pa.Table) -> pa.Table:
        order, ids, texts = ordered(block)
        number = block.column("_row").to_numpy()[order].tolist() if row_col else [0] * len(order)
        known = received(sent.column("_data").to_pylist())
        rows = []
        for i, r, s in zip(ids.tolist(), number, shingle_sets(texts, words)):
            size = magnitudes(s, grid, *known)
            n = len(s)
            unit = fingerprint(s) if n else None
            if i == LAST:
                i = NAMELESS + int.from_bytes(unit[:7]) if n else None
            first = np.lexsort((s, size))[:n - -(-percent * n // 100) + 1] if n else np.zeros(0, int)
            prefix, many = s[first], size[first] > 0
            rows.append((i, n, unit,
                         fingerprint(np.append(prefix, np.uint64(n))) if many.any() else None,
                         prefix[many].astype(np.int64).tolist() if many.any() else None,
                         s.tobytes() if many.any() else None, r))
        cols = list(zip(*rows)) or [()] * 7
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                         pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary()),
                         pa.array(cols[4], pa.list_(pa.int64())), pa.array(cols[5], pa.binary()), pa.array(cols[6], pa.int64())],
                        ["id", "n", "unit", "grp", "posts", "items", "row"])

    cells = repeated_cells(table, grid, items)
    rows = materialize(
        table.groupBy("_block").cogroup(cells.groupBy("_block"))
        .applyInArrow(signatures, "id long, n long, unit binary, grp binary, posts array<long>, items binary, row long"),
        "jaccard-sets", codec="zstd")

    # equal sets are one unit, named by its smallest id
    units = rows.where("n > 0").groupBy("unit").agg(F.min("id").alias("u"))
    indexed = rows.where("grp IS NOT NULL")
    named = materialize(
        indexed.select("unit", "grp", "posts", "items", "id")
        .join(indexed.groupBy("unit").agg(F.min("id").alias("u")), "unit")
        .where("id = u").dropDuplicates(["unit"])
        .select("u", "grp", "posts", "items", F.octet_length("items").cast("long").alias("bytes")), "jaccard-units")
    groups = named.groupBy("grp").agg(F.count(F.lit(1)).alias("m"), F.min("u").alias("u"), F.sum("bytes").alias("bytes"))
    posts = materialize(named.select("grp", "u", "posts").join(groups, ["grp", "u"])
                        .select("grp", "m", "bytes", F.explode("posts").alias("h")), "jaccard-posts")
    keys = posts.groupBy("h").agg(F.sum("m").alias("size"), F.sum("bytes").alias("bytes")).where("size > 1")
    live = materialize(posts.drop("bytes").join(keys, "h").select("h", "grp", "size", "bytes"), "jaccard-keys")

    homes = live.groupBy("grp").agg(F.max(F.struct("size", "h")).alias("x")).select(F.col("x.h").alias("h")).distinct()
    at_home = materialize(live.join(homes, "h", "left_semi"), "jaccard-homes")

    def test(batches):
        for part in batches:
            out = [(u, v) for u, v, x, y in zip(*(part.column(c).to_pylist() for c in ("u", "v", "x", "y"))) if linked(x, y, percent)]
            cols = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64())], ["u", "v"])

    # the units of every group at a home; large homes first by their leaders
    tiles = F.greatest(F.ceil(F.col("size") / TILE), F.ceil(F.col("bytes") / TILE_BYTES)).cast("int")
    seated = at_home.withColumn("tiles", tiles).join(named.select("grp", "u"), "grp").select("u", "h", "tiles")
    large = materialize(seated.where("tiles > 1"), "jaccard-large")
    leaders = large.groupBy("h").agg(F.min("u").alias("v"))
    star = large.join(leaders, "h").where("u <> v").select("u", "v").distinct()
    near = materialize(star.join(named.select("u", F.col("items").alias("x")), "u")
                       .join(named.select(F.col("u").alias("v"), F.col("items").alias("y")), "v")
                       .select("u", "v", "x", "y").mapInArrow(test, "u long, v long"), "jaccard-star")
    part = components(near).withColumnRenamed("label", "part")
    large = large.join(part, "u", "left").select("h", "u", F.coalesce("part", "u").alias("part"))
    sizes = large.groupBy("h", "part").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy("h").agg(F.max_by("part", F.struct("c", "part")).alias("main"), F.sum("c").alias("m"), F.max("c").alias("c"))
    # units outside the main part (tiles from 0) meet all tiles; those in it meet only the others' tiles
    main = main.where("m > c").join(at_home.select("h", "bytes").distinct(), "h")
    apart = F.greatest(F.ceil((F.col("m") - F.col("c")) / TILE), F.ceil(F.col("bytes") * (F.col("m") - F.col("c")) / F.col("m") / TILE_BYTES))
    whole = F.greatest(F.ceil(F.col("c") / TILE), F.ceil(F.col("bytes") * F.col("c") / F.col("m") / TILE_BYTES))
    main = main.select("h", "main", apart.cast("int").alias("ta"), whole.cast("int").alias("tb"))
    inside = F.col("part") == F.col("main")
    hashed = F.xxhash64("u")
    cut = (large.join(main, "h")
           .withColumn("t", F.when(inside, F.col("ta") + F.pmod(hashed, F.col("tb"))).otherwise(F.pmod(hashed, F.col("ta"))).cast("int"))
           .withColumn("last", F.when(inside, F.col("ta") - 1).otherwise(F.col("ta") + F.col("tb") - 1))
           .withColumn("s", F.explode(F.sequence(F.lit(0), F.col("last"))))
           .select("u", "h", F.least("t", "s").alias("a"), F.greatest("t", "s").alias("b"), "t"))
    zero = F.lit(0)
    seats = materialize(cut.unionByName(seated.where("tiles = 1").select(
        "u", "h", zero.alias("a"), zero.alias("b"), zero.alias("t"))), "jaccard-seats")
    sent = seats.join(named.select("u", "bytes"), "u").agg(F.sum("bytes")).first()[0] or 0
    met = (seats.join(named.select("u", "items"), "u")
           .withColumn("bucket", F.pmod(F.xxhash64("h", "a", "b"), F.lit(max(1, -(-sent // VERIFY_BYTES)))).cast("int")))

    def verify(part: pa.Table) -> pa.Table:
        h, a, b, t, u = (part.column(c).to_numpy() for c in ("h", "a", "b", "t", "u"))
        items_ = part.column("items")
        order = np.lexsort((u, b, a, h))
        key = np.stack([h[order], a[order], b[order]])
        edge = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
        out: list[tuple] = []
        for i, j in zip(edge, np.append(edge[1:], len(order))):
            own = order[i:j]
            if len(own) > 1:
                pairs = links([np.frombuffer(items_[int(k)].as_py(), np.uint64) for k in own], percent)
                if a[own[0]] != b[own[0]] and len(pairs):  # pairs inside a tile meet elsewhere
                    side = t[own]
                    pairs = pairs[side[pairs[:, 0]] != side[pairs[:, 1]]]
                out += forest(pairs, u[own].tolist())
        cols = list(zip(*out)) or [(), ()]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64())], ["u", "v"])

    found = met.groupBy("bucket").applyInArrow(verify, "u long, v long")

    # groups that share a shingle but no home: pairs of disjoint lists of homes
    lists = at_home.groupBy("grp").agg(F.sort_array(F.collect_set("h")).alias("at"))
    away = live.join(homes, "h", "left_anti").join(lists, "grp").select("h", "grp", "at", F.xxhash64("at").alias("k"))
    away = materialize(away, "jaccard-away")
    kinds = away.select("h", "k", "at").dropDuplicates(["h", "k"])
    other = kinds.select("h", F.col("k").alias("k2"), F.col("at").alias("at2"))
    apart = kinds.join(other, "h").where("k < k2 AND NOT arrays_overlap(at, at2)").select("h", "k", "k2")
    listed = (apart.join(away.select("h", "k", "grp"), ["h", "k"])
              .join(away.select("h", F.col("k").alias("k2"), F.col("grp").alias("grp2")), ["h", "k2"])
              .select("grp", "grp2").distinct())
    one = named.select("grp", F.col("u").alias("u"), F.col("items").alias("x"))
    two = named.select(F.col("grp").alias("grp2"), F.col("u").alias("v"), F.col("items").alias("y"))

    rest = listed.join(one, "grp").join(two, "grp2").select("u", "v", "x", "y").mapInArrow(test, "u long, v long")
    label = components(found.unionByName(rest).unionByName(near))

    known = (rows.where("n > 0").select("id", "n", "unit", "row").join(units, "unit")
             .join(label, "u", "left").select("id", "n", "row", F.coalesce("label", "u").alias("component_id")))
    blank = rows.where("n = 0").select("id", "n", "row", F.col("id").alias("component_id"))
    if row_col:
        first = known.groupBy("component_id").agg(F.min(F.struct("id", "row")).alias("first"))
        known = known.join(first, "component_id").withColumn("kept", F.struct("id", "row") == F.col("first")).drop("first")
        blank = blank.withColumn("kept", F.lit(True))
    real = lambda c: F.when(F.col(c) < NAMELESS, F.col(c))
    return known.unionByName(blank).select(real("id").alias(id_col), F.col("n").alias("n_shingles"),
                                           real("component_id").alias("component_id"),
                                           *([F.col("row").alias(row_col), "kept"] if row_col else []))
