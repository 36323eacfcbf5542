"""Merkle manifest of a dataset by a butterfly exchange.

Every row is a leaf; per source the leaves, in id order, form a tree of fanout
three, and the sources' roots form one more tree above. The leaves of a source
are cut into aligned blocks of ``3 ** block_levels``, each of which builds the
bottom of the tree by itself. What is above the blocks is found by an exchange
among them: a subtree is *held* by all of its blocks, each of which knows its
root. In a round the blocks of the three subtrees of one parent are paired by
their place in their subtree (its *lane*), swap the three roots, and each hashes
the parent for itself. A block thereby collects the siblings on its own way
up, and after the last round holds the whole upper proof; nothing is sent down
again. Where a parent's subtrees hold different numbers of blocks, as at the
end of a source and between sources, the blocks of a smaller one answer in
every lane that is theirs modulo its size. A round moves at most three rows a
block of the widest subtree, whatever the number of leaves.

A source is cut into blocks by range-sorted positions, so a source with a third
of all rows is as many blocks as any other rows; texts are hashed where they are
read and never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.llm.ordinals import with_ordinal
from loomgraph.session import materialize

FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(values: list[Column]) -> Column:
    """Hash of the fields: ``-`` if null, else UTF-8 byte count, ``:``, value."""
    def field(v: Column) -> Column:
        s = v.cast("string")
        return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return digest(*map(field, values))


def levels(leaves: Column, several: Column, block_levels: int) -> Column:
    """Digests of a block's subtree, level by level from its leaves: up to
    ``block_levels`` levels where the source has ``several`` blocks (a single
    digest is hashed on), else until one digest remains."""
    def up(low: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.size(low) / FANOUT).cast("int") - 1)
        return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(low, i * FANOUT + 1, FANOUT), ""), 256))

    def step(acc: Column, _: Column) -> Column:
        top = F.element_at(acc, -1)
        return F.when(several | (F.size(top) > 1), F.concat(acc, F.array(up(top)))).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(block_levels)), F.array(leaves), step)


def siblings(low: Column, at: Column) -> Column:
    """The other digests of the run of ``low`` that holds position ``at``:
    those left of it and those right of it, each as one string."""
    first = (F.floor(at / FANOUT) * FANOUT).cast("int")
    place = (at - first).cast("int")
    return F.struct(F.array_join(F.slice(low, first + 1, place), "").alias("left"),
                    F.array_join(F.slice(low, (at + 2).cast("int"), F.lit(FANOUT - 1) - place), "").alias("right"))


def folded(leaf: Column, path: Column) -> Column:
    """Root that ``leaf`` leads to along ``path``, bottom first."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def swap(held: DataFrame, parent: list[str]) -> DataFrame:
    """One round. ``held`` has a row per block: ``who`` (what it is),
    ``digit`` (its subtree's place below the parent, whose key is in the columns
    ``parent``), ``idx`` of ``size`` blocks in the subtree, ``widest`` (blocks of
    the parent's widest subtree), ``before`` (blocks of the subtrees left of
    it), ``node`` (the subtree's root) and ``path``. Returns ``who``, ``idx`` in
    the parent's subtree, ``node`` and ``path`` one level higher."""
    own = F.col("lane") == F.col("idx")
    sent = held.withColumn("lane", F.explode(F.sequence(F.col("idx"), F.col("widest") - 1, F.col("size"))))
    # at most three rows a lane: one of each subtree
    lanes = sent.groupBy(*parent, "lane").agg(F.sort_array(F.collect_list(F.struct(
        "digit", "node", own.alias("own"), (F.col("idx") + F.col("before")).alias("idx"),
        F.when(own, F.col("who")).alias("who"), F.when(own, F.col("path")).alias("path")))).alias("of"))
    lanes = lanes.withColumn("nodes", F.transform("of", lambda m: m["node"]))
    lanes = lanes.withColumn("up", F.sha2(F.array_join("nodes", ""), 256))
    return (lanes.select("nodes", "up", F.explode(F.filter("of", lambda m: m["own"])).alias("m"))
            .select("m.who", "m.idx", F.col("up").alias("node"),
                    F.concat(F.col("m.path"), F.array(siblings(F.col("nodes"), F.col("m.digit")))).alias("path")))


def rounds(n: int) -> int:
    """Levels from ``n`` nodes to one."""
    return 0 if n <= 1 else 1 + rounds(-(-n // FANOUT))


def upper_proofs(blocks: DataFrame, sources: DataFrame) -> DataFrame:
    """``(src, block, subroot, root, path)`` per block by the exchange.

    ``blocks`` is ``(src, block, node)``: numbers from 0 and the block's digest;
    ``sources`` is ``(src, n_blocks)``, one row per source.
    """
    most = sources.agg(F.max("n_blocks").alias("blocks"), F.count(F.lit(1)).alias("sources")).first()
    state = blocks.join(sources, "src").select(
        F.struct("src", "block", "n_blocks", F.lit(None).cast("string").alias("subroot")).alias("who"),
        F.lit(0).cast("long").alias("idx"), "node", F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    width = 1
    block, n = F.col("who.block"), F.col("who.n_blocks")
    for _ in range(rounds(most["blocks"] or 0)):  # inside sources: sizes follow from the block's number
        tree = F.floor(block / width)
        low = F.floor(tree / FANOUT) * FANOUT * width  # the parent's first block
        held = state.where(n > width).withColumns({
            "src": F.col("who.src"), "low": low, "digit": tree % FANOUT, "before": tree * width - low,
            "size": F.least(F.lit(width), n - tree * width), "widest": F.least(F.lit(width), n - low)})
        state = materialize(swap(held, ["src", "low"]).unionByName(state.where(n <= width)), "merkle-round")
        width *= FANOUT
    state = state.withColumn("who", F.struct("who.src", "who.block", "who.n_blocks", F.col("node").alias("subroot")))
    shape = sources.select(F.col("src").alias("tree"), F.col("n_blocks").alias("size"))
    width = 1
    for _ in range(rounds(most["sources"])):  # between sources: sizes are sums of block counts
        around = W.partitionBy("parent")
        shape = materialize(
            shape.withColumn("parent", F.floor(F.col("tree") / FANOUT)).withColumn("widest", F.max("size").over(around))
            .withColumn("before", F.coalesce(F.sum("size").over(
                around.orderBy("tree").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))), "merkle-shape")
        held = (state.withColumn("tree", F.floor(F.col("who.src") / width)).join(shape, "tree")
                .withColumn("digit", F.col("tree") % FANOUT))
        state = materialize(swap(held, ["parent"]), "merkle-round")
        shape = shape.groupBy(F.col("parent").alias("tree")).agg(F.sum("size").alias("size"))
        width *= FANOUT
    return state.select("who.src", "who.block", "who.subroot", F.col("node").alias("root"), "path")


def manifest(docs: DataFrame, tampered: Column | None = None, block_levels: int = 7, id_col: str = "doc_id",
             group_col: str = "source", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``(id, leaf, subroot, root, path, leaf_now)``, one row per input row.

    ``path`` lists, from the leaf's run up to the root's, the digests left and
    right of the row's ancestor, so ``folded(leaf, path)`` is the root. With
    ``tampered`` (a replacement of the last of ``fields``) ``leaf_now`` is the
    leaf digest of the replaced row, else the leaf itself.

    A null field is hashed as ``-`` and an empty text as ``0:``, so they
    differ. A null source is a source, the first one. Rows of one source order
    by id, null ids first; rows with equal ids by their leaf digests, so equal
    rows are interchangeable and each has a place of its own. A source of one
    row is its own subroot with an empty path below; a single source's subroot
    is the root. Extra columns are ignored; an empty table gives no rows.
    """
    leaf = leaf_digest([F.col(c) for c in fields])
    now = leaf if tampered is None else leaf_digest([*(F.col(c) for c in fields[:-1]), tampered])
    rows = docs.select(F.col(group_col).alias("_s"), F.col(id_col).alias("_id"), leaf.alias("_leaf"), now.alias("_now"))
    rows = with_ordinal(rows, ["_s"], [F.col("_id").asc_nulls_first(), F.col("_leaf"), F.col("_now")], "merkle-leaves")

    names = with_ordinal(rows.groupBy("_s").agg(F.count(F.lit(1)).alias("_n")), [], [F.col("_s").asc_nulls_first()],
                         "merkle-sources")
    span = FANOUT ** block_levels
    sources = materialize(names.select("_s", F.col("ordinal").alias("src"), F.ceil(F.col("_n") / span).alias("n_blocks")),
                          "merkle-sources")
    rows = rows.join(sources.withColumnRenamed("_s", "_t"), F.col("_s").eqNullSafe(F.col("_t")))

    # a block holds at most ``span`` leaves
    blocks = (rows.withColumn("block", F.floor(F.col("ordinal") / span))
              .groupBy("src", "n_blocks", "block")
              .agg(F.sort_array(F.collect_list(F.struct("ordinal", "_id", "_leaf", "_now"))).alias("of")))
    blocks = materialize(blocks, "merkle-blocks")
    tree = levels(F.transform("of", lambda x: x["_leaf"]), F.col("n_blocks") > 1, block_levels)
    tops = blocks.select("src", "block", F.element_at(F.element_at(tree, -1), 1).alias("node"))
    proofs = upper_proofs(tops, sources.select("src", "n_blocks"))

    def place(x: Column, i: Column) -> Column:
        below = F.transform(F.slice("tree", 1, F.size("tree") - 1), lambda low, lvl: siblings(
            low, F.floor(i / F.pow(F.lit(FANOUT), lvl)).cast("int")))
        return F.struct(x["_id"].alias("id"), x["_leaf"].alias("leaf"), x["_now"].alias("now"),
                        F.concat(below, F.col("path")).alias("path"))

    return (blocks.join(proofs, ["src", "block"]).withColumn("tree", tree)
            .select("subroot", "root", F.explode(F.transform("of", place)).alias("r"))
            .select(F.col("r.id").alias(id_col), F.col("r.leaf").alias("leaf"), "subroot", "root",
                    F.col("r.path").alias("path"), F.col("r.now").alias("leaf_now")))
