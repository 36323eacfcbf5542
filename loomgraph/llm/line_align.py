"""Removal of line blocks that an earlier document holds, by patience diff.

Documents are sequences of line hashes (blanks at line ends stripped, blank
lines left out). A line goes from a document when any earlier document that
holds it aligns with it there; nothing is capped by how often a line occurs.

A line of one document only cannot be aligned, whatever it says, so a document is
reduced to its *form*: its shared lines in order, and a gap wherever others
stand between them. Documents of equal form align alike and are one unit (where
lines repeat between gaps, only documents of equal lines). The unit's first
document is aligned with other units; the rest lose all shared lines, as the
first has them. Trying all earlier holders of a line would cost
the square of their number, so:

1. Each unit is aligned with the earliest holder of each of its lines and
   of each pair of consecutive lines: pairs linear in the number of lines.
   This settles nearly all lines.
2. For a line left over, and each other shared line of the unit, the earliest
   unit that holds the two in the same order is aligned: again one row a pair
   of lines.
3. For what is still left over, the earlier holders that share a second line
   with the unit are listed by both lines, and all of them are aligned.
4. With any other holder the unit shares that line alone, and the result
   follows from where the line stands in the holder: its *shape*. Each shape
   that an earlier holder has is aligned once.

The first holder of a line is never the later document of a pair on it, so no
line disappears everywhere. Only hashes move until the last join, which brings
each document's removed line numbers to its text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.ordinals import with_ordinal
from loomgraph.operators.chunks import ordinal_in_group
from loomgraph.session import materialize

BLANK_ENDS = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def lines(text: Column) -> Column:
    """The non-blank lines of a text, as written."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.regexp_replace(x, BLANK_ENDS, "") != "")


def patience(a: list, b: list) -> list[int]:
    """Positions of ``b`` aligned with equal items of ``a``.

    Equal heads and tails of a stretch are aligned; between them the items
    that occur once in either stretch and keep their order (a longest
    increasing run) split it into smaller stretches. Stretches without such
    items are left alone.
    """
    out: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append(k)
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append(m)
        if i >= j or k >= m:
            continue
        once_a, once_b = Counter(a[i:j]), Counter(b[k:m])
        place = {x: p for p, x in enumerate(a[i:j], i) if once_a[x] == 1}
        anchors = [(place[x], q) for q, x in enumerate(b[k:m], k) if once_b[x] == 1 and x in place]
        tails: list[int] = []
        chain: list[tuple] = []  # per length, the last link of the run with the smallest end
        for p, q in anchors:
            n = bisect_left(tails, p)
            link = (p, q, chain[n - 1] if n else None)
            tails[n:n + 1] = [p]
            chain[n:n + 1] = [link]
        link, split = (chain[-1] if chain else None), []
        while link:
            split.append(link[:2])
            link = link[2]
        if split:
            p0, q0 = i, k
            for p, q in reversed(split):
                out.append(q)
                todo.append((p0, p, q0, q))
                p0, q0 = p + 1, q + 1
            todo.append((p0, j, q0, m))
    return sorted(out)


def unaligned(named: DataFrame, hits: DataFrame, gone: DataFrame) -> DataFrame:
    """``(u, key)``: lines of ``hits`` that stand at a position not in ``gone``."""
    at = named.join(hits.select("u").distinct(), "u", "left_semi").select("u", F.posexplode("seq").alias("g", "key"))
    return at.join(hits, ["u", "key"]).join(gone, ["u", "g"], "left_anti").select("u", "key").distinct()


def in_order(named: DataFrame, hits: DataFrame, left: DataFrame) -> DataFrame:
    """``(u, o)``: for each line ``left (u, key)`` and each other shared line of
    ``u`` the earliest unit that holds both in the same order."""
    def both(seqs: DataFrame, of: DataFrame) -> DataFrame:
        lines_ = seqs.select("u", F.explode(F.transform(F.array_distinct(F.filter("seq", lambda x: x.isNotNull())), lambda x: F.struct(
            x.alias("y"), F.array_position("seq", x).alias("at")))).alias("l")).select("u", "l.y", "l.at")
        first = lines_.join(of, [lines_["y"] == of["key"], *([lines_["u"] == of["who"]] if "who" in of.columns else [])])
        return (first.select("u", "key", F.col("at").alias("at0")).join(lines_, "u").where("y <> key")
                .select("u", "key", "y", (F.col("at") < F.col("at0")).alias("before")))

    mine = both(named.join(left.select("u").distinct(), "u", "left_semi"), left.withColumnRenamed("u", "who"))
    mine = materialize(mine.join(hits.select("u", F.col("key").alias("y")), ["u", "y"], "left_semi"), "line-orders")
    asked = mine.select("key", "y", "before").distinct()
    holds = both(named, left.select("key").distinct()).join(asked, ["key", "y", "before"], "left_semi")
    earliest = holds.groupBy("key", "y", "before").agg(F.min("u").alias("o"))
    return mine.join(earliest, ["key", "y", "before"]).where("o < u").select("u", "o").distinct()


def others(named: DataFrame, hits: DataFrame, left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the earlier holders of the lines ``left (u, key)`` can still align.

    First ``(u, o)``: the holders that share another line with ``u``, too.
    Then ``(u, key, shape)``: where ``key`` stands (``x``) between runs of
    other lines (``-``) in an earlier holder that shares no other line.
    """
    shape = F.array_join(F.transform("seq", lambda x: F.when(x == F.col("key"), "x").otherwise("-")), "")
    holders = materialize(
        named.select("u", "seq", F.explode(F.array_distinct("seq")).alias("key"))
        .join(left.select("key").distinct(), "key", "left_semi")
        .select("key", F.col("u").alias("o"), F.regexp_replace(shape, "-+", "-").alias("shape"))
        .withColumn("kind", F.xxhash64("key", "shape")), "line-holders")

    second = left.join(hits.select("u", F.col("key").alias("y")), "u").where("y <> key")
    lines_of = named.select(F.col("u").alias("o"), F.explode(F.array_distinct("seq")).alias("y"))
    held = (holders.select("key", "o", "kind").join(lines_of, "o")
            .join(second.select("key", "y").distinct(), ["key", "y"], "left_semi"))
    listed = materialize(second.join(held, ["key", "y"]).where("o < u")
                         .select("u", "key", "o", "kind").distinct(), "line-listed")

    # of n + 1 earlier holders of a shape one at least is not among n listed ones
    taken = listed.groupBy("u", "key", "kind").agg(F.count(F.lit(1)).alias("n"))
    ranked = ordinal_in_group(holders, "kind", "o")
    kinds = holders.select("key", "kind").distinct()
    alone = (left.join(kinds, "key").join(taken, ["u", "key", "kind"], "left")
             .select("u", "kind", F.coalesce("n", F.lit(0)).cast("long").alias("ordinal"))
             .join(ranked, ["kind", "ordinal"]).where("o < u").select("u", "key", "shape"))
    return listed.select("u", "o").distinct(), alone


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_lines, n_removed, text)`` per row: the remaining non-blank
    lines, as written, joined by newlines.

    Null and empty texts and texts of blank lines have no lines. Of rows with
    equal sequences of lines those with the smallest id stay as the first;
    a null id comes after all others, and of different texts under one id one
    counts as the earlier, by hash. Lines repeated inside one document are
    not removed for that. Extra columns are ignored; an empty table gives no
    rows. Lines are compared by 64-bit hashes, whole, however long.
    """
    big = F.lit((1 << 63) - 1)
    hashed = F.transform(lines(F.col("t")), lambda x: F.xxhash64(F.regexp_replace(x, BLANK_ENDS, "")))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), big).alias("id"), F.col(text_col).alias("t"))
    seqs = materialize(rows.select("id", hashed.alias("all")).where(F.size("all") > 0)
                       .withColumn("unit", F.xxhash64("all")).distinct(), "line-hashes")

    # forms: shared lines in order, null for a gap; ``place`` has each one's line number
    shared = (seqs.select(F.explode(F.array_distinct("all")).alias("key")).groupBy("key")
              .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    held = (seqs.select("id", "unit", F.size("all").alias("n"), F.posexplode("all").alias("g", "key")).join(shared, "key")
            .groupBy("id", "unit", "n").agg(F.sort_array(F.collect_list(F.struct("g", "key"))).alias("l")))
    gap = F.struct(F.lit(None).cast("int").alias("g"), F.lit(None).cast("long").alias("key"))
    gapped = F.flatten(F.transform("l", lambda x, i: F.when(
        x["g"] > F.when(i == 0, 0).otherwise(F.element_at("l", F.greatest(i, F.lit(1)))["g"] + 1), F.array(gap, x)).otherwise(F.array(x))))
    tail = F.filter(F.array(gap), lambda _: F.element_at("l", -1)["g"] < F.col("n") - 1)
    forms = held.select("id", "unit", F.concat(gapped, tail).alias("f")).select(
        "id", "unit", F.col("f.key").alias("seq"), F.col("f.g").alias("place"))
    # equal forms align whole if their lines differ or stand without gaps; else only equal texts are one unit
    lines_of = F.filter("seq", lambda x: x.isNotNull())
    whole = (F.size(F.array_distinct(lines_of)) == F.size(lines_of)) | (F.size(lines_of) == F.size("seq"))
    forms = materialize(forms.withColumn("form", F.xxhash64("seq", F.when(~whole, F.col("unit")))), "line-forms")
    named = forms.groupBy("form", "seq").agg(F.min("id").alias("first"))
    named = materialize(with_ordinal(named, [], [F.col("first"), F.col("form")], "line-order")
                        .withColumnRenamed("ordinal", "u"), "line-units")

    one = named.select("u", F.explode(F.array_distinct("seq")).alias("key"), F.lit(False).alias("pair")).where("key IS NOT NULL")
    two = (named.where(F.size("seq") > 1)
           .select("u", F.explode(F.array_distinct(F.transform(
               F.sequence(F.lit(1), F.size("seq") - 1),
               lambda i: F.when(F.element_at("seq", i).isNotNull() & F.element_at("seq", i + 1).isNotNull(),
                                F.xxhash64(F.element_at("seq", i), F.element_at("seq", i + 1)))))).alias("key"),
               F.lit(True).alias("pair")).where("key IS NOT NULL"))
    keys = one.unionByName(two)
    first = (keys.groupBy("key", "pair").agg(F.min("u").alias("o"), F.count(F.lit(1)).alias("df")).where("df > 1"))
    met = keys.join(first, ["key", "pair"]).where("u <> o").select("u", "key", "pair", "o")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def marked(seq: list, gap_: str) -> list:  # a gap equals no gap of the other side
            return [gap_ if x is None else x for x in seq]
        for batch in batches:
            gone = [patience(marked(a, "a"), marked(b, "b"))
                    for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gone, pa.list_(pa.int32()))], ["u", "gone"])

    def positions(sides: DataFrame) -> DataFrame:
        return sides.select("u", "a", "b").mapInArrow(align, "u long, gone array<int>").select("u", F.explode("gone").alias("g"))

    later = named.select("u", F.col("seq").alias("b"))
    earlier = named.select(F.col("u").alias("o"), F.col("seq").alias("a"))
    met = materialize(met, "line-met")
    pairs = met.select("u", "o").distinct()
    cut = materialize(positions(pairs.join(later, "u").join(earlier, "o")).distinct(), "line-aligned")
    hits = met.where("NOT pair").select("u", "key")
    left = materialize(unaligned(named, hits, cut), "line-left")
    if left.limit(1).count():
        ordered = materialize(in_order(named, hits, left).join(pairs, ["u", "o"], "left_anti"), "line-ordered")
        more = positions(ordered.join(later, "u").join(earlier, "o"))
        cut = materialize(cut.unionByName(more).distinct(), "line-aligned")
        pairs = pairs.unionByName(ordered)
        left = materialize(unaligned(named, hits, cut), "line-left")
    if left.limit(1).count():
        listed, alone = others(named, hits, left)
        more = positions(listed.join(pairs, ["u", "o"], "left_anti").join(later, "u").join(earlier, "o"))
        # a null stands for lines that the later document does not hold
        built = F.transform(F.split("shape", ""), lambda c: F.when(c == "x", F.col("key")))
        cut = cut.unionByName(more).unionByName(positions(alone.withColumn("a", built).join(later, "u")))
    gone = cut.groupBy("u").agg(F.collect_set("g").alias("gone"))

    # the first of a unit loses what is aligned, the others all shared lines
    units = named.join(gone, "u", "left")
    lost = F.when(F.col("id") == F.col("first"), F.transform("gone", lambda g: F.element_at("place", g + 1))) \
        .otherwise(F.filter("place", lambda g: g.isNotNull()))
    fate = forms.join(units, ["form", "seq"]).select("id", "unit", lost.alias("gone"))
    # most rows keep every line: only the others travel to the texts
    fate = fate.where("gone IS NOT NULL").distinct()
    full = rows.withColumn("unit", F.xxhash64(hashed))
    out = full.join(fate, ["id", "unit"], "left").select("id", lines(F.col("t")).alias("l"), "gone")
    kept = F.when(F.col("gone").isNull(), F.col("l")).otherwise(F.filter("l", lambda x, i: ~F.array_contains("gone", i)))
    return out.select(F.when(F.col("id") < big, F.col("id")).alias(id_col), F.size("l").cast("long").alias("n_lines"),
                      (F.size("l") - F.size(kept)).cast("long").alias("n_removed"),
                      F.array_join(kept, "\n").alias("text"))
