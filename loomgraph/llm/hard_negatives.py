"""Hard negatives by inner product, with pruning by length and coordinates.

All vectors are ranked by length and cut, longest first, into *buckets* of
bounded size. Anchors and buckets meet in a stream: the rows of a bucket come
first, and the worker keeps them with one sorted list of (direction's
coordinate, row) per coordinate; then the anchors sent to that bucket pass by. An
anchor that needs a score of ``need`` can only be satisfied, in a bucket whose
longest vector has length ``l``, by directions within the angle
``acos(need / (|anchor| * l))`` of its own. That leaves

* no vector at all if the quotient exceeds one (the bucket is not even sent the
  anchor), and else
* for each coordinate an interval of feasible values. The intervals of the
  anchor's largest coordinates (its focus) are looked up in the sorted lists, the
  rows found in all of them are the candidates, and only those get their exact
  integer inner product. An anchor whose lists exclude little is scored against
  the whole bucket in one matrix product with others of its kind.

Buckets are searched in rounds of growing size: one, then ``GROWTH`` times as
many as before. Between rounds the best of each anchor are merged, and the
k-th score of those becomes its need for the next, so a round brings
about ``GROWTH * k`` rows an anchor, whatever the number of buckets. Nothing is
lost: a row is skipped only if its score is proven to be below the need.

A bucket meets all anchors not excluded by length (a stated query set against
all rows, in blocks). Anchors and bucket rows travel as plain rows; a bucket is
sent once for every ``ASKS`` anchors, so that no task meets more than those and
the copies stay a quarter of the anchors' bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.llm.ordinals import with_ordinal
from loomgraph.session import materialize, release

GROWTH = 8
ASKS = 1 << 16         # anchors that meet a bucket in one task, about
SLACK = 1e-9           # rounding of directions and angles
EXACT = float(1 << 53)  # products below this are exact in doubles
NO_ID = np.iinfo(np.int64).max  # a null id orders last


class Bucket:
    """Vectors of similar length with a sorted list per coordinate."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, v: np.ndarray):
        self.rows, self.ids, self.labels, self.v = rows, ids, labels, v
        self.real = v.astype(np.float64)
        length = np.sqrt((self.real ** 2).sum(axis=1))
        self.longest, self.shortest = float(length.max()), float(length.min())
        direction = self.real / np.where(length > 0, length, 1.0)[:, None]
        self.order = np.argsort(direction, axis=0, kind="stable").astype(np.int32).T.copy()
        self.sorted = np.take_along_axis(direction, self.order.T, axis=0).T.copy()

    def cosine(self, need: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Least cosine that a vector of this bucket needs to score ``need``."""
        far = length * np.where(need > 0, self.longest, self.shortest)
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(far > 0, need / far, np.where(need > 0, np.inf, -1.0))
        return np.maximum(least, -1.0) - SLACK

    def candidates(self, direction: np.ndarray, least: float, focus: int) -> np.ndarray | None:
        """Rows whose focus coordinates are all feasible; None if the lists
        leave more than a quarter of the rows."""
        if least <= -1 or not len(direction):
            return None
        coords = np.argsort(-np.abs(direction), kind="stable")[:focus]
        own, angle = np.arccos(np.clip(direction[coords], -1, 1)), np.arccos(min(least, 1.0))
        low = np.cos(np.minimum(own + angle, np.pi)) - SLACK
        high = np.cos(np.maximum(own - angle, 0.0)) + SLACK
        spans = [(np.searchsorted(self.sorted[c], a, "left"), np.searchsorted(self.sorted[c], b, "right"))
                 for c, a, b in zip(coords, low, high)]
        if min(b - a for a, b in spans) * 4 > len(self.ids):
            return None
        met = np.zeros(len(self.ids), np.int8)
        for c, (a, b) in zip(coords, spans):
            met[self.order[c, a:b]] += 1
        return np.flatnonzero(met == len(spans))

    def scores(self, rows: np.ndarray | None, q: np.ndarray) -> np.ndarray:
        """Exact inner products of rows (None: all) with the columns of ``q``."""
        size = np.sqrt((q.astype(np.float64) ** 2).sum(axis=0)).max(initial=0.0) * self.longest
        x, y = (self.real, q.astype(np.float64)) if size < EXACT else (self.v, q)
        return ((x if rows is None else x[rows]) @ y).astype(np.int64)


def best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best: larger score, smaller id, earlier row."""
    some = np.arange(len(score))
    if len(score) > k:
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return some[np.lexsort((rows[some], ids[some], -score[some]))][:k]


def _vectors(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0), np.int64)


OUT = "ask long, slot int, row long, id long, score long"


def _answers(bucket: Bucket, asks: pa.RecordBatch, k: int, same: bool, focus: int, out: list[list]) -> None:
    q = _vectors(asks.column("v"))
    length = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    direction = q / np.where(length > 0, length, 1.0)[:, None]
    number, label = asks.column("row").to_numpy(), asks.column("label").to_numpy()
    slots = asks.column("slots").to_pylist()
    need = np.array([min(max(s["low"], s["need"]) for s in of) for of in slots], dtype=np.float64)
    least = bucket.cosine(need, length)
    able = np.flatnonzero(least <= 1.0)
    plain = []
    found: list[tuple[int, np.ndarray | None, np.ndarray]] = []
    for i in able:
        near = bucket.candidates(direction[i], float(least[i]), focus)
        if near is None:
            plain.append(i)
        elif len(near):
            found.append((i, near, bucket.scores(near, q[i][:, None])[:, 0]))
    if plain:
        every = bucket.scores(None, q[plain].T)
        found += [(i, None, every[:, j]) for j, i in enumerate(plain)]
    for i, near, score in found:
        rows = bucket.rows if near is None else bucket.rows[near]
        labels = bucket.labels if near is None else bucket.labels[near]
        ids = bucket.ids if near is None else bucket.ids[near]
        fits = (labels == label[i]) == same
        fits &= rows != number[i]
        for s in slots[i]:
            ok = np.flatnonzero(fits & (score >= max(s["low"], s["need"])) & (score <= s["high"]))
            for p in ok[best(score[ok], ids[ok], rows[ok], k)]:
                out.append([number[i], s["slot"], rows[p], ids[p], score[p]])


def _streamed(k: int, same: bool, focus: int):
    """Worker over rows sorted by bucket, the bucket's own rows first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, bucket = None, [], None
        for whole in batches:
            place = list(zip(*(whole.column(c).to_pylist() for c in ("dim", "bucket", "part", "asks"))))
            edges = [0, *(i for i in range(1, len(place)) if place[i] != place[i - 1]), len(place)]
            out: list[list] = []
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if place[a][:3] != key:
                    key, parts, bucket = place[a][:3], [], None
                part = whole.slice(a, b - a)
                if not place[a][3]:
                    parts.append(part)
                    continue
                if bucket is None:  # all rows of the bucket have come
                    rows = pa.Table.from_batches(parts)
                    ids = rows.column("id").fill_null(NO_ID).to_numpy()
                    bucket = Bucket(rows.column("row").to_numpy(), ids, rows.column("label").to_numpy(),
                                    _vectors(rows.column("v").combine_chunks()).astype(np.int64))
                    parts = []
                for i in range(0, part.num_rows, 256):
                    _answers(bucket, part.slice(i, 256), k, same, focus, out)
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["ask", "slot", "row", "id", "score"])
    return run


def search(buckets: DataFrame, shape: DataFrame, asks: DataFrame, k: int, same: bool, focus: int) -> DataFrame:
    """``(ask, slot, row, id, score)``: for each slot of each ask the ``k``
    best rows with a score in its range and the ask's label (``same``) or
    another one, never the ask's own row."""
    last = shape.agg(F.max("bucket")).first()[0]
    copies = max(1, -(-asks.count() // ASKS))
    found, at, width = None, 0, 1
    while last is not None and at <= last:
        now = asks
        if found is not None:  # the k-th score so far is what the rest must reach
            reached = (found.groupBy("ask", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
                       .where(F.col("n") >= k).groupBy("ask")
                       .agg(F.map_from_entries(F.collect_list(F.struct("slot", "kth"))).alias("kth")))
            now = (asks.join(reached.withColumnRenamed("ask", "row"), "row", "left")
                   .withColumn("slots", F.transform("slots", lambda s: F.struct(
                       s["slot"].alias("slot"), s["low"].alias("low"), s["high"].alias("high"),
                       F.coalesce(F.element_at("kth", s["slot"]), s["need"]).alias("need")))).drop("kth"))
        need = F.array_min(F.transform("slots", lambda s: F.greatest(s["low"], s["need"]))).cast("double")
        length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))
        sent = (now.withColumn("bucket", F.explode(F.sequence(F.lit(at).cast("long"), F.lit(min(at + width - 1, last)).cast("long"))))
                .withColumn("dim", F.size("v")).join(shape, ["dim", "bucket"])
                .where(need <= length * F.col("longest") * (1 + 1e-9)))
        mixed = (buckets.where(F.col("bucket").between(at, at + width - 1))
                 .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
                 .select("dim", "bucket", "part", F.lit(False).alias("asks"), "row", "id", "label", "v",
                         F.lit(None).cast("array<struct<slot:int,low:long,high:long,need:long>>").alias("slots"))
                 .unionByName(sent.select("dim", "bucket", F.pmod(F.xxhash64("row"), F.lit(copies)).cast("int").alias("part"),
                                          F.lit(True).alias("asks"), "row", "id", "label", "v", "slots")))
        new = (mixed.repartition("dim", "bucket", "part").sortWithinPartitions("dim", "bucket", "part", "asks", "row")
               .mapInArrow(_streamed(k, same, focus), OUT))
        every = new if found is None else found.unionByName(new)
        top = W.partitionBy("ask", "slot").orderBy(F.col("score").desc(), "id", "row")
        merged = materialize(every.withColumn("n", F.row_number().over(top)).where(F.col("n") <= k).drop("n"), "lemp-found")
        if found is not None:
            release(found)
        found, at, width = merged, at + width, width * GROWTH
    return found


def mine(vectors: DataFrame, is_anchor: Column, label: Column, quantised: Column | None = None, positives: int = 5,
         negatives: int = 10, low: int = 30, high: int = 90, focus: int = 4,
         bucket_values: int = 1 << 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``.

    An anchor's positives are its ``positives`` best other rows of its label;
    for each, the ``negatives`` best rows of another label whose score lies
    between ``low`` and ``high`` percent of the positive's (in integers:
    ``low * p <= 100 * n <= high * p`` with ``0 <= low < high``, so a negative
    ``p`` has none). Scores are integer inner products of
    ``quantised`` (default: the floor of 256 times each component); ties go to
    the smaller id, then the earlier row.

    Rows with a null label or a vector that is null or holds a null or a
    non-finite component take no part; zero vectors do, with scores of 0. Vectors
    of different lengths (dimensions) never meet. Rows are told apart by
    place: a repeated row is another row, equal to its copy, and a row with a
    null id is no anchor but is found, after all other ids. Components have to
    leave sums of products within 64 bits. Extra columns are ignored; an empty
    table, or one without anchors, gives no rows. Buckets hold ``bucket_values``
    components, 1,024 rows at least and 16,384 at most, so memory does not depend on
    the table.
    """
    v = F.col(vec_col)
    whole = v.isNotNull() & ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    units = quantised if quantised is not None else F.transform(v, lambda e: F.floor(e.cast("double") * 256).cast("long"))
    rows = vectors.where(whole).select(F.col(id_col).cast("long").alias("id"), label.cast("int").alias("label"),
                                       units.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = rows.where("label IS NOT NULL").withColumn("dim", F.size("v"))
    length = F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    rows = with_ordinal(rows.withColumn("len2", length), ["dim"], [F.col("len2").desc(), F.col("id").asc_nulls_last()],
                        "lemp-rows")
    per = F.greatest(F.lit(1024), F.least(F.lit(16384), F.floor(F.lit(bucket_values) / F.greatest(F.lit(1), F.col("dim")))))
    rows = materialize(rows.withColumn("bucket", F.floor(F.col("ordinal") / per))
                       .withColumn("row", F.monotonically_increasing_id()), "lemp-buckets")
    shape = materialize(rows.groupBy("dim", "bucket").agg(F.sqrt(F.max("len2")).alias("longest")), "lemp-shape")

    span = F.struct(F.lit(0).alias("slot"), F.lit(-(1 << 62)).alias("low"), F.lit(1 << 62).alias("high"),
                    F.lit(-(1 << 62)).alias("need"))
    anchors = rows.where("anchor").select("row", "id", "label", "v")
    near = search(rows, shape, anchors.withColumn("slots", F.array(span)), positives, True, focus)
    if near is None:
        return vectors.sparkSession.range(0).select(
            *[F.col("id").cast(t).alias(c) for c, t in (("anchor_id", "long"), ("positive_id", "long"), ("rank", "int"),
              ("negative_id", "long"), ("positive_score", "long"), ("negative_score", "long"))])
    order = W.partitionBy("ask").orderBy(F.col("score").desc(), "id", "row")
    pairs = materialize(near.select("ask", F.row_number().over(order).alias("slot"), F.col("id").alias("positive_id"),
                                    F.col("score").alias("positive_score")), "lemp-positives")
    ranges = pairs.where("positive_score >= 0").select("ask", F.struct(
        "slot", F.expr(f"(positive_score * {low} + 99) div 100").alias("low"),
        F.expr(f"positive_score * {high} div 100").alias("high"), F.lit(-(1 << 62)).alias("need")).alias("s"))
    ranges = ranges.where("s.low <= s.high").groupBy("ask").agg(F.sort_array(F.collect_list("s")).alias("slots"))
    asks = anchors.join(ranges.withColumnRenamed("ask", "row"), "row")
    hard = search(rows, shape, asks, negatives, False, focus)
    place = W.partitionBy("ask", "slot").orderBy(F.col("score").desc(), "id", "row")
    names = anchors.select(F.col("row").alias("ask"), F.col("id").alias("anchor_id"))
    null_again = lambda c: F.when(F.col(c) < NO_ID, F.col(c))
    return (hard.withColumn("rank", F.row_number().over(place)).join(pairs, ["ask", "slot"]).join(names, "ask")
            .select("anchor_id", null_again("positive_id").alias("positive_id"), "rank", null_again("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
