"""Graph operators over two DataFrames: ``vertices(id, ...)`` and undirected
``edges(src < dst, weight)`` (N1, N3-N5, J5, J6, A4).

Everything is joins and aggregations keyed by vertex or community id, so a
graph partitions like any other table; no adjacency is collected anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.session import materialize, release


def edge_ends(edges: DataFrame, weight: str = "weight") -> DataFrame:
    """Both endpoints of every undirected edge: ``(node, other, weight)``."""
    return (edges.select(F.col("src").alias("node"), F.col("dst").alias("other"), F.col(weight).alias("weight"))
            .unionByName(edges.select(F.col("dst").alias("node"), F.col("src").alias("other"),
                                      F.col(weight).alias("weight"))))


def weighted_degree(edges: DataFrame, weight: str = "weight") -> DataFrame:
    """Degree and strength (sum of incident weights) per vertex."""
    return (edge_ends(edges, weight).groupBy("node")
            .agg(F.count(F.lit(1)).alias("degree"), F.round(F.sum("weight"), 6).alias("strength")))


def induced_edges(edges: DataFrame, labels: DataFrame, node: str = "id",
                  community: str = "community") -> DataFrame:
    """Edges whose two ends carry the same community label (J6): the union of
    all induced subgraphs, keyed by community."""
    ls = labels.select(F.col(node).alias("src"), F.col(community).alias("c_src"))
    ld = labels.select(F.col(node).alias("dst"), F.col(community).alias("c_dst"))
    return (edges.join(ls, "src").join(ld, "dst")
            .where(F.col("c_src") == F.col("c_dst"))
            .select(F.col("c_src").alias(community), "src", "dst", *[c for c in edges.columns
                                                                      if c not in ("src", "dst")]))


def community_sizes(labels: DataFrame, community: str = "community") -> DataFrame:
    """Members per community."""
    return labels.groupBy(community).agg(F.count(F.lit(1)).alias("size"))


def community_order(labels: DataFrame, node: str = "id", community: str = "community") -> DataFrame:
    """Communities in order of first appearance, i.e. by smallest member id
    (L4): ``(community, first_node, position)``."""
    from loomgraph.operators.chunks import global_ordinal
    first = labels.groupBy(community).agg(F.min(node).alias("first_node"))
    return global_ordinal(first, ["first_node"]).select(
        community, "first_node", (F.col("ordinal") + 1).alias("position"))


def degree_centrality(edges: DataFrame, labels: DataFrame, node: str = "id",
                      community: str = "community") -> DataFrame:
    """Unweighted degree centrality inside each community's induced subgraph
    (N4): ``degree / (n - 1)``; a single-vertex community scores 1."""
    inner = induced_edges(edges, labels, node, community)
    deg = (inner.select(community, F.col("src").alias(node))
           .unionByName(inner.select(community, F.col("dst").alias(node)))
           .groupBy(node).agg(F.count(F.lit(1)).alias("degree")))
    sizes = community_sizes(labels, community)
    return (labels.select(node, community).join(sizes, community).join(deg, node, "left")
            .select(node, community, F.coalesce("degree", F.lit(0)).cast("long").alias("degree"),
                    F.col("size").cast("long").alias("size"),
                    F.when(F.col("size") <= 1, F.lit(1.0))
                    .otherwise(F.coalesce("degree", F.lit(0)) / (F.col("size") - 1))
                    .alias("centrality")))


def top_fraction(centrality: DataFrame, fraction_tenths: int = 9, node: str = "id",
                 community: str = "community") -> DataFrame:
    """First ``int(0.9 * n)`` members of each community by centrality desc,
    ties by id (W2, L3). A community of one keeps nobody. Ranks are the members
    above in the histogram of centralities plus the place in the own bin, so no
    window spans a community."""
    from loomgraph.operators.chunks import ordinal_in_group
    # members of equal centrality form a bin; only bins (few a community) are ordered in a window
    higher = Window.partitionBy(community).orderBy(F.col("centrality").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bins = (centrality.groupBy(community, "centrality").agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_above", F.coalesce(F.sum("_n").over(higher), F.lit(0))).drop("_n"))
    keep = F.floor((F.col("size") * F.lit(fraction_tenths)) / F.lit(10))
    reached = (centrality.join(bins, [community, "centrality"]).where(F.col("_above") < keep)
               .withColumn("_bin", F.struct(community, "centrality")))
    return (ordinal_in_group(reached, "_bin", node)
            .withColumn("rank", (F.col("_above") + F.col("ordinal") + 1).cast("long"))
            .where(F.col("rank") <= keep).select(*centrality.columns, "rank"))


def modularity(edges: DataFrame, labels: DataFrame, node: str = "id",
               community: str = "community", weight: str = "weight") -> DataFrame:
    """Newman modularity of a labelling (N3): ``sum_c in_c/2m - (tot_c/2m)^2``.

    ``in_c`` counts both directions of every intra-community edge, ``tot_c``
    is the total strength of the community. One row: ``(modularity)``.
    """
    lab = labels.select(F.col(node).alias("node"), F.col(community).alias("c"))
    ends = edge_ends(edges, weight).join(lab, "node")
    olab = lab.select(F.col("node").alias("other"), F.col("c").alias("c_other"))
    ends = ends.join(olab, "other")
    per_c = ends.groupBy("c").agg(
        F.sum("weight").alias("tot"),
        F.sum(F.when(F.col("c") == F.col("c_other"), F.col("weight")).otherwise(F.lit(0.0))).alias("inside"))
    # sum_c tot_c == 2m, so one more aggregate gives every term
    tot = per_c.agg(F.sum("inside").alias("s_in"), F.sum("tot").alias("m2"),
                    F.sum(F.col("tot") * F.col("tot")).alias("s_tot2"))
    return tot.select(F.round(F.col("s_in") / F.col("m2") - F.col("s_tot2") / (F.col("m2") * F.col("m2")),
                              6).alias("modularity"))


def connected_components(edges: DataFrame, src: str = "u", dst: str = "v") -> DataFrame:
    """``(id, component)`` of every vertex with an edge: the smallest id
    reachable.

    Each round gives a vertex the smallest label among its neighbours and then
    the label of that label, so distances halve where labels already agree; rounds
    end when nothing changes. A round is two joins keyed by vertex, written as a
    table, and the previous one is released.
    """
    both = materialize(edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
                       .unionByName(edges.select(F.col(dst).alias("u"), F.col(src).alias("v"))).distinct(), "cc-ends")
    labels = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")), "cc-labels")
    while True:
        near = (both.join(labels.select(F.col("u").alias("v"), "label"), "v")
                .groupBy("u").agg(F.min("label").alias("near")))
        low = labels.join(near, "u").select("u", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        far = labels.select(F.col("u").alias("mid"), F.col("label").alias("far"))
        new = materialize(low.join(far, "mid", "left").select("u", F.least("mid", F.coalesce("far", "mid")).alias("label"), "old"),
                          "cc-labels")
        done = new.where("label <> old").limit(1).count() == 0
        release(labels)
        labels = new
        if done:
            return labels.select(F.col("u").alias("id"), F.col("label").alias("component"))
