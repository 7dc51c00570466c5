"""Connected components of a graph that is held as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the component's least node) for links ``a``, ``b``.

    Alternating large and small stars: every round hangs each node's larger, then
    its smaller neighbours under the least of them, so the number of rounds grows
    with the logarithm of the longest path. It ends as soon as all links are stars:
    no node has a smaller neighbour and a second one. Each round is written to the
    shared folder. The minima are written too, so that both sides of their join are
    plain shuffles which adaptive execution can split where one node has many links.
    Loops are ignored; the roots are among the nodes. No links, no rows.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"), F.count("*").alias("n"))
        least = stored(least, "least")
        if least.where("least < a and n > 1").isEmpty():
            return least.select(F.col("a").alias("node"), F.col("least").alias("root"))
        hung = both.where("b > a").join(least.drop("n"), "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = _small_star(stored(hung.where("a <> b").distinct(), "links"))


def tree_roots(links: DataFrame) -> DataFrame:
    """As ``components`` for trees: links ``a`` < ``b``, each ``b`` at most once.

    Every node jumps to the parent of its parent until all have reached the top.
    """
    up = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    while True:
        above = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jump = up.join(above, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        jump = stored(jump, "trees")
        up = jump.drop("moved")
        if jump.where("moved").isEmpty():
            return up.unionByName(up.select(F.col("root").alias("node"), "root").distinct())


def joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (of ``components``) after further ``links`` between roots.

    A node that ``roots`` lacks is its own root. Only roots are linked anew, so
    paths that were followed before are not followed again.
    """
    over = components(links)
    lifted = over.select(F.col("node").alias("root"), F.col("root").alias("top"))
    known = roots.join(lifted, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return stored(known.unionByName(over.join(roots.select("node"), "node", "left_anti")), "roots")


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("a").agg(F.min("b").alias("least")), "least")
    hung = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    oriented = hung.unionByName(own).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return stored(oriented.where("a <> b").distinct(), "links")
