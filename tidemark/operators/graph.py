"""Reachability by iterated joins: every round is written out, so that lost executors cost one round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .baseline import written


def components(edges: DataFrame) -> DataFrame:
    """node, comp: the smallest node reachable over edges (a, b), for all nodes of edges.

    Labels go to the neighbours' least and then to that label's own label (pointer jumping), until none changes.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m"))
        new = labels.join(near, "node").select("node", F.least("comp", "m").alias("comp"), F.col("comp").alias("old"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = written(new.join(jump, "comp", "left").select("node", F.least("comp", "up").alias("comp"), "old"), "labels")
        if not new.filter("comp <> old").limit(1).count():
            return new.select("node", "comp")
        labels = new.select("node", "comp")


def alias_groups(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """name, canonical, names: every name with its group's most frequent one (of equals the newest, then the greatest) and
    the group's size.

    names: name, n, newest, one row a name. pairs: a, b, joined by hand: groups follow chains of any length, over names that
    `names` lacks too. Pairs with a null join nothing; a name in no pair is its own group.
    """
    comp = components(pairs.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")).select(F.col("node").alias("name"), "comp")
    rows = names.select("name", "n", "newest").join(comp, "name", "left").withColumn("grp", F.coalesce("comp", "name"))
    best = F.max_by("name", F.struct("n", "newest", "name")).alias("canonical")
    return rows.join(rows.groupBy("grp").agg(best, F.count("*").alias("names")), "grp").select("name", "canonical", "names")
