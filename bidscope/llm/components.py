"""Connected components of a link table, by minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm import store


#: Rows of a task that works on links and labels.
ROWS = 100_000


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (u, v): comp is the least node it reaches.

    Each round takes the least label among the neighbours, then the label of
    that label; both are joins on staged tables, so a node with very many links
    can be split over tasks.  Ends when a round changes nothing.  The tables are often
    far smaller than what they come from, so they have as many tasks as their rows need.
    """
    tasks = max(links.sparkSession.sparkContext.defaultParallelism, -(-2 * links.count() // ROWS))
    both = store.staged(links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
                        .where("u <> v").distinct().coalesce(tasks), "links")
    label = store.staged(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("lo"))
                         .select("node", F.least("node", "lo").alias("comp")).coalesce(tasks), "labels")
    while True:
        # a node's own label comes along as that of a neighbour, marked
        told = (both.join(label.select(F.col("node").alias("v"), "comp"), "v").select(F.col("u").alias("node"), "comp", F.lit(None).alias("was"))
                .unionByName(label.select("node", "comp", F.col("comp").alias("was"))))
        step = told.groupBy("node").agg(F.min("comp").alias("mid"), F.max("was").alias("was"))
        jump = label.select(F.col("node").alias("mid"), F.col("comp").alias("far"))
        new = store.staged(step.join(jump, "mid", "left")
                           .select("node", "was", F.least("mid", F.coalesce("far", "mid")).alias("comp")).coalesce(tasks), "labels")
        changed = not new.where("was <> comp").isEmpty()
        store.drop_staged(label)
        label = new.select("node", "comp")
        if not changed:
            store.drop_staged(both)
            return label
