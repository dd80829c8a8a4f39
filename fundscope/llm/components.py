"""Connected components of a link table, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.llm.common import discard, salted_join, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, comp`` for every node with a link; ``comp`` is the least node of its component.

    Each round every node takes the least label among itself and its neighbours, then the
    label of that label (pointer jumping), so chains shrink by half a round. Rounds are
    written to the shared folder, the last one stays. A hot node's links are dealt over salted tasks.
    """
    forth = links.select(F.col(a).alias("src"), F.col(b).alias("dst"))
    both = stored(forth.unionByName(forth.select(F.col("dst").alias("src"),
                                                 F.col("src").alias("dst"))).distinct(), "links")
    last = labels = stored(both.groupBy(F.col("src").alias("node"))
                           .agg(F.least(F.min("dst"), F.col("src")).alias("comp")), "labels")
    while True:
        near = (salted_join(both, labels.select(F.col("node").alias("dst"), "comp"), ["dst"],
                            F.col("src"))
                .groupBy("src").agg(F.min("comp").alias("near")))
        new = (labels.join(near, F.col("node") == F.col("src"))
               .select("node", F.col("comp").alias("old"),
                       F.least("comp", "near").alias("comp")))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        new = stored(salted_join(new, jump, ["comp"], F.col("node"), "left")
                     .select("node", "old", F.least("comp", F.coalesce("further", "comp"))
                             .alias("comp")), "labels")
        discard(last)
        last, labels = new, new.select("node", "comp")
        if not new.where("comp <> old").limit(1).count():
            discard(both)
            return labels
