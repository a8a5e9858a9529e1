"""Connected components of a link table, by spreading and shortening minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import stored, stored_counting


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is its smallest node.

    Each round takes the least label among a node's neighbours, then the label of its label, so
    chains shorten by doubling. A round is a pair of joins written to the shared folder; nothing
    but the number of changed labels comes to the driver. Hubs cost a partial minimum per task.
    Links to null or to itself add nothing. No links: no rows.
    """
    both = stored(
        links.select("a", "b")
        .union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter(F.col("a") != F.col("b"))
        .distinct()
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
        "node", F.least("node", "least").alias("component")
    ))
    while True:
        heard = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("component").alias("_heard"))
        )
        spread = labels.join(heard, F.col("node") == F.col("a")).select(
            "node", "component", F.least("component", "_heard").alias("_next")
        )
        shorter = labels.select(
            F.col("node").alias("_via"), F.col("component").alias("_shorter")
        )
        fresh, (_, changed) = stored_counting(
            spread.join(shorter, F.col("_next") == F.col("_via")).select(
                "node",
                F.least("_next", "_shorter").alias("component"),
                (F.least("_next", "_shorter") != F.col("component")).alias("_changed"),
            ),
            F.col("_changed"),
        )
        labels = fresh.select("node", "component")
        if not changed:
            return labels
