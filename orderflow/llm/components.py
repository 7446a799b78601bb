"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import staged

_EDGES, _LABELS = "a long, b long", "id long, component long"


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to (id, component): the smallest id that each end of an edge can reach, itself included.

    Rounds of contraction: every vertex points to the neighbour, or itself, that has the lowest hash of id and
    round; edges then join what they point to, and loops and repeats go. Hashes differ from round to round, so no
    order of ids makes a long chain of rounds; a round takes away a third of the vertices or more on average. At the
    end, each vertex's chain of pointers is followed back, and the smallest id of its group is its component.

    Only tables in the shared folder pass from round to round; the driver sees one count a round. Neighbours
    are reduced before they are shuffled, so a vertex with very many edges is no bottleneck. Loops and repeated
    edges are allowed; vertices without an edge to another do not appear; no edges give an empty table.
    """
    spark = edges.sparkSession
    edges = staged(edges.where("a <> b").select("a", "b").distinct(), "edges")
    pointers = []
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        key = F.xxhash64("b", F.lit(len(pointers)))
        lowest = (both.groupBy("a").agg(F.min(F.struct(key.alias("key"), "b")).alias("low"))
                  .withColumn("own", F.xxhash64("a", F.lit(len(pointers)))))
        lowest = staged(lowest.select("a", F.when(F.col("low.key") < F.col("own"), F.col("low.b")).otherwise(F.col("a")).alias("to")),
                        "pointers")
        pointers.append(lowest)
        one = lowest.select(F.col("a"), F.col("to").alias("na"))
        two = lowest.select(F.col("a").alias("b"), F.col("to").alias("nb"))
        moved = edges.join(one, "a").join(two, "b").where("na <> nb")
        edges = staged(moved.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct(), "edges")
    if not pointers:
        return spark.createDataFrame([], _LABELS)
    found = pointers[0].select(F.col("a").alias("id"), F.col("to").alias("root"))
    for step in pointers[1:]:
        found = (found.join(step, F.col("root") == F.col("a"), "left")
                 .select("id", F.coalesce("to", "root").alias("root")))
    found = staged(found, "roots")
    smallest = found.groupBy("root").agg(F.min("id").alias("component"))
    return found.join(smallest, "root").select("id", "component")
