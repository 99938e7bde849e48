"""Connected components of a link table, by rounds of joins on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import stored


def turned(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """One row (u, v) for each of the column pairs of every row."""
    made = F.array(*[F.struct(F.col(x).alias("u"), F.col(y).alias("v")) for x, y in pairs])
    return df.select(F.explode(made).alias("e")).select("e.u", "e.v")


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Smallest reachable member of every linked member: rows (member, component).

    Alternates two rounds until nothing changes. In the large round every member links its larger neighbours
    to the smallest of its neighbours and itself; in the small round it links its smaller neighbours and
    itself to the smallest of them. Either keeps the components and shortens the paths, so
    the rounds needed grow with the logarithm of the longest path. Neighbours of a member are never gathered in a
    task: the smallest is an aggregate that is joined back. Every round is written to the shared folder.
    """
    edges = links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u <> v")
    edges = stored(edges.distinct(), "links")
    before = None
    while True:
        both = turned(edges, ("u", "v"), ("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = turned(large.join(least, "u"), ("v", "m"), ("u", "m"))
        edges = stored(small.where("u <> v").distinct(), "small")
        print_of = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if print_of == before:
            break
        before = print_of
    roots = edges.select(F.col("v").alias("member"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("member"), F.col("v").alias("component")).unionByName(roots)
