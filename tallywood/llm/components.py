"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.llm.tables import narrowed, stored

# Links that a task takes at least, where there are so many.
EACH = 50_000


def _star(links: DataFrame, large: bool, n_links: int) -> DataFrame:
    """Links ``high, low`` moved to the least neighbour of one of their ends.

    Large: the greater neighbours of a node go to the least of its whole
    neighbourhood.  Small: a node and its lesser neighbours go to the least of
    them.  The least neighbours are a table of their own, so that Spark can
    split the links of a node with very many.
    """
    seen = links
    if large:
        seen = links.union(links.select(F.col("low"), F.col("high")))
    least = seen.groupBy(F.col("high").alias("node")).agg(
        F.least(F.min("low"), F.first("high")).alias("least") if large else F.min("low").alias("least")
    )
    least = stored(narrowed(least, n_links, EACH), "star-least")
    met = seen.join(least, F.col("high") == F.col("node"))
    if large:
        moved = met.where("low > high").select(F.col("low").alias("high"), F.col("least").alias("low"))
    else:
        moved = met.select(F.col("low").alias("high"), F.col("least").alias("low")).union(
            least.select("node", "least")
        )
    return stored(narrowed(moved.where("high <> low").distinct(), n_links, EACH), "star-links")


def _state(links: DataFrame) -> tuple:
    """Equal for equal sets of links, in all likelihood."""
    mark = F.xxhash64("high", "low").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(mark), F.sum(F.col("low").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``high, low`` bigint, high > low).

    ``component`` is the least node that links lead to.  Each round shuffles
    the links a few times and nothing passes through the driver but their
    number; the rounds grow with the logarithm of the longest chain.
    """
    links = stored(links, "star-links")
    links = stored(narrowed(links.distinct(), links.count(), EACH), "star-links")
    state = _state(links)
    while state[0]:
        links = _star(_star(links, True, state[0]), False, state[0])
        before, state = state, _state(links)
        if before == state:
            break
    return links.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        links.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )
