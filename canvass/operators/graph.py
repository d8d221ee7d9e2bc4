"""Connected components of a table of links, and consensus labels inside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import discard, saved
from .skew import SMALL_ROWS, small, spread_join


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of ``links`` (a, b): component is the smallest node that links reach.

    Null ends and links of a node with itself count for nothing; repeated links count once.  Nodes in no link
    are not in the result.
    """
    steps = contractions(links)
    if not steps:
        a = links.select(F.col("a").alias("node")).limit(0)
        return a.select("node", F.col("node").alias("component"))
    few = small(steps[0])
    reached = steps[-1]
    for step in reversed(steps[:-1]):
        after = reached.select(F.col("node").alias("to"), F.col("to").alias("_end"))
        reached = spread_join(step, after, "to", "left", few).select("node", F.coalesce("_end", "to").alias("to"))
        reached = reached if few else saved(reached, "reached")
    reached = saved(reached, "reached") if few else reached
    discard(*[s for s in steps if s is not reached])
    least = reached.groupBy("to").agg(F.min("node").alias("component"))
    return spread_join(reached, least if few else saved(least, "least"), "to", known_small=few or None).select("node", "component")


def contractions(links: DataFrame) -> list[DataFrame]:
    """Saved steps (node, to), each of which sends the nodes of a graph to the nodes of a smaller one.

    Nodes have a random order.  Each goes to the first of the nodes around it and itself, and on to where
    that one goes; nodes that meet become one, and links are drawn anew between what is left.  A node that
    stays is before all its neighbours, which at most half of them are on average, so the number of steps
    grows with the logarithm of the nodes, whatever the shape: chains and stars as well.  The order
    changes every third step, lest one unlucky order last.  A hub's links are aggregated before they are
    shuffled and never joined in one task.
    """
    ends = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = saved(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    steps: list[DataFrame] = []
    while left := edges.count():
        few = True if 2 * left <= SMALL_ROWS else None  # a link has two nodes, so their table is small

        def place(node: str, seed: int = len(steps) // 3) -> Column:
            return F.struct(F.xxhash64(node, F.lit(seed)).alias("at"), F.col(node).alias("node"))

        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(place("b")).alias("first"))
        near = first.select(F.col("a").alias("node"), F.least(place("a"), "first")["node"].alias("to"))
        near = near if few else saved(near, "near")
        onward = near.select(F.col("node").alias("to"), F.col("to").alias("_on"))
        step = saved(spread_join(near, onward, "to", known_small=few).select("node", F.col("_on").alias("to")), "step")
        drawn = edges
        for end in ("a", "b"):
            drawn = spread_join(drawn, step.select(F.col("node").alias(end), F.col("to").alias("_to")), end, known_small=few).drop(end).withColumnRenamed("_to", end)
        kept = saved(drawn.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        discard(edges, near)
        steps.append(step)
        edges = kept
    return steps


def consensus(members: DataFrame, node: str, component: str, known: str) -> DataFrame:
    """members with ``label`` and ``status``: a component adopts the only value known in it.

    known: the member has a value; adopted: it takes the component's; conflict: several values are known;
    unknown: none is.
    """
    values = members.groupBy(component).agg(F.min(known).alias("_min"), F.max(known).alias("_max"))
    joined = members.join(values, component)
    one = F.col("_min") == F.col("_max")
    label = F.when(F.col(known).isNotNull(), F.col(known)).when(one, F.col("_min"))
    status = F.when(F.col("_min").isNull(), "unknown").when(~one, "conflict").when(F.col(known).isNotNull(), "known").otherwise("adopted")
    return joined.select(node, component, label.alias("label"), status.alias("status"))


def chain_root(df: DataFrame, order: list[str], edges: dict[str, tuple[str, str]]) -> DataFrame:
    """Components of links between fixed periods that form a tree, without iteration.

    ``order`` lists periods so that each but the first hangs on an earlier one; ``edges`` names, for a
    period, its parent and the flag column that says whether this row's key is linked across.  Adds
    root_<period>: the period at the root of its component.
    """
    for p in order:
        if p in edges:
            parent, flag = edges[p]
            df = df.withColumn(f"root_{p}", F.when(F.col(flag), F.col(f"root_{parent}")).otherwise(p))
        else:
            df = df.withColumn(f"root_{p}", F.lit(p))
    return df
