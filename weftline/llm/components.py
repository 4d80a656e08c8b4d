"""Pairwise matches to groups: deterministic Boruvka hooking with pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.session import cut

#: Up to so many nodes (two whole numbers each) a round's pointers are broadcast; beyond it they are joined by shuffle.
BROADCAST_ROWS = 200_000


def groups_of_pairs(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Rows ``(node, group_id)``: every node of a pair, with the smallest node linked to it directly or indirectly.

    Null ends and self-pairs are no links; repeated and turned-round pairs count once; an empty
    table gives no rows; other columns are never read.

    Each round every component selects its smallest edge, ordered by its lower and then its
    higher end. That edge always leads to the component's smallest neighbour. Weights are
    distinct, so the chosen edges form trees whose only cycle is one pair that chose each
    other; the lower of the two becomes the root, and it is the tree's smallest node: whatever
    the smallest node m chooses, say w, is larger, and w's own smallest neighbour can only be m.
    Trees collapse by pointer jumping (each pass doubles the reach twice), edges take the roots as
    ends, and loops and doubles go. At least half of the components vanish in a round, so
    the rounds are logarithmic.

    Only counts reach the driver. A node with very many links does no harm: minima and
    distinct edges are combined before they are shuffled, and joins are on the pointed-to side
    unique, so adaptive execution can split their hot keys.
    """
    x, y = F.col(a), F.col(b)
    some = {"rows": F.lit(True)}
    edges, left = cut(pairs.filter(x.isNotNull() & y.isNotNull() & (x != y)).select(F.least(x, y).alias("u"), F.greatest(x, y).alias("v")).distinct(), **some)
    labels = None
    while left["rows"]:
        both = edges.select(F.inline(F.array(F.struct(F.col("u").alias("n"), F.col("v").alias("p")), F.struct(F.col("v").alias("n"), F.col("u").alias("p")))))
        hook = both.groupBy("n").agg(F.min("p").alias("p"))
        mate = hook.select(F.col("n").alias("_n"), F.col("p").alias("_p"))
        # of two that chose each other the lower is root; any other node goes on to where its choice points
        tree, seen = cut(hook.join(mate, F.col("p") == F.col("_n")).select("n", F.when(F.col("_p") == F.col("n"), F.least("n", "p")).otherwise(F.col("_p")).alias("p")), **some)
        # counted, so that pointers go to every executor only where they are few
        pointers = F.broadcast if seen["rows"] <= BROADCAST_ROWS else (lambda df: df)
        moving = True
        while moving:
            hops = tree
            for k in (1, 2, 3):
                up = tree.select(F.col("n").alias(f"_n{k}"), F.col("p").alias(f"p{k}"))
                hops = hops.join(pointers(up), F.col("p" if k == 1 else f"p{k - 1}") == F.col(f"_n{k}"))
            tree, seen = cut(hops.select("n", "p2", F.col("p3").alias("p")), moved=F.col("p") != F.col("p2"))
            tree, moving = tree.select("n", "p"), seen["moved"] > 0
        root_u, root_v = tree.select(F.col("n").alias("u"), F.col("p").alias("ru")), tree.select(F.col("n").alias("v"), F.col("p").alias("rv"))
        if labels is None:
            labels = tree.select(F.col("n").alias("node"), F.col("p").alias("group_id"))
        else:
            step = tree.select(F.col("n").alias("group_id"), F.col("p").alias("_root"))
            labels = labels.join(pointers(step), "group_id", "left").select("node", F.coalesce("_root", "group_id").alias("group_id"))
        edges, left = cut(
            edges.join(pointers(root_u), "u")
            .join(pointers(root_v), "v")
            .filter("ru <> rv")
            .select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v"))
            .distinct(),
            **some,
        )
    if labels is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("group_id"))
    return labels
