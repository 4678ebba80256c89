"""Graph operators over edge lists: components, pointer chains, fixed-point spreading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.session import cut, release


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Labels every endpoint with the smallest node of its component: (node, component).

    Each round hangs every node on its smallest neighbour, if that is smaller (pre-aggregated before the shuffle), follows these
    links to their roots by pointer jumping, and goes on with the edges between different roots only, repeated ones too: the
    smallest neighbour is found without them being told apart, and that spares a shuffle of all edges. Two rounds halve the
    nodes that still have edges, so the rounds are logarithmic whatever the order of the nodes along a path. Rows with a null
    endpoint are ignored; self-loops give single nodes; an empty edge list gives an empty result.
    """
    both, maps = cut(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")), []
    for _ in range(max_rounds):
        ways = F.inline(F.array(*[F.struct(F.col(end).alias("node"), F.least("a", "b").alias("near")) for end in ("a", "b")]))
        hung = cut(both.select(ways).groupBy("node").agg(F.min("near").alias("component")))
        while True:
            root = hung.select(F.col("node").alias("component"), F.col("component").alias("root"))
            moved = cut(hung.join(root, "component").select("node", F.col("root").alias("component"), (F.col("root") != F.col("component")).alias("moved")))
            release(hung)
            hung = moved
            if hung.where("moved").isEmpty():
                break
        maps.append(hung)
        ends = [hung.select(F.col("node").alias(end), F.col("component").alias(f"r{end}")) for end in ("a", "b")]
        left = cut(both.join(ends[0], "a").join(ends[1], "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        release(both)
        both = left
        if both.isEmpty():
            # A round's roots are the next one's nodes.
            labels = maps[-1].select("node", "component")
            for earlier in reversed(maps[:-1]):
                last = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
                labels = earlier.select("node", "component").join(last, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
            if len(maps) > 1:
                labels = cut(labels)
                release(*maps)
            release(both)
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def collapse_chains(links: DataFrame, old: str = "old_id", new: str = "new_id", present: DataFrame | None = None) -> DataFrame:
    """Follows old -> new links to their last successor: (old_id, final_id).

    Pointer jumping doubles the covered length each round. One successor per id is kept (the
    smallest); ids on a cycle, which have no last successor, get a null final_id. Ids that are present (a column named
    like old) lead nowhere, so a chain ends at the first of them.
    """
    if present is not None:
        links = links.join(present.select(old), old, "left_anti")
    one = links.where(F.col(old).isNotNull() & F.col(new).isNotNull()).groupBy(F.col(old).alias("old_id")).agg(F.min(new).alias("to"))
    state = last = cut(one)
    # A chain of n links is covered in log n rounds; what still moves then runs in a circle.
    for _ in range(max(1, one.count()).bit_length() + 1):
        ahead = state.select(F.col("old_id").alias("to"), F.col("to").alias("next"))
        moved = cut(state.join(ahead, "to", "left").select("old_id", F.col("to").alias("was"), F.coalesce("next", "to").alias("to")))
        release(last)
        state, last = moved.select("old_id", "to"), moved
        if moved.where("was <> to").isEmpty():
            break
    looping = one.select(F.col("old_id").alias("to"), F.lit(True).alias("loops"))
    return state.join(looping, "to", "left").select("old_id", F.when(F.col("loops").isNull(), F.col("to")).alias("final_id"))
