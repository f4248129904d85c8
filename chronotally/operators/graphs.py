"""Chains, landings and reachability in a number of rounds that grows with the logarithm of a path's length.

Where a node has one successor, pointers are doubled: every round joins a node with what its pointer leads to, so that after
k rounds it knows what lies 2^k links ahead. General graphs are first contracted: stretches without branches become one link,
and only what is left is walked round by round. Rounds are cut by reliable checkpoints."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotally.operators.snapshots import checkpointed

#: Rows of a frontier up to which it is broadcast, so that the links are not shuffled.
BROADCAST_ROWS = 50_000

Merge = Callable[[Column, Column], Column]


def doubled(nodes: DataFrame, merges: Mapping[str, Merge], settled: Column | None = None, *, idempotent: bool = True) -> DataFrame:
    """nodes (k, jump, and a column per merge) followed to the end of their chain.

    Columns are merged with those of all nodes ahead, nearest first. Of nodes that run into a cycle ``jump`` stays set; their columns
    are right if merging is idempotent (as a minimum is), for rounds go on until nothing changes. Otherwise rounds end when none of
    the open nodes came to an end, as then all of them run into cycles: a chain has a node at every distance from its end.
    ``settled`` (over the merged columns) ends a chain early. k is unique; jump must be null or some k."""
    state, before = checkpointed(nodes), None
    while True:
        open_ = state.where("jump is not null")
        now = open_.agg(F.count("*"), F.bit_xor(F.xxhash64("k", *(merges if idempotent else ())))).first()
        if not now[0] or now == before:
            return state
        before = now
        ahead = state.select(F.col("k").alias("jump"), F.col("jump").alias("_next"), *[F.col(c).alias(f"_{c}") for c in merges])
        merged = {c: merge(F.col(c), F.col(f"_{c}")) for c, merge in merges.items()}
        moved = open_.join(ahead, "jump").select("k", F.col("_next").alias("jump"), *[v.alias(c) for c, v in merged.items()])
        if settled is not None:
            moved = moved.withColumn("jump", F.when(~settled, F.col("jump")))
        state = checkpointed(state.where("jump is null").select("k", "jump", *merges).unionByName(moved))


def _linked(nodes: DataFrame, successor: str) -> DataFrame:
    """nodes with ``successor`` only where it is a node."""
    known = nodes.select(F.col("k").alias(successor), F.lit(True).alias("_known"))
    return nodes.join(known, successor, "left").withColumn(successor, F.when(F.col("_known"), F.col(successor))).drop("_known")


def queue_chain(df: DataFrame, scope: str, id_: str, base: str, head: str, item: str, failed: str, *, listed: bool = True) -> DataFrame:
    """Items ahead of each row, following base -> head inside the scope: chain (items from the front, own last), position,
    ahead_failed.

    A head with several builds continues from the smallest id. Where a chain runs into a cycle it ends before it would meet a
    build again. A chain of n items takes about log2(n) rounds. Chains hold as many items as are output; without ``listed`` only
    counts are carried, and lists are made for what runs into cycles only."""
    build = lambda: F.struct(F.col(id_).alias("i"), F.col(item).alias("m"), F.col(failed).alias("f"))
    key = lambda c: F.struct(F.col(scope).alias("s"), F.col(c).alias("h"))
    first = F.min(F.struct(F.col(id_).alias("i"), F.col(base).alias("b"), F.struct(build()).alias("n"))).alias("r")
    nodes = df.where(F.col(head).isNotNull()).groupBy(key(head).alias("k")).agg(first)
    nodes = checkpointed(_linked(nodes.select("k", F.struct(F.col("k.s").alias("s"), F.col("r.b").alias("h")).alias("jump"), F.col("r.n").getField("col1").alias("own")), "jump"))

    def lists(nodes: DataFrame) -> DataFrame:
        """k, path: the builds from a node on, each once."""
        start = nodes.select("k", "jump", F.array("own").alias("path"), F.lit(1).alias("n"))
        merges = {"path": lambda a, b: F.array_distinct(F.concat(a, b)), "n": lambda a, b: a + b}
        return doubled(start, merges, settled=F.size("path") < F.col("n")).select("k", "path")

    rows = df.select(scope, id_, build().alias("_own"), key(base).alias("k"))
    if listed:
        rows = rows.join(lists(nodes), "k", "left").withColumn("_all", F.array_distinct(F.concat(F.array("_own"), F.coalesce("path", F.array().cast(rows.select(F.array("_own")).schema[0].dataType)))))
        ahead = F.exists(F.slice("_all", F.lit(2), F.size("_all")), lambda x: x["f"])
        return rows.select(scope, id_, F.reverse(F.transform("_all", lambda x: x["m"])).alias("chain"), F.size("_all").alias("position"), F.coalesce(ahead, F.lit(False)).alias("ahead_failed"))
    counts = doubled(nodes.select("k", "jump", F.lit(1).cast("long").alias("n"), F.coalesce("own.f", F.lit(False)).alias("f")), {"n": lambda a, b: a + b, "f": lambda a, b: a | b}, idempotent=False)
    counts = checkpointed(counts)
    cyclic = counts.where("jump is not null").select("k")
    found = counts.where("jump is null").select("k", "n", "f", F.lit(None).cast("array<struct<i:bigint>>").alias("ids"))
    if not cyclic.isEmpty():
        paths = lists(nodes.join(cyclic, "k", "left_semi"))
        found = found.unionByName(paths.select("k", F.size("path").cast("long").alias("n"), F.exists("path", lambda x: x["f"]).alias("f"), F.transform("path", lambda x: F.struct(x["i"].cast("long").alias("i"))).alias("ids")))
    rows = rows.join(found, "k", "left")
    met = F.coalesce(F.exists("ids", lambda x: x["i"] == F.col("_own.i").cast("long")), F.lit(False))
    # a row on a cycle meets itself: it is counted once, and its own failure is not ahead of it unless another one's is
    return rows.select(scope, id_, (1 + F.coalesce("n", F.lit(0)) - met.cast("int")).cast("int").alias("position"), F.coalesce("f", F.lit(False)).alias("ahead_failed"), met.alias("in_cycle"))


def ancestor_landings(tested: DataFrame, parents: DataFrame, pushes: DataFrame, scope: str) -> DataFrame:
    """Earliest push that proves each commit reached the main line: of itself ('push') or of a descendant ('ancestor-bound').

    tested (scope, sha), parents (scope, sha, parent), pushes (scope, sha, pushed_at). A commit with one child takes the minimum
    along the line of such commits by pointer doubling; only between commits with none or several children is the minimum
    passed on round by round, until nothing improves, so cycles are harmless."""
    key = lambda c: F.struct(F.col(scope).alias("s"), F.col(c).alias("c"))
    links = parents.where("parent is not null").select(key("sha").alias("child"), key("parent").alias("k")).distinct()
    children = links.groupBy("k").agg(F.count("*").alias("n"), F.min("child").alias("child"))
    own = pushes.groupBy(key("sha").alias("k")).agg(F.min("pushed_at").alias("own"))
    commits = links.select("k").union(links.select("child")).union(own.select("k")).distinct().join(own, "k", "left").join(children, "k", "left")
    lines = commits.select("k", F.when(F.col("n") == 1, F.col("child")).alias("jump"), F.struct("k", "own", F.coalesce("n", F.lit(0)).alias("n")).alias("at"), F.col("own").alias("low"))
    # `low` of a line's commits and the joint where it ends: commits with one child lead there, others are joints themselves
    lines = checkpointed(doubled(lines.select("k", "jump", "low", F.col("k").alias("last")), {"low": lambda a, b: F.least(a, b), "last": lambda a, b: b}))
    joints = checkpointed(lines.where("jump is null").join(links.select("k", "child"), "k").where(F.col("k") == F.col("last")).select("k", "child"))  # of several children
    ends = lines.select(F.col("k").alias("child"), F.col("low").alias("line_low"), F.when(F.col("jump").isNull(), F.col("last")).alias("end"))
    passes = checkpointed(joints.join(ends, "child").select("k", "line_low", "end"))
    best = checkpointed(lines.where("jump is null and k = last").select("k", F.col("low").alias("at")))
    while True:
        via = passes.join(best.select(F.col("k").alias("end"), F.col("at").alias("end_at")), "end", "left").groupBy("k").agg(F.min(F.least("line_low", "end_at")).alias("via"))
        new = best.join(via, "k", "left").select("k", F.least("at", "via").alias("at"), F.coalesce(F.col("via") < F.col("at"), F.col("via").isNotNull() & F.col("at").isNull()).alias("better"))
        new = checkpointed(new)
        if new.where("better").isEmpty():
            break
        best = new.drop("better")
    landed = lines.join(best.select(F.col("k").alias("last"), F.col("at").alias("end_at")), "last", "left")
    landed = landed.select("k", F.least("low", F.when(F.col("jump").isNull(), F.col("end_at"))).alias("at")).where("at is not null").join(own, "k", "left")
    out = tested.select(scope, "sha", key("sha").alias("k")).join(landed, "k")
    return out.select(scope, "sha", F.col("at").alias("landed_at"), F.when(F.col("own") == F.col("at"), "push").otherwise("ancestor-bound").alias("source"))


def reachable_set(roots: DataFrame, links: DataFrame, node: str, parent: str, child: str) -> DataFrame:
    """Nodes reachable from the roots over parent -> child links.

    A node with one parent that has no other child is led by its parent's leader, unless it is a root: such lines are found by
    pointer doubling and count as one step. Between leaders each round joins only the new frontier (broadcast if it was
    counted to be small), and what is seen is kept as the frontiers' own tables, put together every 16 rounds. Cycles end
    because what is seen is not visited again."""
    start = checkpointed(roots.select(F.col(node).alias("k")).where("k is not null").distinct())
    edges = checkpointed(links.select(F.col(parent).alias("p"), F.col(child).alias("c")).where("p is not null and c is not null and p <> c").distinct())
    several = edges.groupBy("p").agg(F.count("*").alias("n_children"))
    alone = edges.groupBy(F.col("c").alias("k")).agg(F.count("*").alias("n"), F.min("p").alias("p")).where("n = 1").join(several, "p").where("n_children = 1")
    led = alone.join(start, "k", "left_anti").select("k", F.col("p").alias("jump"))
    nodes = edges.select(F.col("p").alias("k")).union(edges.select("c")).union(start).distinct()
    pointers = nodes.join(led, "k", "left").select("k", "jump", F.col("k").alias("leader"), F.col("k").alias("low"))
    pointers = doubled(pointers, {"leader": lambda a, b: b, "low": lambda a, b: F.least(a, b)})
    # a cycle that no root is on and that nothing leads to has no leader; it is its smallest node's
    leaders = checkpointed(pointers.select("k", F.when(F.col("jump").isNull(), F.col("leader")).otherwise(F.col("low")).alias("leader")))
    steps = edges.join(leaders.select(F.col("k").alias("p"), F.col("leader").alias("a")), "p").join(leaders.select(F.col("k").alias("c"), F.col("leader").alias("b")), "c")
    steps = checkpointed(steps.where("a <> b").select("a", "b").distinct())
    frontier, parts = start, [start]
    while True:
        small = F.broadcast(frontier) if frontier.count() <= BROADCAST_ROWS else frontier
        step = steps.join(small, steps["a"] == small["k"], "left_semi").select(F.col("b").alias("k")).distinct()
        for part in parts:
            step = step.join(part, "k", "left_anti")
        frontier = checkpointed(step)
        if frontier.isEmpty():
            break
        parts.append(frontier)
        if len(parts) == 16:
            whole = parts[0]
            for part in parts[1:]:
                whole = whole.unionByName(part)
            parts = [checkpointed(whole)]
    seen = parts[0]
    for part in parts[1:]:
        seen = seen.unionByName(part)
    return leaders.join(seen.select(F.col("k").alias("leader")), "leader", "left_semi").select(F.col("k").alias(node))
