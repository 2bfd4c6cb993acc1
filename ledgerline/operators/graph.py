"""Graph operators over edge tables; iterations write each round down and never collect nodes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.interim import freed, settled


def node_metrics(edges: DataFrame) -> DataFrame:
    """node, degree, n_out, n_in, weight, worst_tier; edges: src, dst, weight, tier."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("src").alias("node"), F.lit(1).alias("o")), F.struct(F.col("dst").alias("node"), F.lit(0).alias("o")))).alias("e"), "weight", "tier")
    return ends.groupBy("e.node").agg(
        F.count("*").alias("degree"),
        F.sum("e.o").alias("n_out"),
        F.sum(1 - F.col("e.o")).alias("n_in"),
        F.sum("weight").alias("weight"),
        F.max("tier").alias("worst_tier"),
    )


def simple_paths(edges: DataFrame, origins: DataFrame, max_hops: int) -> DataFrame:
    """origin, terminal, hops, path: every path without a repeated node, of 1 to max_hops edges.

    One join a hop; the guard is an array of the nodes visited.
    """
    step = edges.select("src", "dst").distinct()
    front = origins.select(F.col("node").alias("origin"), F.col("node").alias("terminal"), F.array("node").alias("seen"))
    found = None
    for hop in range(1, max_hops + 1):
        front = (
            front.join(step, F.col("terminal") == F.col("src"))
            .filter(~F.array_contains("seen", F.col("dst")))
            .select("origin", F.col("dst").alias("terminal"), F.concat("seen", F.array("dst")).alias("seen"))
        )
        one = front.select("origin", "terminal", F.lit(hop).alias("hops"), F.array_join("seen", " > ").alias("path"))
        found = one if found is None else found.unionByName(one)
    return found


def pagerank(edges: DataFrame, damping: float = 0.85, rounds: int | None = None, tolerance: float = 1e-9, most: int = 500) -> DataFrame:
    """node, rank: weighted, directed; ranks sum to 1 and dangling nodes share theirs with all.

    Without ``rounds`` it goes on until a round changes all ranks together by less than
    ``tolerance`` (looked at every fifth round), and raises after ``most`` rounds.
    """
    e = edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    out = e.groupBy("src").agg(F.sum("weight").alias("total"))
    e = settled(e.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("p")))
    nodes = e.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    nodes = settled(nodes.join(out.select(F.col("src").alias("node"), F.lit(True).alias("gives")), "node", "left"))
    n = nodes.count()
    ranks = nodes.select("node", "gives", F.lit(1.0 / max(n, 1)).alias("rank"))
    k = 0
    while rounds is None or k < rounds:
        last = ranks
        lost = ranks.filter("gives IS NULL").agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("lost"))
        moved = e.join(ranks, F.col("src") == F.col("node")).groupBy("dst").agg(F.sum(F.col("rank") * F.col("p")).alias("in"))
        ranks = (
            nodes.join(moved, F.col("node") == F.col("dst"), "left")
            .join(F.broadcast(lost), F.lit(True))
            .select("node", "gives", ((1 - damping) / n + damping * (F.coalesce("in", F.lit(0.0)) + F.col("lost") / n)).alias("rank"))
        )
        k += 1
        if k % 5 == 0:
            if rounds is None:
                ranks = ranks.join(last.select("node", F.col("rank").alias("before")), "node")
            ranks = settled(ranks)
            if rounds is None:
                change = ranks.agg(F.sum(F.abs(F.col("rank") - F.col("before")))).first()[0]
                if change is None or change < tolerance:
                    break
                if k >= most:
                    raise ValueError(f"ranks still change by {change} after {k} rounds")
    return ranks.select("node", "rank")


def reaches(edges: DataFrame, max_hops: int | None = None) -> DataFrame:
    """src, dst, hops: the transitive closure, or what of it a number of hops reaches, shortest first."""
    step = settled(edges.select("src", "dst").distinct())
    known = step.withColumn("hops", F.lit(1))
    front, hop = known, 1
    while max_hops is None or hop < max_hops:
        hop += 1
        grown = front.select("src", F.col("dst").alias("_mid")).join(step.withColumnRenamed("src", "_mid"), "_mid")
        front = grown.select("src", "dst").distinct().join(known, ["src", "dst"], "left_anti").withColumn("hops", F.lit(hop))
        front = settled(front)
        if front.isEmpty():
            break
        known = known.unionByName(front)
        if hop % 10 == 0:
            known = settled(known)
    return known


def cycles(edges: DataFrame, max_hops: int | None = None) -> DataFrame:
    """node, hops: the nodes that reach themselves (in at most max_hops, if given) and in how many hops."""
    return reaches(edges, max_hops).filter("src = dst").select(F.col("src").alias("node"), "hops")


def collapse(parents: DataFrame, order: str) -> DataFrame:
    """child, parent (the first named), n_parents and conflict; parents: child, parent, order."""
    return parents.groupBy("child").agg(
        F.min_by("parent", F.struct(order, "parent")).alias("parent"),
        F.count_distinct("parent").alias("n_parents"),
        (F.count_distinct("parent") > 1).alias("conflict"),
    )


def edge_faults(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """edge_id, fault: orphan ends, self-loops and repeated ids."""
    known = nodes.select("node").distinct()
    orphan = lambda c: edges.join(known, F.col(c) == F.col("node"), "left_anti").select("edge_id", F.lit(f"orphan_{c}").alias("fault"))
    loops = edges.filter("src = dst").select("edge_id", F.lit("self_loop").alias("fault"))
    again = edges.groupBy("edge_id").agg(F.count("*").alias("n")).filter("n > 1").select("edge_id", F.lit("duplicate").alias("fault"))
    return orphan("src").unionByName(orphan("dst")).unionByName(loops).unionByName(again)


def betweenness(edges: DataFrame, max_nodes: int = 2000) -> DataFrame:
    """node, betweenness of an undirected weighted graph (weight is length), by Brandes' method.

    Every source is a task of its own over a broadcast graph, which is checked
    to have at most ``max_nodes`` nodes; larger graphs raise.
    """
    import heapq

    pairs = edges.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.min("weight").alias("w")).filter("a <> b")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if nodes.count() > max_nodes:
        raise ValueError(f"betweenness is for graphs of at most {max_nodes} nodes")
    near: dict = {}
    for a, b, w in pairs.collect():  # at most max_nodes squared
        near.setdefault(a, []).append((b, float(w)))
        near.setdefault(b, []).append((a, float(w)))
    shared = edges.sparkSession.sparkContext.broadcast(near)

    def from_sources(batches):
        import pandas as pd

        graph = shared.value
        for batch in batches:
            for source in batch["node"]:
                done, sigma, order, before = {}, {source: 1.0}, [], {source: []}
                best, queue = {source: 0.0}, [(0.0, source)]
                while queue:
                    d, v = heapq.heappop(queue)
                    if v in done:
                        continue
                    done[v] = d
                    order.append(v)
                    for u, w in graph[v]:
                        nd = d + w
                        if u not in done and nd < best.get(u, float("inf")) - 1e-12:
                            best[u], sigma[u], before[u] = nd, sigma[v], [v]
                            heapq.heappush(queue, (nd, u))
                        elif u not in done and abs(nd - best[u]) <= 1e-12:
                            sigma[u] += sigma[v]
                            before[u].append(v)
                part = dict.fromkeys(order, 0.0)
                for v in reversed(order):
                    for u in before[v]:
                        part[u] += sigma[u] / sigma[v] * (1 + part[v])
                part.pop(source)
                yield pd.DataFrame({"node": list(part), "part": list(part.values())})

    parts = nodes.repartition(max(1, min(64, len(near)))).mapInPandas(from_sources, f"node {dict(nodes.dtypes)['node']}, part double")
    return nodes.join(parts.groupBy("node").agg((F.sum("part") / 2).alias("betweenness")), "node", "left").fillna(0.0, ["betweenness"])


def chains(links: DataFrame) -> DataFrame:
    """node, last, hops, cycle: where each node's chain ends, by pointer jumping; links: node, next (null: an end), each node once.

    A round replaces each pointer by the pointer of what it points to, so chains of n links take about log2(n) rounds.
    Nodes whose chain has no end are those that lead into a cycle: last and hops are null and cycle is the
    smallest node of that cycle.  A next that is no node counts as an end of its own.
    """
    e = settled(links.select("node", "next").distinct(), "chains")
    state = e.select("node", F.coalesce("next", "node").alias("to"), F.col("next").isNotNull().cast("long").alias("hops"))
    known = e.select(F.col("node").alias("to"), F.col("next").isNull().alias("end"))
    # an end points to itself; what points to no node at all has reached one, too
    state = state.join(known, "to", "left").select("node", "to", "hops", F.coalesce("end", F.lit(True)).alias("done"))
    done = settled(state.filter("done"), "chains")
    left = settled(state.filter("NOT done").withColumn("low", F.least("node", "to")), "chains")
    found = done
    while True:
        ahead = done.select(F.col("node").alias("to"), F.col("to").alias("last"), F.col("hops").alias("more"))
        along = left.select(F.col("node").alias("to"), F.col("to").alias("further"), F.col("hops").alias("on"), F.col("low").alias("lower"))
        step = left.join(ahead, "to", "left").join(along, "to", "left")
        step = step.select(
            "node",
            F.coalesce("last", "further").alias("to"),
            (F.col("hops") + F.coalesce("more", "on")).alias("hops"),
            F.col("last").isNotNull().alias("done"),
            F.least("low", "lower").alias("low"),
        )
        step = settled(step, "chains")
        fresh, left = step.filter("done").drop("low"), step.filter("NOT done")
        if fresh.isEmpty():
            break  # an end at distance d leaves one at each shorter distance: none is left now
        found = found.unionByName(fresh)
        # a pointer of round k looks 2^k links ahead, so all ends found so far can be asked
        done = settled(found, "chains")
        found = done
    # who is left never ends; more rounds until every pointer has gone round its cycle
    n, span = left.count(), 2
    while span < 2 * n:
        along = left.select(F.col("node").alias("to"), F.col("to").alias("further"), F.col("low").alias("lower"))
        left = settled(left.join(along, "to").select("node", F.col("further").alias("to"), F.least("low", "lower").alias("low"), "hops", "done"), "chains")
        span *= 2
    kind = dict(links.dtypes)["node"]
    ended = found.select("node", F.col("to").alias("last"), "hops", F.lit(None).cast(kind).alias("cycle"))
    # the low of a pointer's target has seen its whole cycle, and nothing else
    rounds = left.select(F.col("node").alias("to"), F.col("low").alias("cycle"))
    endless = left.join(rounds, "to").select("node", F.lit(None).cast(kind).alias("last"), F.lit(None).cast("long").alias("hops"), "cycle")
    return ended.unionByName(endless)


def _trimmed(e: DataFrame) -> DataFrame:
    """Edges whose ends both have edges in and out, so far as a few rounds show: what only leads to or from cycles goes."""
    before = None
    while True:
        both = e.select(F.col("src").alias("node")).distinct().join(e.select(F.col("dst").alias("node")).distinct(), "node", "left_semi")
        e = e.join(both.select(F.col("node").alias("src")), "src", "left_semi").join(both.select(F.col("node").alias("dst")), "dst", "left_semi")
        e = settled(e.select("src", "dst"), "cycles")
        n = e.count()
        # a long tail goes link by link: leave it to the colours, which take it away at once
        if not n or before is not None and n > 0.9 * before:
            return e
        before = n


def strong_components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node): the nodes that lie on cycles; edges: src, dst.

    Nodes without edges in or out are peeled off.  Then the largest number that reaches a node is its colour; within a
    colour the nodes that reach that number are one strong component, which goes, and the rest
    begins anew.  No table holds pairs of nodes that reach each other.
    """
    loops = edges.filter("src = dst").select(F.col("src").alias("node")).distinct()
    e = settled(edges.filter("src <> dst").select("src", "dst").distinct(), "cycles")
    found = None
    while True:
        e = _trimmed(e)
        if e.isEmpty():
            break
        colour = e.select(F.explode(F.array("src", "dst")).alias("node")).distinct().withColumn("colour", F.col("node"))
        colour = settled(colour, "cycles")
        while True:
            sent = e.join(colour.select(F.col("node").alias("src"), "colour"), "src").groupBy("dst").agg(F.max("colour").alias("got"))
            new = colour.join(sent, F.col("node") == F.col("dst"), "left")
            new = settled(new.select("node", F.greatest("colour", "got").alias("colour"), (F.col("got") > F.col("colour")).alias("changed")), "cycles")
            colour = new.select("node", "colour")
            if new.filter("changed").isEmpty():
                break
        # edges within a colour, walked backwards from its number
        own = e.join(colour.select(F.col("node").alias("src"), "colour"), "src").join(colour.select(F.col("node").alias("dst"), F.col("colour").alias("same")), "dst")
        own = settled(own.filter("colour = same").select("src", "dst", "colour"), "cycles")
        inside = settled(colour.filter("node = colour"), "cycles")
        front = inside
        while True:
            front = own.join(front.select(F.col("node").alias("dst")), "dst", "left_semi").select(F.col("src").alias("node"), "colour").distinct()
            front = settled(front.join(inside.select("node"), "node", "left_anti"), "cycles")
            if front.isEmpty():
                break
            inside = settled(inside.unionByName(front), "cycles")
        sizes = inside.groupBy("colour").agg(F.count("*").alias("n"), F.min("node").alias("component")).filter("n > 1")
        one = settled(inside.join(sizes, "colour").select("node", "component"), "cycles")
        found = one if found is None else found.unionByName(one)
        gone = inside.select("node")
        e = e.join(gone.select(F.col("node").alias("src")), "src", "left_anti").join(gone.select(F.col("node").alias("dst")), "dst", "left_anti")
        e = settled(e.select("src", "dst"), "cycles")
    if found is None:
        return loops.withColumn("component", F.col("node"))
    return found.unionByName(loops.join(found, "node", "left_anti").withColumn("component", F.col("node")))


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of an undirected edge table; edges: src, dst.

    A round hangs each node under the smallest label around it, then labels under their own labels, so that
    long paths shorten by powers of two.  What nodes say to their neighbours is combined before it is shuffled.
    """
    e = edges.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL")
    e = settled(e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "components")
    label = settled(e.groupBy(F.col("src").alias("node")).agg(F.min(F.least("src", "dst")).alias("label")), "components")
    while True:
        near = e.join(label, F.col("dst") == F.col("node")).groupBy(F.col("src").alias("node")).agg(F.min("label").alias("near"))
        least = label.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        # the label of the node that is my label, as it stands now
        over = least.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        # whoever named a label tells it about a smaller one it has heard of
        heard = least.groupBy(F.col("label").alias("node")).agg(F.min("low").alias("heard"))
        new = least.join(over, "low", "left").join(heard, "node", "left")
        new = settled(new.select("node", F.least("low", "lower", "heard").alias("label"), (F.least("low", "lower", "heard") < F.col("label")).alias("changed")), "components")
        label = new.select("node", "label")
        if new.filter("changed").isEmpty():
            return label.withColumnRenamed("label", "component")


def _propagated(front: DataFrame, arcs: DataFrame, start: str, end: str) -> DataFrame:
    """source, node, total: what ``front`` (source, node, x) gives to the ends of arcs, to theirs, and so on, summed."""
    found = None
    while True:
        moved = arcs.join(front, (arcs["source"] == front["source"]) & (arcs[start] == front["node"]))
        front = settled(moved.groupBy(arcs["source"], F.col(end).alias("node")).agg(F.sum("x").alias("x")), "shortest")
        if front.isEmpty():
            break
        found = front if found is None else found.unionByName(front)
    if found is None:
        return front.select("source", "node", F.col("x").alias("total"))
    return found.groupBy("source", "node").agg(F.sum("x").alias("total"))


#: Sources side by side in a row: an edge is met once a round for all of them, and where few of them reach a node, few columns are idle.
_SIDE_BY_SIDE = 8
#: Edges, and rows of sources side by side, for a task.
_EDGES, _ROWS = 1_000_000, 400_000


def _heard(e: DataFrame, said: DataFrame, xs: list[str], as_: str) -> DataFrame:
    """block, node, and a column for each of xs: the sums of what the neighbours of each node say.  The edges stay where they are, partitioned by u."""
    moved = e.join(said.selectExpr("block", "node AS u", *xs).hint("shuffle_hash"), "u")
    return moved.groupBy("block", "v").agg(dict.fromkeys(xs, "sum")).selectExpr("block", "v AS node", *[f"`sum({x})` AS {as_}{x}" for x in xs])


def _parts_by_hops(e: DataFrame, picked: DataFrame, k: int) -> DataFrame:
    """node, sum: the dependencies of k sources on the nodes between, where all edges are of one length.

    A level of nodes is found a round, with the paths to each by sum.  Its neighbours lie in the level before, in itself or in the
    next, so no table of all nodes seen is asked.  Dependencies go back from the last level, an arc once.
    """
    width = min(_SIDE_BY_SIDE, k)
    xs = [f"x{i}" for i in range(width)]
    held = " | ".join(f"IF({x} > 0, {1 << i}L, 0L)" for i, x in enumerate(xs))
    place = picked.select("node", (F.row_number().over(Window.orderBy(F.xxhash64("node"), "node")) - 1).alias("place"))
    first = place.selectExpr(f"place div {width} AS block", "node", *[f"IF(place % {width} = {i}, 1D, 0D) AS {x}" for i, x in enumerate(xs)])
    levels = [settled(first.selectExpr("*", f"{held} AS held"), "hops")]
    while True:
        before = levels[-1].select("block", "node", "held")
        if len(levels) > 1:
            before = before.unionByName(levels[-2].select("block", "node", "held")).groupBy("block", "node").agg(F.bit_or("held").alias("held"))
        met = _heard(e, levels[-1], xs, "").join(before, ["block", "node"], "left")
        fresh = [f"IF(coalesce(held, 0L) & {1 << i}L = 0, {x}, 0D) AS {x}" for i, x in enumerate(xs)]
        new = met.selectExpr("block", "node", *fresh).selectExpr("*", f"{held} AS held").filter("held <> 0")
        new = settled(new, "hops")
        freed(e.sparkSession)
        if new.isEmpty():
            break
        levels.append(new)
    share = levels[-1].selectExpr("block", "node", *[f"IF({x} > 0, 1 / {x}, 0D) AS {x}" for x in xs])
    parts = levels[0].selectExpr("node", "0D AS sum")
    for i, level in enumerate(reversed(levels[1:-1])):
        # dependency / paths of a node is the sum over what follows it of 1 / paths and of the same again
        both = level.join(_heard(e, share, xs, "t"), ["block", "node"], "left")
        own = " + ".join(f"{x} * coalesce(t{x}, 0D)" for x in xs)  # 0 where a source's node is of another level
        share = settled(both.selectExpr("block", "node", f"{own} AS sum", *[f"IF({x} > 0, 1 / {x} + coalesce(t{x}, 0D), 0D) AS {x}" for x in xs]), "hops")
        parts = parts.unionByName(share.select("node", "sum"))
        if i % 20 == 19:
            parts = settled(parts.groupBy("node").agg(F.sum("sum").alias("sum")), "hops")
    return parts.groupBy("node").agg(F.sum("sum").alias("sum"))


def _parts_by_lengths(e: DataFrame, picked: DataFrame) -> DataFrame:
    """node, sum: the dependencies of the sources on the nodes between, where edges are of any lengths above 0.

    Distances settle by relaxing edges (a join and a minimum a round), path counts run down the arcs of shortest paths and
    dependencies up, both as sums by join; tables have a row for each source and node or arc.
    """
    known = settled(picked.select(F.col("node").alias("source"), "node", F.lit(0.0).alias("dist")), "shortest")
    front = known
    while True:
        tried = front.join(e, front["node"] == e["u"]).groupBy("source", F.col("v").alias("node")).agg(F.min(F.col("dist") + F.col("w")).alias("new"))
        both = known.join(tried, ["source", "node"], "full_outer")
        better = F.col("new").isNotNull() & (F.col("dist").isNull() | (F.col("new") < F.col("dist") - 1e-12))
        both = settled(both.select("source", "node", F.when(better, F.col("new")).otherwise(F.col("dist")).alias("dist"), better.alias("better")), "shortest")
        known, front = both.drop("better"), both.filter("better").drop("better")
        if front.isEmpty():
            break
    near = known.select("source", F.col("node").alias("u"), F.col("dist").alias("d"))
    far = known.select("source", F.col("node").alias("v"), F.col("dist").alias("d2"))
    arcs = near.join(e, "u").join(far, ["source", "v"]).filter(F.abs(F.col("d") + F.col("w") - F.col("d2")) <= 1e-9)
    arcs = settled(arcs.select("source", "u", "v"), "shortest")
    roots = picked.select(F.col("node").alias("source"), "node", F.lit(1.0).alias("x"))
    paths = _propagated(roots, arcs, "u", "v").withColumnRenamed("total", "paths")  # of the sources themselves there is one, and no use for it
    paths = settled(paths, "shortest")
    # dependency / paths of a node is the sum over what follows it of 1 / paths and of the same again
    share = _propagated(paths.select("source", "node", (1 / F.col("paths")).alias("x")), arcs, "v", "u")
    return share.join(paths, ["source", "node"]).groupBy("node").agg(F.sum(F.col("total") * F.col("paths")).alias("sum"))


def sampled_betweenness(edges: DataFrame, sources: int = 256, delta: float = 0.05) -> DataFrame:
    """node, betweenness, error: as ``betweenness``, for graphs of any size, from the shortest paths of some sources.

    The sources are the nodes that come first by hash, so what they say is an unbiased mean.  With probability 1 - delta
    all nodes lie within ``error``: a source's part is between 0 and n - 2, so by Hoeffding's bound the mean of k sources is within
    (n - 2) * sqrt(ln(2 * n / delta) / (2 * k)).  With as many sources as nodes the result is exact and error is 0.

    Weights are lengths above 0.  Where all are the same, sources go side by side, a level of nodes a round; else by distances.
    Edges are dealt by their start once, in as many parts as there are edges and rows for.
    """
    import math

    one = edges.filter("src <> dst").groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.min("weight").cast("double").alias("w"))
    one = settled(one, "shortest")
    freed(edges.sparkSession)
    m, least, most, about = one.agg(F.count("*"), F.min("w"), F.max("w"), F.approx_count_distinct("a") + F.approx_count_distinct("b")).first()
    blocks = math.ceil(min(sources, about) / _SIDE_BY_SIDE)
    deal = max(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * m // _EDGES, about * blocks // _ROWS)
    e = one.select(F.col("a").alias("u"), F.col("b").alias("v"), "w").unionByName(one.select(F.col("b").alias("u"), F.col("a").alias("v"), "w"))
    level = m > 0 and least == most
    # where lengths are equal they are left out, and sorted starts are kept as runs
    e = (e.select("u", "v") if level else e).repartition(deal, "u").sortWithinPartitions("u").persist()
    nodes = settled(e.select(F.col("u").alias("node")).distinct(), "shortest")
    n = nodes.count()
    k = min(sources, n)
    picked = settled(nodes.orderBy(F.xxhash64("node"), "node").limit(k), "shortest")
    part = settled(_parts_by_hops(e, picked, k) if level else _parts_by_lengths(e, picked), "shortest")
    e.unpersist()
    error = 0.0 if k == n else n * max(n - 2, 0) * math.sqrt(math.log(2 * n / delta) / (2 * k)) / 2
    scaled = F.coalesce(F.col("sum"), F.lit(0.0)) * (n / max(k, 1)) / 2
    return nodes.join(part, "node", "left").select("node", scaled.alias("betweenness"), F.lit(error).alias("error"))
