"""Agglomerative communities of an edge table, and their comparison with
known groups.

Two communities are as close as the mean score over all pairs of their
units, pairs without an edge counting zero (average linkage).  Merging one
pair at a time, always the closest, takes as many steps as there are units.
Average linkage is reducible (a merger is never closer to a third community
than the closer of its two parts was), so any two communities that are each
other's closest may be merged at once without changing the tree of mergers.
Each round therefore

1. finds every community's closest neighbour (one aggregation, combined
   map-side),
2. merges all pairs that chose each other, and
3. renames the ends of the edges and adds up parallel ones (one aggregation).

A round that merges few communities changes few edges: only those are written
again, as a layer beside the others, where an edge counts as long as none of
its ends has merged since (:class:`Layers`).

Pairs are compared by (closeness, smaller id, larger id), one order for all,
so the first pair of all always merges and ties cannot block a round.  Only
edges and one row per merger are kept; a round's edges replace the last's.

Parts that no edge joins do not touch each other's rounds.  A part of at most
``LOCAL_EDGES`` edges therefore goes through all its rounds in one task, with
the same numbers; a larger one goes on in rounds of Spark jobs until it has
shrunk.  Mergers never take a part apart, so parts are looked for once; their
edges are counted again when half of the edges are gone and more than one
large part is left.

Large parts whose edges fit the memory of all tasks at once go through their
rounds in tasks side by side (:mod:`affinity.operators.sidebyside`); rounds of
Spark jobs are for parts beyond that.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.operators import sidebyside
from affinity.operators.lineage import Rounds, cut
from affinity.operators.sizing import barrier_slots, is_small, maybe_broadcast

# Edges of a part that one task takes through its rounds: some 20 arrays of
# eight bytes an edge at most, so about 170 MB.
LOCAL_EDGES = 1 << 20
# A round's changed edges become a layer if at most one in so many communities
# merges with another, that is if some tenth of the communities change.
LAYER_SHARE = 20


def linkage_edges(edges: DataFrame) -> DataFrame:
    """(a, b, total, na, nb): every pair of single units once, a < b, with the
    scores of both directions added up.  Self pairs, and pairs whose scores
    add up to nothing, are no link."""
    e = edges.where((F.col("u1") != F.col("u2")) & F.col("w").isNotNull())
    e = e.groupBy(F.least("u1", "u2").alias("a"), F.greatest("u1", "u2").alias("b")).agg(F.sum(F.col("w").cast("bigint")).alias("total"))
    one = F.lit(1).cast("bigint")
    return e.where(F.col("total") > 0).select("a", "b", "total", one.alias("na"), one.alias("nb"))


def closeness() -> Column:
    """Mean score over the pairs of units of two communities."""
    return F.col("total").cast("double") / (F.col("na") * F.col("nb")).cast("double")


def best_of_ends(e: DataFrame) -> DataFrame:
    """(node, best, n): the highest closeness of a community's edges, and their number."""
    ends = e.select(F.explode(F.array("a", "b")).alias("node"), closeness().alias("close"))
    return ends.groupBy("node").agg(F.max("close").alias("best"), F.count(F.lit(1)).alias("n"))


def closest_edges(e: DataFrame, best: DataFrame) -> DataFrame:
    """The edges that are the closest of one of their ends at least: enough
    for :func:`mutual_choices`, which sorts what it gets, where a maximum per
    community is one hash aggregation.  With too many communities for a
    broadcast, all edges."""
    if not is_small(best):
        return e
    near = e
    for end in ("a", "b"):
        near = near.join(F.broadcast(best.select(F.col("node").alias(end), F.col("best").alias(f"best_{end}"))), end)
    return near.where(closeness() >= F.least("best_a", "best_b")).select(e.columns)


def mutual_choices(e: DataFrame) -> DataFrame:
    """The pairs (a, b, na, nb, height) that are each other's closest."""
    choice = F.struct((-closeness()).alias("far"), "a", "b", "na", "nb")
    chosen = e.select(F.explode(F.array("a", "b")).alias("node"), choice.alias("choice")).groupBy("node").agg(F.min("choice").alias("c"))
    both = chosen.groupBy("c.a", "c.b").agg(F.count(F.lit(1)).alias("n"), F.first("c").alias("c")).where(F.col("n") == 2)
    return both.select("a", "b", "c.na", "c.nb", (-F.col("c.far")).alias("height"))


def merged_edges(e: DataFrame, mergers: DataFrame, only_changed: bool = False) -> DataFrame:
    """``e`` after the mergers: a community goes by its smallest unit.  With
    ``only_changed``, only the edges of merged communities."""
    size = (F.col("na") + F.col("nb")).alias("size")
    new = mergers.select(F.explode(F.array("a", "b")).alias("old"), F.col("a").alias("new"), size)
    new = maybe_broadcast(new, is_small(mergers))
    columns = e.columns
    for end, n in (("a", "na"), ("b", "nb")):
        m = new.select(F.col("old").alias(f"{end}_old"), F.col("new").alias(f"{end}_new"), F.col("size").alias(f"{end}_size"))
        e = (e.join(m, F.col(end) == F.col(f"{end}_old"), "left")
             .withColumn(end, F.coalesce(f"{end}_new", end)).withColumn(n, F.coalesce(f"{end}_size", n)))
    if only_changed:
        e = e.where(F.col("a_new").isNotNull() | F.col("b_new").isNotNull())
    e = e.select(columns)
    turned = F.col("a") > F.col("b")

    def either(x: str, y: str) -> Column:
        return F.when(turned, F.col(y)).otherwise(F.col(x))
    e = e.where(F.col("a") != F.col("b")).select(
        either("a", "b").alias("a"), either("b", "a").alias("b"), "total", either("na", "nb").alias("na"), either("nb", "na").alias("nb"))
    # sizes are the same on all edges of a pair
    return e.groupBy("a", "b").agg(F.sum("total").alias("total"), F.max("na").alias("na"), F.max("nb").alias("nb"))


def local_rounds(t: pa.Table, n: int) -> pa.Table:
    """All mergers among the edges ``t``, which hold whole parts; the first
    round has number ``n``.  The rounds of the module's head, on arrays."""
    k = t.num_rows
    ends = pa.chunked_array([*t.column("a").chunks, *t.column("b").chunks])
    ids = pc.unique(ends)
    ids = ids.take(pc.sort_indices(ids))
    code = pc.index_in(ends, ids).to_numpy().astype(np.int64)
    a, b, total = code[:k], code[k:], t.column("total").to_numpy()
    if total.sum(dtype=np.float64) >= 2.0 ** 63:
        raise OverflowError("scores of a part add up to more than 64 bits")
    units = len(ids)
    size = np.ones(units, dtype=np.int64)
    size[a], size[b] = t.column("na").to_numpy(), t.column("nb").to_numpy()
    order = np.lexsort((b, a))
    a, b, total = a[order], b[order], total[order]
    found = []
    while len(a):
        # edges are in the order of (a, b): the first of the closest is a community's choice
        close = total.astype(np.float64) / (size[a] * size[b]).astype(np.float64)
        best = np.zeros(units)
        choice = np.full(units, len(a))
        for end in (a, b):
            np.maximum.at(best, end, close)
        for end in (a, b):
            at = np.flatnonzero(close == best[end])
            np.minimum.at(choice, end[at], at)
        m = np.flatnonzero((choice[a] == choice[b]) & (choice[a] == np.arange(len(a))))
        left, right = a[m], b[m]
        found.append((np.full(len(m), n + len(found)), left, right, size[left], size[right], close[m]))
        size[left] += size[right]
        new = np.arange(units)
        new[right] = left
        a, b = new[a], new[b]
        keep = a != b
        pair, which = np.unique(np.minimum(a, b)[keep] * units + np.maximum(a, b)[keep], return_inverse=True)
        merged = np.zeros(len(pair), dtype=np.int64)
        np.add.at(merged, which, total[keep])
        a, b, total = pair // units, pair % units, merged
    rd, left, right, na, nb, height = (np.concatenate(c) for c in zip(*found))
    return pa.table({"round": pa.array(rd, pa.int32()), "a": ids.take(pa.array(left)), "b": ids.take(pa.array(right)),
                     "na": pa.array(na, pa.int64()), "nb": pa.array(nb, pa.int64()), "height": pa.array(height, pa.float64())})


def roots(up: DataFrame, rounds: Rounds, name: str) -> DataFrame:
    """(node, up) of a kept forest with every ``up`` replaced by its root."""
    n, moved = 0, True
    while moved:                       # each round halves the way to the root
        above = up.select(F.col("node").alias("up"), F.col("up").alias("higher"))
        step = up.join(above, "up", "left").select("node", F.coalesce("higher", "up").alias("up"), F.col("higher").isNotNull().alias("moved"))
        step = rounds.keep(step, f"{name}{n + 1}")
        if n:
            rounds.drop(f"{name}{n}")
        up, n, moved = step.select("node", "up"), n + 1, not step.where("moved").isEmpty()
    return up


def parts(e: DataFrame, rounds: Rounds, name: str) -> DataFrame:
    """(node, part) for all ends of the edges: one part for what edges join.
    Every node hangs on its smallest neighbour, trees become nodes, and so on
    while edges are left between trees."""
    links, of, n = e.select("a", "b"), None, 0
    while of is None or not links.isEmpty():
        ends = links.select("a", "b").union(links.select("b", "a")).toDF("node", "other")
        up = ends.groupBy("node").agg(F.min("other").alias("up"))
        up = rounds.keep(up, f"{name}_low{n}")
        root = roots(up.where("up < node"), rounds, f"{name}_up{n}_")
        if of is None:
            of = up.select("node").join(root, "node", "left").select("node", F.coalesce("up", "node").alias("part"))
        else:
            of = of.join(root.toDF("part", "up"), "part", "left").select("node", F.coalesce("up", "part").alias("part"))
        of = rounds.keep(of, f"{name}{n}")
        for end in ("a", "b"):
            links = links.join(root.toDF(end, "up"), end, "left").withColumn(end, F.coalesce("up", end)).drop("up")
        links = rounds.keep(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}_links{n}")
        n += 1
    return of


def finish_parts(e: DataFrame, of: DataFrame, rounds: Rounds, n: int, local_edges: int, schema) -> tuple[DataFrame | None, DataFrame, int]:
    """From round ``n`` on: all mergers of the parts of at most ``local_edges``
    edges (None: there are no such parts), the edges of the others, and the
    number of these others.  ``of`` gives the part of every end."""
    in_part = e.join(maybe_broadcast(of.withColumnRenamed("node", "a"), is_small(of)), "a")
    held = rounds.keep(in_part.groupBy("part").agg(F.count(F.lit(1)).alias("n")), f"sizes{n}")
    # a task takes one part, or many that are small beside the bound
    few, fits = 16 * F.col("n") <= local_edges, F.col("n") <= local_edges
    edges_of_few, fitting, large = held.agg(F.sum(F.when(few, F.col("n"))), F.count_if(fits), F.count_if(~fits)).first()
    if not fitting:
        return None, e, large
    bins = 1 + 2 * (edges_of_few or 0) // max(1, local_edges)
    small = held.where(fits).select(
        "part", F.when(~few, F.col("part")).alias("one"), F.when(few, F.pmod(F.xxhash64("part"), F.lit(bins))).alias("bin"))
    done = in_part.join(small, "part").drop("part").groupBy("one", "bin").applyInArrow(lambda t: local_rounds(t, n), schema)
    return done, in_part.join(small.select("part"), "part", "left_anti").select(e.columns), large


def numbered(e: DataFrame, rounds: Rounds, name: str) -> DataFrame:
    """(node, idx, size) of all ends of the edges, numbered by their order."""
    ends = e.select(F.inline(F.array(*[F.struct(F.col(end).alias("node"), F.col(n).alias("size")) for end, n in (("a", "na"), ("b", "nb"))])))
    ends = ends.groupBy("node").agg(F.max("size").alias("size"))
    ends = rounds.keep(ends.orderBy("node").withColumn("place", F.monotonically_increasing_id()), name)
    # a place is its partition's number, 33 bits, and the row's within it
    of = F.shiftright("place", 33).alias("of")
    before = F.sum("n").over(Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1))
    start = ends.groupBy(of).agg(F.count(F.lit(1)).alias("n")).select("of", F.coalesce(before, F.lit(0)).alias("start"))
    idx = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return ends.withColumn("of", of).join(F.broadcast(start), "of").select("node", idx.alias("idx"), "size")


def finish_side_by_side(e: DataFrame, edges: int, rounds: Rounds, n: int, schema) -> list[str] | None:
    """All mergers of the edges from round ``n`` on, as names of kept tables,
    by stages of tasks side by side.  None if the edges do not fit these."""
    slots = barrier_slots(e.sparkSession)
    if 2 * edges > slots * sidebyside.MOST_ENTRIES:
        return None
    index = rounds.keep(numbered(e, rounds, f"places{n}"), f"index{n}")
    nodes = index.count()
    if nodes > sidebyside.MOST_NODES:
        return None

    def key(x: str, c: str) -> Column:
        return F.shiftleft(F.col(x).cast("bigint"), 32).bitwiseOR(F.col(c).cast("bigint")).alias("key")

    small = is_small(index)
    for end in ("a", "b"):
        i = index.select(F.col("node").alias(end), F.col("idx").alias(f"{end}_idx"))
        e = e.join(maybe_broadcast(i, small), end).withColumn(end, F.col(f"{end}_idx"))
    rows = e.select(F.inline(F.array(*[F.struct(key(*ends), "total") for ends in (("a", "b"), ("b", "a"))])))
    rows = rows.unionByName(index.select(key("idx", "idx"), F.col("size").alias("total")))
    piece = F.shiftright("key", 32) % sidebyside.PIECES
    found, last = [], None
    while edges:
        tasks = 1 if 2 * edges <= sidebyside.ALONE_ENTRIES else max(1, min(slots, -(-2 * edges // sidebyside.TASK_ENTRIES)))
        dealt = rows.repartitionById(tasks, (piece % tasks).cast("int")).drop("piece")
        if tasks > 1:
            out = dealt.mapInArrow(partial(sidebyside.together, nodes=nodes, n=n), sidebyside.SCHEMA, barrier=True)
        else:
            out = dealt.mapInArrow(partial(sidebyside.alone, nodes=nodes, n=n), sidebyside.SCHEMA)
        name = f"stage{n}"
        out = rounds.keep(out, name)
        m = out.where("round is not null")
        for end in ("a", "b"):
            i = index.select(F.col("idx").cast("int").alias(end), F.col("node").alias(f"{end}_node"))
            m = m.join(maybe_broadcast(i, small), end).withColumn(end, F.col(f"{end}_node"))
        rounds.keep(m.select([f.name for f in schema]), f"finished_{name}")
        found.append(f"finished_{name}")
        if last is not None:
            rounds.drop(last)
        last, rows, piece = name, out.where("round is null").select("piece", "data"), F.col("piece")
        entries, newest = out.agg(F.sum("total"), F.max("round")).first()
        edges, n = (entries or 0) // 2, newest + 1
    return found


class Layers:
    """The edges of a loop as kept tables: a first one of all edges, and for
    each later round its changed edges alone.  An edge counts as long as none
    of its ends has merged after its layer was written."""

    def __init__(self, rounds: Rounds, e: DataFrame, name: str, n: int = 0):
        self.rounds, self.layers, self.since, self.rows = rounds, [(n, e, name)], None, e.count()

    def edges(self) -> DataFrame:
        (n, e, _), *later = self.layers
        if not later:
            return e
        columns, first = e.columns, n
        e = e.withColumn("layer", F.lit(n))
        for n, more, _ in later:
            e = e.unionByName(more.withColumn("layer", F.lit(n)))
        for end in ("a", "b"):
            e = e.join(F.broadcast(self.since.toDF(end, f"since_{end}")), end, "left")
        for end in ("a", "b"):
            e = e.where(F.coalesce(F.col(f"since_{end}"), F.lit(first)) <= F.col("layer"))
        return e.select(columns)

    def replace(self, e: DataFrame, name: str, n: int) -> None:
        """``e`` is all edges from round ``n`` on."""
        e = self.rounds.keep(e, name)
        for _, _, old in self.layers:
            self.rounds.drop(old)
        self.layers, self.since, self.rows = [(n, e, name)], None, e.count()

    def add(self, changed: DataFrame, mergers: DataFrame, n: int) -> None:
        """The mergers that led to round ``n``, and the edges they changed."""
        changed = self.rounds.keep(changed, f"edges{n}")
        since = mergers.select(F.explode(F.array("a", "b")).alias("node"), F.lit(n).alias("since"))
        if self.since is not None:
            since = since.unionByName(self.since).groupBy("node").agg(F.max("since").alias("since"))
        self.since = self.rounds.keep(since, f"since{n}")
        self.layers.append((n, changed, f"edges{n}"))
        self.rows += changed.count()


def merge_tree(edges: DataFrame, local_edges: int = LOCAL_EDGES, layer_share: int = LAYER_SHARE,
               side_edges: int = LOCAL_EDGES) -> DataFrame:
    """All mergers: (round, a, b, na, nb, height).  Community b (its smallest
    unit's id) joins a; na and nb are their sizes before, height is their
    closeness.  Every id is a ``b`` at most once.  Rounds go on until no edge
    is left; a round without a merger while edges are left would be an error.
    More than ``side_edges`` edges go side by side, if they fit."""
    none = linkage_edges(edges).select(F.lit(0).alias("round"), "a", "b", "na", "nb", F.lit(0.0).alias("height")).limit(0)
    with Rounds(edges.sparkSession, "communities") as rounds:
        e, found, n = Layers(rounds, rounds.keep(linkage_edges(edges), "edges0"), "edges0"), [], 0
        of, counted, large, left, best, tried = None, 0, 2, e.rows, None, None

        def finish(done: DataFrame) -> None:
            rounds.keep(done.select(none.columns), f"finished{n}")
            found.append(f"finished{n}")
        while left:
            if left <= local_edges:
                finish(e.edges().groupBy().applyInArrow(lambda t: local_rounds(t, n), none.schema))
                break
            # a single part is all that is left: no need to count its edges apart
            if local_edges and (of is None or (large > 1 and 2 * left <= counted)):
                of, counted = parts(e.edges(), rounds, "parts") if of is None else of, left
                done, rest, large = finish_parts(e.edges(), of, rounds, n, local_edges, none.schema)
                if done is not None:
                    finish(done)
                    e.replace(rest, f"rest{n}", n)
                    left, best = e.rows, None
                    continue
            if left > side_edges and (tried is None or 2 * left <= tried):
                tried = left
                finished = finish_side_by_side(e.edges(), left, rounds, n, none.schema)
                if finished is not None:
                    found += finished
                    break
            best = rounds.keep(best_of_ends(e.edges()), f"best{n}") if best is None else best
            m = mutual_choices(closest_edges(e.edges(), best))
            m = rounds.keep(m.withColumn("round", F.lit(n)).select(none.columns), f"mergers{n}")
            merged = m.count()
            if not merged:
                raise RuntimeError("edges are left, but no two communities chose each other")
            found.append(f"mergers{n}")
            n += 1
            # few mergers leave most edges as they are
            if is_small(best) and layer_share * merged <= best.count() and e.rows <= 1.5 * left:
                e.add(merged_edges(e.edges(), m, only_changed=True), m, n)
                best = rounds.keep(best_of_ends(e.edges()), f"best{n}")
                left = (best.agg(F.sum("n")).first()[0] or 0) // 2
            else:
                e.replace(merged_edges(e.edges(), m), f"edges{n}", n)
                left, best = e.rows, None
        return cut(rounds.read(found, none.schema)) if found else none


def cut_tree(units: DataFrame, tree: DataFrame, k: int) -> DataFrame:
    """(unit, community): the ``k`` groups that are left when all but the last
    k - 1 mergers are made, mergers ordered from the highest to the lowest
    and, at one height, by round and ids.  Parts that no edge joins stay
    apart, so there can be more than ``k``.  Units without edges are
    communities of their own.  A community goes by its smallest unit."""
    u = units.select("unit").where(F.col("unit").isNotNull()).distinct()
    ends = tree.select(F.explode(F.array("a", "b")).alias("unit"))
    u = u.unionByName(ends).distinct()
    undone = max(0, k - (u.count() - tree.count()))
    last = tree.orderBy("height", F.desc("round"), F.desc("a"), F.desc("b")).limit(undone).select("a", "b")
    up = tree.join(last, ["a", "b"], "left_anti").select(F.col("b").alias("node"), F.col("a").alias("up"))
    with Rounds(units.sparkSession, "cut") as rounds:
        up = roots(rounds.keep(up, "up0"), rounds, "up")
        found = u.join(up, F.col("unit") == F.col("node"), "left").select("unit", F.coalesce("up", "unit").alias("community"))
        return cut(found)


def communities(edges: DataFrame, units: DataFrame, k: int) -> DataFrame:
    """(unit, community) of ``units`` (and of all ends of edges) in ``k`` groups."""
    return cut_tree(units, merge_tree(edges), k)


# ------------------------------------------------------ comparison of groupings

def contingency(found: DataFrame, known: DataFrame, left: str = "community", right: str = "grp") -> DataFrame:
    """(left, right, n): units in each pair of a found and a known group.
    Units that have both count; a null group is a group."""
    k = known.select("unit", right)
    return found.select("unit", left).join(k, "unit").groupBy(left, right).agg(F.count(F.lit(1)).alias("n"))


def agreement(table: DataFrame, left: str = "community", right: str = "grp") -> DataFrame:
    """One row from a contingency table: n_units, n_left, n_right, the pairs of
    units that are together in both groupings (same_both), in the left
    (same_left) and in the right one (same_right), the Rand index, and the
    adjusted Rand index (agreement beyond chance: 1 for equal groupings,
    about 0 for unrelated ones; null where both are trivial or no pair exists)."""
    t = table.select(F.col(left).alias("l"), F.col(right).alias("r"), F.col("n").cast("bigint").alias("n"))
    pairs = "n * (n - 1) div 2"
    # the cells, and their sums by either side, in one aggregation
    sets = [[F.col("l"), F.col("r")], [F.col("l")], [F.col("r")]]
    t = t.groupingSets(sets, "l", "r").agg(F.grouping("l").alias("no_l"), F.grouping("r").alias("no_r"), F.sum("n").alias("n"))
    cell, by_left, by_right = (F.col("no_l") + F.col("no_r") == 0), F.col("no_r") == 1, F.col("no_l") == 1

    def same(which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, F.expr(pairs))), F.lit(0).cast("bigint"))
    s = t.agg(F.coalesce(F.sum(F.when(cell, F.col("n"))), F.lit(0).cast("bigint")).alias("n"), same(cell).alias("same_both"),
              F.count_if(by_left).alias("n_left"), same(by_left).alias("same_left"),
              F.count_if(by_right).alias("n_right"), same(by_right).alias("same_right"))
    s = s.withColumn("all_pairs", F.expr(pairs).cast("double"))
    both, a, b = (F.col(c).cast("double") for c in ("same_both", "same_left", "same_right"))
    chance = F.try_divide(a * b, F.col("all_pairs"))
    rand = F.try_divide(F.col("all_pairs") + 2 * both - a - b, F.col("all_pairs"))
    return s.select(F.col("n").alias("n_units"), "n_left", "n_right", "same_both", "same_left", "same_right",
                    rand.alias("rand_index"), F.try_divide(both - chance, (a + b) / 2 - chance).alias("adjusted_rand"))

