"""Parent-child rows to full hierarchies.

1. Leaves are peeled, doubling the number of levels per round: the image of the 2^k-th power of the
   parent function is exactly what is left after peeling that many levels. The rounds end when the
   remainder no longer shrinks; it is then the set of nodes on cycles.
2. Every cycle node is cut from its parent and becomes a root, so the rest is a forest. Its Euler tour
   is built from sibling links. Leaves take no part in it: they are counted in the weight of the tour
   element in front of them, which leaves about a quarter of the elements.
3. The tour is ranked by parallel list ranking (pointer doubling), carrying a node count, a depth sum
   and the last element, which names the root.
4. Ranks give each node an entry and an exit number inside its tree; depth, ancestors, paths and
   descendants come from these intervals.

Every round is one equi-join of narrow numeric rows, written to the shared folder, and the number of rounds
is logarithmic in the longest tour. Nothing is gathered on the driver but row counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.storage import Scratch

#: Children of one parent beyond which they are spread over blocks in their order, each under a weightless helper node.
BLOCK = 100_000
#: Level of the largest dyadic blocks: 2^TOP nodes meet in one key of the containment join, whatever the size of their tree.
TOP = 14


def present(col: Column, missing: tuple[str, ...] = ("", "nan")) -> Column:
    """The link, or null where it is null or one of the marks that mean "none"."""
    return F.when(~F.trim(col).isin(*missing), col)


@dataclass
class Forest:
    """Result of :func:`build_forest`.

    ``names``: nid, node, parent.
    ``nodes``: nid, root, depth, entry, exit; one row per node, also of trees below a cycle.
    ``cycle``: nid of the nodes on cycles. ``links``: nid, pid, node, lost.
    """

    names: DataFrame
    links: DataFrame
    cycle: DataFrame
    nodes: DataFrame
    inner: DataFrame

    def states(self) -> DataFrame:
        """node, state: ``on_cycle``, ``below_cycle``, ``lost_parent``; other nodes are left out."""
        cyc = self.cycle.select(F.col("nid").alias("c"))
        on = self.cycle.select("nid", F.lit("on_cycle").alias("state"))
        below = (
            self.nodes.join(cyc, F.col("root") == F.col("c"), "left_semi").filter(F.col("nid") != F.col("root")).select("nid", F.lit("below_cycle").alias("state"))
        )
        lost = self.links.filter("lost").select("nid", F.lit("lost_parent").alias("state"))
        return on.unionByName(below).unionByName(lost).join(self.names, "nid").select("node", "state")

    def ancestor_pairs(self, of: DataFrame | None = None) -> DataFrame:
        """(ancestor, nid) of every node and each of its proper ancestors, from the intervals alone.

        An ancestor's interval is cut into its dyadic blocks of at most 2^TOP nodes, a node lies in one block per level, so the
        containment is an equi-join on (root, level, block) that yields each pair once.
        """
        of = self.nodes if of is None else of
        spans = (
            self.inner.select(F.col("nid").alias("ancestor"), "root", "entry", "exit")
            .withColumn("level", F.explode(F.sequence(F.lit(0), F.least(F.lit(TOP), F.ceil(F.log2(F.col("exit") - F.col("entry") + 2)).cast("int")))))
            .withColumn("lo", F.expr("shiftright(entry + 1 + shiftleft(1L, level) - 1, level)"))  # proper descendants only
            .withColumn("hi", F.expr("shiftright(exit + 1, level)"))
            .withColumn("block", F.explode(F.expr(
                f"case when level < {TOP} then array_compact(array(if(lo % 2 = 1 and lo < hi, lo, null), if(hi % 2 = 1 and lo + lo % 2 < hi, hi - 1, null))) when lo < hi then sequence(lo, hi - 1) end"
            )))
            .select("ancestor", "root", "level", "block")
        )
        sizes = self.inner.filter("nid = root").select("root", F.least(F.lit(TOP), F.ceil(F.log2(F.col("exit") + 2)).cast("int")).alias("top"))
        points = (
            of.select("nid", "root", "entry").join(sizes, "root").withColumn("level", F.explode(F.sequence(F.lit(0), F.col("top"))))
            .select("nid", "root", "level", F.expr("shiftright(entry, level)").alias("block"))
        )
        return points.join(spans, ["root", "level", "block"]).select("ancestor", "nid")

    def paths(self) -> DataFrame:
        """nid, path: the node names from the root to the node itself, for every node."""
        name = self.names.select("nid", "node")
        inner = self.inner.select("nid", "root", "depth", "entry")
        pairs = self.ancestor_pairs(inner)
        steps = (
            pairs.join(inner.select(F.col("nid").alias("ancestor"), F.col("depth").alias("at")), "ancestor")
            .join(name.select(F.col("nid").alias("ancestor"), "node"), "ancestor").select("nid", "at", "node")
            .unionByName(inner.select("nid", F.col("depth").alias("at")).join(name, "nid"))
        )
        above = steps.groupBy("nid").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "node"))), lambda s: s["node"]).alias("path"))
        leaves = self.nodes.filter("leaf").select("nid").join(self.links.select("nid", F.col("forest_pid").alias("pid")), "nid").join(name, "nid")
        tails = leaves.join(above.withColumnsRenamed({"nid": "pid", "path": "up"}), "pid", "left").select(
            "nid", F.concat(F.coalesce("up", F.array().cast("array<string>")), F.array("node")).alias("path")
        )
        return above.unionByName(tails)

    def table(self) -> DataFrame:
        """One row per node: node, parent, root, depth, entry, exit, n_descendants, path, state (null: none)."""
        name = self.names.select(F.col("nid").alias("root"), F.col("node").alias("root_node"))
        return (
            self.nodes.join(self.names, "nid").join(name, "root").join(self.paths(), "nid").join(self.states(), "node", "left")
            .select("node", "parent", F.col("root_node").alias("root"), "depth", "entry", "exit", (F.col("exit") - F.col("entry")).alias("n_descendants"), "path", "state")
        )


def _peel(work: Scratch, links: DataFrame) -> DataFrame:
    """Nodes that no amount of leaf peeling removes: those on cycles."""
    jump = links.filter("pid is not null").select(F.col("nid").alias("v"), F.col("pid").alias("up"))
    live = jump.select(F.col("up").alias("v")).distinct()
    jump = work.cut(jump.join(live, "v", "left_semi"), "peel")
    before = -1
    while True:
        far = jump.select(F.col("v").alias("w"), F.col("up").alias("far"))
        ahead = work.cut(jump.join(far, F.col("up") == F.col("w")).select("v", F.col("far").alias("up")), "peel")
        work.drop(jump)
        live = ahead.select(F.col("up").alias("v")).distinct()
        left = live.count()
        if left in (0, before):
            return work.cut(live.select(F.col("v").alias("nid")), "cycle")
        before = left
        jump = work.cut(ahead.join(live, "v", "left_semi"), "peel")
        work.drop(ahead)


def _spread(work: Scratch, links: DataFrame) -> DataFrame:
    """nid, pid, ord, node, real, leaf; children of a parent with very many get helper nodes between, so that no sibling list is long.

    The blocks are ranges of the children in their order, and the helpers stand in the order of the blocks.
    """
    kids = links.filter("forest_pid is not null").groupBy(F.col("forest_pid").alias("p")).agg(F.count("*").alias("n"))
    kids = work.cut(kids, "kids")
    tree = links.select("nid", F.col("forest_pid").alias("pid"), "ord", "node").join(kids.select(F.col("p").alias("nid"), F.lit(False).alias("inner")), "nid", "left")
    tree = tree.select("nid", "pid", "ord", "node", F.lit(1).alias("real"), F.coalesce("inner", F.lit(True)).alias("leaf"))
    hot = kids.filter(F.col("n") > BLOCK)
    size = hot.agg(F.sum("n")).first()[0]
    if size is None:
        return tree
    hot = hot.select(F.col("p").alias("pid"))
    parts = tree.join(hot, "pid", "left_semi").repartitionByRange(-(-size // BLOCK), F.col("pid"), F.col("ord").asc_nulls_first(), F.col("node"))
    parts = work.cut(parts.withColumn("block", F.spark_partition_id().cast("long")), "blocks")
    helper = parts.select("pid", "block").distinct()
    helper = work.cut(helper.select("pid", "block", (-1 - F.monotonically_increasing_id()).alias("helper")), "helpers")
    below = parts.join(helper, ["pid", "block"]).select("nid", F.col("helper").alias("pid"), "ord", "node", "real", "leaf")
    above = helper.select(F.col("helper").alias("nid"), "pid", F.col("block").alias("ord"), F.lit("").alias("node"), F.lit(0).alias("real"), F.lit(False).alias("leaf"))
    return tree.join(hot, "pid", "left_anti").select(*below.columns).unionByName(below).unionByName(above)


def _rank(work: Scratch, tour: DataFrame) -> DataFrame:
    """List ranking by pointer doubling: e, w, d, last with the sums from e to the end of its list.

    Elements whose pointer has reached the end are kept aside and not written again.
    """
    ended, going = work.split(tour.select("e", "nxt", "w", "d", F.col("e").alias("last")), F.col("nxt").isNull(), "rank")
    while going is not None:
        every = going if ended is None else ended.unionByName(going)
        ahead = every.select(F.col("e").alias("f"), F.col("nxt").alias("n2"), F.col("w").alias("w2"), F.col("d").alias("d2"), F.col("last").alias("l2"))
        moved = going.join(ahead, F.col("nxt") == F.col("f"))
        moved = moved.select("e", F.col("n2").alias("nxt"), (F.col("w") + F.col("w2")).alias("w"), (F.col("d") + F.col("d2")).alias("d"), F.col("l2").alias("last"))
        done, after = work.split(moved, F.col("nxt").isNull(), "rank")
        work.drop(going)
        going = after
        ended = done if ended is None else ended if done is None else ended.unionByName(done)
    return (tour.withColumn("last", F.col("e")) if ended is None else ended).select("e", "w", "d", "last")


def build_forest(rows: DataFrame, node: str, parent: str, order: str | None = None, missing: tuple[str, ...] = ("", "nan")) -> Forest:
    """Full hierarchies of the links ``node -> parent`` of any depth.

    Defined cases: rows repeated count once; of several parents of one node the smallest holds; a null
    ``node`` is no node; a null ``parent`` or one of ``missing`` means none; a parent that is no node of
    the table makes its row a root (state ``lost_parent``); a node that is its own parent is a cycle of
    one. Siblings are ordered by ``order`` (nulls first), then by node. Other columns are not read.
    An empty table gives empty results.
    """
    work = Scratch(rows.sparkSession, "forest")
    up = present(F.col(parent).cast("string"), missing)
    place = F.min(F.col(order).cast("long")) if order else F.min(F.lit(0).cast("long"))
    flat = rows.select(F.col(node).cast("string").alias("node"), up.alias("parent"), *([F.col(order)] if order and order not in (node, parent) else []))
    flat = flat.filter("node is not null").groupBy("node").agg(F.min("parent").alias("parent"), place.alias("ord"))
    names = work.cut(flat.withColumn("nid", F.monotonically_increasing_id()), "names")
    ids = names.select(F.col("node").alias("parent"), F.col("nid").alias("pid"))
    links = names.join(ids, "parent", "left").select("nid", "pid", "ord", "node", F.expr("parent is not null and pid is null").alias("lost"))
    links = work.cut(links, "links")
    cycle = _peel(work, links)
    cut = cycle.select("nid", F.lit(True).alias("cut"))
    links = links.join(cut, "nid", "left").select("nid", "pid", "ord", "node", "lost", F.when(F.col("cut").isNull(), F.col("pid")).alias("forest_pid"))
    tree = work.cut(_spread(work, links), "tree")

    seq = Window.partitionBy("pid").orderBy(F.col("ord").asc_nulls_first(), "node")
    run = seq.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("pid")
    sib = (
        tree.filter("pid is not null")
        .withColumn("r", F.sum(F.col("leaf").cast("long")).over(run))  # leaves so far
        .withColumn("r0", F.coalesce(F.max(F.when(~F.col("leaf"), F.col("r"))).over(run), F.lit(0)))  # leaves before the inner sibling in front
        .withColumn("before", F.last(F.when(~F.col("leaf"), F.col("nid")), True).over(run))
        .withColumn("total", F.sum(F.col("leaf").cast("long")).over(whole))
        .withColumn("place", F.row_number().over(seq))
    )
    sib = work.cut(sib.select("nid", "pid", "place", "leaf", "r", "r0", "before", "total"), "siblings")
    row = Window.partitionBy("pid").orderBy("place")
    links_in = sib.filter("not leaf").select(
        "nid", "pid", F.lead("nid").over(row).alias("sibling"), F.row_number().over(row).alias("i"), "r", (F.coalesce(F.lead("r").over(row), F.col("total")) - F.col("r")).alias("gap")
    )
    links_in = work.cut(links_in, "inner")
    first = links_in.filter("i = 1").select("pid", F.col("nid").alias("child"), F.col("r").alias("lead"))
    only = sib.filter("leaf").groupBy("pid").agg(F.max("total").alias("total"))
    inner = tree.filter("not leaf").select("nid", "real")
    enter = inner.join(first.withColumnRenamed("pid", "nid"), "nid", "left").join(only.withColumnRenamed("pid", "nid"), "nid", "left")
    enter = enter.select(
        (F.col("nid") * 2).alias("e"), F.coalesce(F.col("child") * 2, F.col("nid") * 2 + 1).alias("nxt"),
        (F.col("real") + F.when(F.col("child").isNotNull(), F.col("lead")).otherwise(F.coalesce("total", F.lit(0)))).cast("long").alias("w"), F.col("real").cast("long").alias("d"),
    )
    leave = inner.join(links_in.drop("i", "r"), "nid", "left").select(
        (F.col("nid") * 2 + 1).alias("e"), F.coalesce(F.col("sibling") * 2, F.col("pid") * 2 + 1).alias("nxt"), F.coalesce("gap", F.lit(0)).cast("long").alias("w"), (-F.col("real")).cast("long").alias("d"),
    )
    rank = _rank(work, enter.unionByName(leave))

    per = rank.select(F.floor(F.col("e") / 2).alias("nid"), F.pmod("e", F.lit(2)).alias("out"), "w", "d", F.floor(F.col("last") / 2).alias("root"))
    per = per.groupBy("nid").agg(F.max(F.when(F.col("out") == 0, F.col("w"))).alias("w_in"), F.max(F.when(F.col("out") == 1, F.col("w"))).alias("w_out"), F.max(F.when(F.col("out") == 0, -F.col("d"))).alias("depth"), F.max("root").alias("root"))
    per = work.cut(per, "ranked")
    size = per.filter("nid = root").select("root", F.col("w_in").alias("size"))
    per = per.join(size, "root").join(inner, "nid")
    # entry: 0-based place in the tree's preorder; exit: place of the last node of the subtree
    per = work.cut(per.select("nid", "root", "depth", "real", (F.col("size") - F.col("w_in")).alias("entry"), (F.col("size") - F.col("w_out") - 1).alias("exit"), (F.col("size") - F.col("w_out")).alias("behind")), "intervals")
    up1 = per.select(F.col("nid").alias("pid"), "root", (F.col("depth") + F.col("real")).alias("depth"), (F.col("entry") + F.col("real")).alias("start"))
    prev = per.select(F.col("nid").alias("before"), "behind")
    leaf = sib.filter("leaf").select("nid", "pid", "before", (F.col("r") - F.col("r0") - 1).alias("k")).join(up1, "pid").join(prev, "before", "left")
    leaf = leaf.withColumn("entry", F.coalesce("behind", "start") + F.col("k"))
    alone = tree.filter("leaf and pid is null").select("nid", F.col("nid").alias("root"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("entry"), F.lit(0).cast("long").alias("exit"), F.lit(True).alias("leaf"))
    inner_nodes = per.filter("real = 1").select("nid", "root", "depth", "entry", "exit", F.lit(False).alias("leaf"))
    nodes = inner_nodes.unionByName(leaf.select("nid", "root", "depth", "entry", F.col("entry").alias("exit"), F.lit(True).alias("leaf"))).unionByName(alone)
    return Forest(names.select("nid", "node", "parent"), links, cycle, nodes, inner_nodes)
