"""Duplicate graph: symmetric edges, connected components, cluster lists and
the order-deterministic leader (greedy) assignment (GR1-GR3, JN5, JN6).

Both loops are DataFrame joins and aggregations; every round is cut with a
reliable checkpoint and ends with one count.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.neardup import salted_join_sides
from corpusmill.operators.ordering import with_row_index
from corpusmill.session import release, reliable_checkpoint

# Fixed bound: a label shared by more nodes than this is salted in the
# pointer-jumping join.
HOT_LABEL_ROWS = 20_000


def symmetrise(pairs: DataFrame, a: str = "id1", b: str = "id2") -> DataFrame:
    """GR1: both directions, unique neighbours, no self loops.  ``pairs`` is computed once."""
    both = F.array(F.struct(F.col(a).alias("src"), F.col(b).alias("dst")), F.struct(F.col(b).alias("src"), F.col(a).alias("dst")))
    return pairs.select(F.inline(both)).where(F.col("src") != F.col("dst")).distinct()


# Fixed bound: once at most so many edges are left, one task settles them.
LOCAL_EDGES = 200_000


def _local(edges: DataFrame, solve, value: str) -> DataFrame:
    """(node, value) of a bounded edge list, by ``solve(n, a, b)`` over node numbers in node order."""
    node = edges.schema["src"].dataType.simpleString()
    out = "label" if value == node else "is_leader"

    def run(batches):
        got = list(batches)
        if not got:
            return
        pairs = pd.concat(got)
        number, nodes = pd.factorize(pd.concat([pairs["src"], pairs["dst"]]), sort=True)
        solved = solve(len(nodes), number[:len(pairs)], number[len(pairs):])
        yield pd.DataFrame({"node": nodes, out: solved if out == "is_leader" else nodes[solved]})

    return edges.select("src", "dst").coalesce(1).mapInPandas(run, f"node {node}, {out} {value}")


def _smallest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        # hook the old roots too, so that a chain halves in each round
        np.minimum.at(new, label, new.copy())
        label = new[new]


def _greedy_leaders(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leaders in node order; ``a`` is the earlier end of each edge."""
    order = np.argsort(b, kind="stable")
    a, b = a[order], b[order]
    leader = np.ones(n, bool)
    for node, lo, hi in zip(*_groups(b)):
        leader[node] = not leader[a[lo:hi]].any()
    return leader


def _groups(keys: np.ndarray):
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[starts], starts, np.append(starts[1:], len(keys))


def _hot_sides(rows: DataFrame, target: DataFrame, key: str, row_id: str):
    """Sides and keys of the join of ``rows`` with the unique keys of ``target``;
    keys with more than HOT_LABEL_ROWS rows are salted."""
    if rows.count() <= HOT_LABEL_ROWS:
        return rows, target, [key]
    hot = (rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > HOT_LABEL_ROWS)
           .select(key, F.ceil(F.col("_rows") / F.lit(HOT_LABEL_ROWS)).cast("int").alias("_salts")))
    return salted_join_sides(rows, target, [key], hot, row_id)


def _follow(rows: DataFrame, key: str, labels: DataFrame, row_id: str) -> DataFrame:
    """``rows`` with ``key`` replaced by its label (itself if it has none); hot keys are salted."""
    target = labels.select(F.col("node").alias(key), F.col("label").alias("_label"))
    big, small, keys = _hot_sides(rows, target, key, row_id)
    return (big.join(small, keys, "left").withColumn(key, F.coalesce("_label", key))
            .select(*rows.columns))


def tree_roots(parent: DataFrame) -> DataFrame:
    """Pointer jumping: ``parent`` (node, label) with label the root of node's tree; hot labels are salted."""
    labels = parent
    while True:
        step = _follow(labels.withColumn("old", F.col("label")), "label", labels, "node")
        step = reliable_checkpoint(step)
        changed = step.where(F.col("label") != F.col("old")).limit(1).count()
        release(labels)
        labels = step.drop("old")
        if changed == 0:
            return labels


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         local_edges: int = LOCAL_EDGES) -> DataFrame:
    """GR2: (node, cluster_id) with cluster_id = smallest node of the component.

    Each round hooks every node to its smallest neighbour if that is smaller,
    compresses the trees by pointer jumping over the nodes alone, and
    contracts the edges to the roots, so that later rounds shuffle only the
    edges between trees.  Nodes that vanish in a round are labelled at the end,
    last round first.  Once at most ``local_edges`` edges are left one task
    settles them.  Nodes without an edge are not returned.
    """
    e = reliable_checkpoint(symmetrise(edges, src, dst))
    steps: list[DataFrame] = []
    while left := e.count():
        if left <= local_edges:
            last = reliable_checkpoint(_local(e, _smallest_reachable, e.schema["src"].dataType.simpleString()))
            steps.append(last.where(F.col("node") != F.col("label")))
            break
        parent = reliable_checkpoint(
            e.groupBy("src").agg(F.min("dst").alias("near"))
            .select(F.col("src").alias("node"), F.least("src", "near").alias("label")))
        roots = tree_roots(parent)
        steps.append(roots.where(F.col("node") != F.col("label")))
        moved = _follow(_follow(e, "src", roots, "dst"), "dst", roots, "src")
        contracted = reliable_checkpoint(moved.where(F.col("src") != F.col("dst")).distinct())
        release(e)
        e = contracted
    if not steps:
        return e.select(F.col("src").alias("node"), F.col("dst").alias("cluster_id"))
    labels = steps.pop()
    for step in reversed(steps):
        labels = reliable_checkpoint(labels.unionByName(_follow(step, "label", labels, "node")))
    roots = labels.select(F.col("label").alias("node")).distinct().withColumn("label", F.col("node"))
    return labels.unionByName(roots).withColumnRenamed("label", "cluster_id")


def cluster_members(components: DataFrame, node: str = "node") -> DataFrame:
    """GR3: the clusters as a long table (cluster_id, size, member), whatever their size."""
    sizes = components.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    big, small, keys = _hot_sides(components, sizes, "cluster_id", node)
    return big.join(small, keys).select("cluster_id", "size", F.col(node).alias("member"))


def cluster_lists(components: DataFrame, node: str = "node", max_members: int = 100_000) -> DataFrame:
    """GR3: (cluster_id, size, members) with sorted member lists, for clusters of bounded size.

    A list is one value in one task, so a cluster of more than ``max_members``
    nodes is an error here, never split or cut; ``cluster_members`` has no bound.
    """
    members = cluster_members(components, node)
    bounded = F.when(F.col("size") <= max_members, F.col("member")).otherwise(
        F.raise_error(F.lit(f"a cluster has more than {max_members} members; use cluster_members")))
    return (members.select("cluster_id", "size", bounded.alias("member")).groupBy("cluster_id")
            .agg(F.first("size").alias("size"), F.sort_array(F.collect_list("member")).alias("members")))


def cluster_sizes(components: DataFrame) -> DataFrame:
    """AGG5: members per cluster."""
    return components.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))


def leader_status(edges: DataFrame, src: str = "src", dst: str = "dst",
                  local_edges: int = LOCAL_EDGES, batch_edges: int = LOCAL_EDGES) -> DataFrame:
    """JN5: greedy assignment in id order, settled in rounds.

    Sequential rule: scanning files by id, a file not yet marked becomes a
    leader and marks every similar file.  Equivalent round form: a node is a
    duplicate as soon as some earlier neighbour is a leader, and a leader
    once all earlier neighbours are duplicates.  Output (node, is_leader).

    Nodes are numbered in id order once.  A round hands the statuses found so
    far on to later neighbours; only undecided nodes and the edges that can
    still decide them stay.  Then the earliest undecided nodes, as many as have
    at most ``batch_edges`` edges among them, are settled by one task, however
    their edges alternate: the number of rounds follows the number of such
    batches, not the depth of the graph.  Runs of nodes with one earlier
    neighbour behind the batch are shortened by jumping along them.  A graph of
    at most ``local_edges`` edges is settled by one task.
    """
    given = reliable_checkpoint(symmetrise(edges, src, dst).where(F.col("src") < F.col("dst")))
    if given.count() <= local_edges:
        return reliable_checkpoint(_local(given, _greedy_leaders, "boolean"))
    names = (given.select(F.col("src").alias("name")).unionByName(given.select(F.col("dst").alias("name")))
             .distinct())
    numbers = reliable_checkpoint(with_row_index(names, [F.col("name")], "node"))
    live = given
    for end in ("src", "dst"):
        target = numbers.select(F.col("name").alias(end), F.col("node").alias("_node"))
        big, small, keys = _hot_sides(live, target, end, "dst" if end == "src" else "src")
        live = big.join(small, keys).withColumn(end, F.col("_node")).select("src", "dst")
    live = reliable_checkpoint(live)
    release(given)
    firsts = numbers.select("node").join(live.select(F.col("dst").alias("node")), "node", "left_anti")
    fresh = reliable_checkpoint(firsts.withColumn("is_leader", F.lit(True)))
    decided = [fresh]
    while True:
        # edges from decided nodes: a leader settles its later neighbours, a duplicate drops out
        open_edges = live.join(fresh.select(F.col("node").alias("dst")), "dst", "left_anti")
        marked = _with_status(open_edges, fresh)
        settled = (marked.where(F.col("is_leader")).select(F.col("dst").alias("node")).distinct()
                   .withColumn("is_leader", F.lit(False)))
        rest = (marked.where(F.col("is_leader").isNull()).select("src", "dst")
                .join(settled.select(F.col("node").alias("dst")), "dst", "left_anti"))
        freed = (marked.where(~F.coalesce("is_leader", F.lit(False))).select(F.col("dst").alias("node")).distinct()
                 .join(settled.select("node"), "node", "left_anti")
                 .join(rest.select(F.col("dst").alias("node")), "node", "left_anti")
                 .withColumn("is_leader", F.lit(True)))
        step = reliable_checkpoint(settled.unionByName(freed))
        rest = reliable_checkpoint(rest.select("src", "dst"))
        release(live)
        live = rest
        decided.append(step)
        left = live.count()
        if left == 0:
            break
        last = _prefix_end(live, left, batch_edges)
        # duplicates just found decide nothing; other nodes without an earlier neighbour left are leaders
        duplicates = step.where(~F.col("is_leader")).select(F.col("node").alias("src"))
        inner = live.where(F.col("dst") <= last).join(duplicates, "src", "left_anti")
        batch = reliable_checkpoint(_local(inner, _greedy_leaders, "boolean")
                                    .join(step.select("node"), "node", "left_anti"))
        fresh = step.unionByName(batch)
        decided.append(batch)
        behind = live.where(F.col("dst") > last)
        if not behind.isEmpty():
            runs = reliable_checkpoint(_run_statuses(behind, fresh))
            fresh = fresh.unionByName(runs)
            decided.append(runs)
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    found = reliable_checkpoint(numbers.join(out, "node").select(F.col("name").alias("node"), "is_leader"))
    for d in [*decided, numbers, live]:
        release(d)
    return found


def _prefix_end(edges: DataFrame, n: int, room: int) -> int:
    """A node number such that at most ``room`` of the ``n`` edges end at it or before, near to the largest such one.

    A quantile is enough, checked by a count; -1 if the first node alone has more edges."""
    share = room / n
    while share * n >= 1:
        quantile = F.percentile_approx("dst", min(share, 1.0), int(max(10_000, 10 / share)))
        end = edges.agg(quantile).first()[0]
        if edges.where(F.col("dst") <= end).count() <= room:
            return end
        share /= 2
    return -1


def _with_status(edges: DataFrame, status: DataFrame) -> DataFrame:
    """Edges with is_leader of their earlier end (null while undecided); hubs are salted."""
    target = status.withColumnRenamed("node", "src")
    big, small, keys = _hot_sides(edges, target, "src", "dst")
    return big.join(small, keys, "left").select("src", "dst", "is_leader")


def _run_statuses(edges: DataFrame, known: DataFrame) -> DataFrame:
    """Statuses of nodes at the end of runs of single-neighbour nodes whose head is known.

    A node with one undecided earlier neighbour is its opposite: follow
    (head, parity) along such nodes by doubling."""
    single = (edges.groupBy("dst").agg(F.count(F.lit(1)).alias("n"), F.min("src").alias("head"))
              .where("n = 1").select(F.col("dst").alias("node"), "head", F.lit(1).alias("odd")))
    jumps = reliable_checkpoint(single)
    while True:
        ahead = jumps.select(F.col("node").alias("head"), F.col("head").alias("head2"), F.col("odd").alias("odd2"))
        big, small, keys = _hot_sides(jumps, ahead, "head", "node")
        step = reliable_checkpoint(
            big.join(small, keys, "left")
            .select("node", F.coalesce("head2", "head").alias("head"),
                    F.col("odd").bitwiseXOR(F.coalesce("odd2", F.lit(0))).alias("odd"),
                    F.col("head2").isNotNull().alias("moved")))
        moved = step.where("moved").limit(1).count()
        release(jumps)
        jumps = step.drop("moved")
        if moved == 0:
            break
    heads = known.select(F.col("node").alias("head"), "is_leader")
    return jumps.join(heads, "head").select("node", (F.col("is_leader") != (F.col("odd") == 1)).alias("is_leader"))


def leader_pairs(edges: DataFrame, status: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """JN5/JN6: (leader, duplicate): each duplicate attaches to its smallest
    earlier leader neighbour."""
    e = symmetrise(edges, src, dst).where(F.col("src") < F.col("dst"))
    leaders = status.where("is_leader").select(F.col("node").alias("src"))
    dups = status.where(~F.col("is_leader")).select(F.col("node").alias("dst"))
    return (e.join(leaders, "src").join(dups, "dst")
            .groupBy("dst").agg(F.min("src").alias("leader"))
            .select("leader", F.col("dst").alias("duplicate")))
