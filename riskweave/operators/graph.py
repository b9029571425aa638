"""Graph measures per node: degree, exposure, clustering, PageRank, BFS, betweenness.

``edges`` needs ``source_id`` and ``target_id`` (and ``weight`` for exposure); ``nodes``
needs ``node_id``. Iterative measures work on an indexed graph with whole-number ids, built
once and shared. Loops write each round to the shared scratch area, so plans stay short and
a lost executor costs one round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.columns import fill_zero_all
from riskweave.functions.hashing import order_key
from riskweave.operators import sequence
from riskweave.operators.skew import ROWS_PER_SPLIT, SENT_KEYS, all_parts, part_of, sized_join
from riskweave.session import materialize, scratch_path, together

# PageRank rounds evaluated in one job before the ranks are written out.
ROUNDS_PER_JOB = 5


# Digits behind the point that sums of weights keep; larger amounts than fit are an error.
SCALE = 12
AMOUNT = f"decimal(28,{SCALE})"


def _ends(edges: DataFrame, at_source: dict, at_target: dict) -> DataFrame:
    """Both ends of every edge as rows, from one pass over the edges."""
    def end(node, values):
        return F.struct(F.col(node).alias("node_id"), *[v.alias(k) for k, v in values.items()])

    both = F.array(end("source_id", at_source), end("target_id", at_target))
    return edges.select(F.inline(both)).where("node_id is not null")


def node_universe(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Every node of the table or of an edge end."""
    return nodes.select("node_id").where("node_id is not null").union(_ends(edges, {}, {})).distinct()


def degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """In, out and total degree; parallel edges count each."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    marks = _ends(edges, {"i": zero, "o": one}, {"i": one, "o": zero}).unionByName(
        nodes.where("node_id is not null").select("node_id", zero.alias("i"), zero.alias("o")))
    return marks.groupBy("node_id").agg(
        F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"),
        (F.sum("i") + F.sum("o")).alias("total_degree"))


def exposure(nodes: DataFrame, edges: DataFrame, mode: str = "sum", seq: str | None = None) -> DataFrame:
    """Incoming, outgoing, net and total exposure per node.

    ``sum`` adds every edge weight. ``last`` lets the last parallel edge by ``seq`` set the
    weight of a pair, counted once per parallel edge. Money is added as decimals, so the
    result does not depend on the order of addition; ``SCALE`` digits behind the point stay.
    """
    weighted = edges
    if mode == "last":
        weighted = edges.groupBy("source_id", "target_id").agg(
            (F.max(F.struct(F.col(seq), F.col("weight")))["weight"] * F.count("*")).alias("weight"))
    money = F.coalesce(F.col("weight"), F.lit(0.0)).cast(AMOUNT)
    none = F.lit(0).cast(AMOUNT)
    flows = _ends(weighted, {"i": none, "o": money}, {"i": money, "o": none}).unionByName(
        nodes.where("node_id is not null").select("node_id", none.alias("i"), none.alias("o")))
    total = flows.groupBy("node_id").agg(F.sum("i").alias("i"), F.sum("o").alias("o"))
    return total.select(
        "node_id",
        F.col("i").cast("double").alias("incoming_exposure"),
        F.col("o").cast("double").alias("outgoing_exposure"),
        (F.col("i") - F.col("o")).cast("double").alias("net_exposure"),
        (F.col("i") + F.col("o")).cast("double").alias("total_exposure"),
    )


def neighbour_sets(edges: DataFrame) -> DataFrame:
    """Undirected neighbour sets as distinct (node_id, neighbour) rows.

    A hub's set does not fit one row, so sets stay relations.
    """
    linked = edges.where("source_id is not null and target_id is not null")
    return _ends(
        linked, {"neighbour": F.col("target_id")}, {"neighbour": F.col("source_id")}).distinct()


class IndexedGraph(NamedTuple):
    """Nodes ``(node_id, id)`` and distinct links ``(src, dst, m)`` with ``m`` parallel edges."""

    ids: DataFrame
    links: DataFrame
    n: int

    def named(self, df: DataFrame, **ends: str) -> DataFrame:
        """Replace whole-number columns by node ids: ``column="new_name"``."""
        for column, name in ends.items():
            df = df.join(self.ids.select(F.col("id").alias(column), F.col("node_id").alias(name)), column, "left")
        return df


def dense_ids(universe: DataFrame) -> DataFrame:
    """Number distinct nodes 0..N-1 in id order.

    Nodes are range-partitioned and written with their range number; each range is numbered
    alone and shifted by the sizes of the ranges before it.
    """
    ranged = materialize(
        universe.repartitionByRange("node_id").withColumn("part", F.spark_partition_id()), "ranged")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("node_id"))
    return materialize(ranged.withColumn("place", place).join(shift, "part").select(
        "node_id", (F.col("shift") + F.col("place") - 1).alias("id")), "ids")


def index_graph(nodes: DataFrame, edges: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> IndexedGraph:
    """Whole-number form of a graph. Parallel edges are counted before any join."""
    ids = dense_ids(node_universe(nodes, edges))
    pairs = materialize(
        edges.where("source_id is not null and target_id is not null")
        .groupBy("source_id", "target_id").agg(F.count("*").alias("m")), "pairs")
    half = sized_join(
        pairs, ids.select(F.col("node_id").alias("source_id"), F.col("id").alias("src")),
        ["source_id"], rows_per_split)
    links = sized_join(
        half.select("src", "target_id", "m"),
        ids.select(F.col("node_id").alias("target_id"), F.col("id").alias("dst")),
        ["target_id"], rows_per_split)
    return IndexedGraph(ids, materialize(links.select("src", "dst", "m"), "links"), ids.count())


# Neighbours that one row holds; longer lists are cut.
NEIGHBOURS_PER_ROW = 1_000


def _corners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links ``v, x`` with the sorted neighbours of both ends: what their triangles add to each corner, added up per batch."""
    for batch in batches:
        lists = {c: batch.column(c) for c in ("ids_v", "both_v", "ids", "both")}
        flat = {c: a.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c, a in lists.items()}
        row = {c: np.repeat(np.arange(batch.num_rows), pc.list_value_length(a).to_numpy()) for c, a in lists.items()}
        span = 1 + max((int(f.max()) for f in flat.values() if len(f)), default=0)
        # rows follow each other and lists are sorted, so the keys are
        key = {c: row[c] * span + flat[c] for c in lists}

        def among(wanted, given):
            if not len(given):
                return np.zeros(len(wanted), bool)
            return given[np.minimum(np.searchsorted(given, wanted), len(given) - 1)] == wanted

        hit = among(key["ids_v"], key["ids"])
        shared, at = key["ids_v"][hit], row["ids_v"][hit]
        count = np.bincount(at, minlength=batch.num_rows)
        v, x, m = (batch.column(c).to_numpy() for c in ("v", "x", "m_vx"))
        ranks, place = np.unique(np.concatenate([v, x, flat["ids_v"][hit]]), return_inverse=True)
        opposite = np.zeros(len(ranks), np.int64)
        np.add.at(opposite, place, np.concatenate([
            count + np.bincount(at[among(shared, key["both"])], minlength=batch.num_rows),
            count + np.bincount(at[among(shared, key["both_v"])], minlength=batch.num_rows), m[at]]))
        some = opposite > 0
        yield pa.RecordBatch.from_arrays([pa.array(ranks[some].astype(np.int64)), pa.array(opposite[some])], ["rank", "opposite"])


def clustering(
    nodes: DataFrame, edges: DataFrame, indexed: IndexedGraph | None = None, piece: int = NEIGHBOURS_PER_ROW,
) -> DataFrame:
    """Directed edges among a node's neighbours over the ordered neighbour pairs.

    Undirected pairs are oriented from the end with fewer neighbours to the other, so a node
    keeps at most sqrt(2 * pairs) outgoing pairs and hubs few candidates. Nodes are numbered in that
    order, and a link takes only its low end's neighbours beyond its high end to the neighbours of
    that one; pairs of neighbours that are not linked never become rows. Each triangle adds to a corner the number of directed edges on the opposite side. A self
    loop makes the node its own neighbour, and its links then count as links among neighbours.
    """
    g = indexed or index_graph(nodes, edges)
    proper = materialize(g.links.where("src <> dst").groupBy(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"),
    ).agg(F.count("*").alias("m")), "undirected")
    around = materialize(
        proper.select(F.explode(F.array("a", "b")).alias("id"), "m")
        .groupBy("id").agg(F.count("*").alias("k"), F.sum("m").alias("linked")), "around")

    # whole numbers in the order of (neighbours, id): a pair is oriented from the smaller to the greater
    whole = "int" if g.n < 1 << 31 else "bigint"
    rank = sequence.numbered(around.select("k", "id"), ["k", "id"], "rank").select("id", F.col("rank").cast(whole).alias("rank"))

    def ranked(end):
        return rank.select(F.col("id").alias(end), F.col("rank").alias(f"r_{end}"))

    sized = sized_join(sized_join(proper, ranked("a"), ["a"]), ranked("b"), ["b"])
    oriented = sized.select(F.least("r_a", "r_b").alias("v"), F.greatest("r_a", "r_b").alias("x"), "m")

    # out-neighbours of each node as sorted arrays, and those that are linked both ways; pieces bound a row
    place = F.floor((F.row_number().over(Window.partitionBy("v").orderBy("x")) - 1) / piece)
    listed = F.array_sort(F.collect_list(F.struct("x", "m")))
    out = materialize(oriented.withColumn("_piece", place).groupBy("v", "_piece").agg(listed.alias("_to")).select(
        "v", "_piece", F.col("_to.x").alias("ids"), F.col("_to.m").alias("ms"),
        F.transform(F.filter("_to", lambda t: t["m"] > 1), lambda t: t["x"]).alias("both")), "neighbours")
    # each link takes the neighbours of its low end beyond its high end there; only common ones become rows
    near = out.select("v", F.col("ids").alias("_ids"), F.col("both").alias("_both"), F.posexplode(F.arrays_zip("ids", "ms")).alias("_at", "_to"))
    near = near.select(
        "v", F.col("_to.ids").alias("x"), F.col("_to.ms").alias("m_vx"),
        F.expr("slice(_ids, _at + 2, size(_ids))").alias("ids_v"), F.filter("_both", lambda y: y > F.col("_to.ids")).alias("both_v"))
    # a long list: pairs of an earlier piece with a later one
    later = out.where("_piece > 0").select("v", F.col("_piece").alias("_later"), F.col("ids").alias("ids_v"), F.col("both").alias("both_v"))
    across = out.join(later, "v").where("_piece < _later").select("v", "ids_v", "both_v", F.explode(F.arrays_zip("ids", "ms")).alias("_to"))
    near = near.unionByName(across.select("v", F.col("_to.ids").alias("x"), F.col("_to.ms").alias("m_vx"), "ids_v", "both_v"))
    met = sized_join(near.where(F.size("ids_v") > 0), out.select(F.col("v").alias("x"), "ids", "both"), ["x"])
    corners = met.select("v", "x", "m_vx", "ids_v", "both_v", "ids", "both").mapInArrow(_corners, "rank bigint, opposite bigint")
    corners = corners.groupBy("rank").agg(F.sum("opposite").alias("opposite")).join(rank, "rank").select("id", "opposite")
    between = corners.groupBy("id").agg(F.sum("opposite").alias("between"))
    loops = g.links.where("src = dst").select(F.col("src").alias("id"), F.lit(1).alias("loop"))
    joined = (
        g.ids.join(around, "id", "left").join(between, "id", "left").join(loops, "id", "left")
        .fillna(0, ["k", "linked", "between", "loop"])
    )
    k = F.col("k") + F.col("loop")
    found = F.col("between") + F.col("loop") * F.col("linked")
    return joined.select(
        "node_id",
        F.when(k < 2, F.lit(0.0)).otherwise(found / (k * (k - 1))).alias("clustering_coefficient"))


def pagerank(
    nodes: DataFrame, edges: DataFrame, iters: int = 20, damping: float = 0.85,
    dangling: str = "drop", rows_per_split: int = ROWS_PER_SPLIT, indexed: IndexedGraph | None = None,
) -> DataFrame:
    """Fixed-round PageRank; parallel edges count each on both sides.

    ``dangling='drop'`` loses the rank of nodes without outgoing edges, ``'uniform'``
    spreads it over all nodes. A source with more than ``rows_per_split`` links is cut into
    parts and its rank is repeated per part.
    """
    g = indexed or index_graph(nodes, edges, rows_per_split)
    if g.n == 0:
        return g.ids.select("node_id", F.lit(0.0).alias("pagerank_score"))
    out = g.links.groupBy("src").agg(F.sum("m").alias("out_edges"), F.count("*").alias("out_links"))
    parts = F.ceil(F.col("out_links") / rows_per_split).cast("int")
    base = materialize(g.ids.select("id").join(
        out.select(F.col("src").alias("id"), parts.alias("parts")), "id", "left").fillna(0, ["parts"]), "base")
    split = (base.agg(F.max("parts")).first()[0] or 0) > 1
    key = ["src", "part"] if split else ["src"]
    # Placed and sorted once by the join key; rounds then move only ranks and partial sums.
    # The count fills the cache, so that planning of the rounds sees its placement.
    shares = sized_join(g.links, out, ["src"], rows_per_split).select(
        "src", "dst", (F.col("m") / F.col("out_edges")).alias("share"),
        *([part_of(parts, F.col("dst")).alias("part")] if split else []))
    width = int(shares.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = shares.repartition(width, *key).sortWithinPartitions(*key).persist()
    shares.count()

    start = (1.0 - damping) / g.n
    ranks = base.withColumn("rank", F.lit(1.0 / g.n))
    for i in range(iters):
        sending = ranks.where("parts > 0").select(F.col("id").alias("src"), "rank", "parts")
        if split:
            sending = sending.select("src", "rank", all_parts(F.col("parts")).alias("part"))
        flow = shares.join(sending.drop("parts"), key)
        leak = F.lit(0.0)
        if dangling == "uniform":
            lost = ranks.where("parts = 0").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).scalar()
            leak = F.lit(damping / g.n) * lost
        arrivals = flow.select(
            F.col("dst").alias("id"), (F.col("rank") * F.col("share")).alias("r"), F.lit(0).alias("parts"),
        ).unionByName(base.select("id", F.lit(0.0).alias("r"), "parts"))
        ranks = arrivals.groupBy("id").agg(
            F.sum("r").alias("r"), F.max("parts").alias("parts")
        ).select("id", "parts", (F.lit(start) + leak + F.lit(damping) * F.col("r")).alias("rank"))
        # The uniform variant reads the ranks twice per round.
        if dangling == "uniform" or (i + 1) % ROUNDS_PER_JOB == 0 or i + 1 == iters:
            ranks = materialize(ranks, "ranks")
    shares.unpersist()
    return g.ids.join(ranks, "id").select("node_id", F.col("rank").alias("pagerank_score"))


# Bits of a word of sources, and bits that a task unpacks at a time.
WORD = 64
BITS_AT_ONCE = 1 << 21
NO_NODE = np.iinfo(np.int64).max


def _first_reached(words: int, whole: int = BITS_AT_ONCE) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links ``(src, dst, w0, ...)`` with the sources of ``src`` as bits: smallest ``src`` per (source, dst) of a stretch of rows."""
    n_slots = words * WORD

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, max(1, whole // n_slots)):
                yield first(batch.slice(start, max(1, whole // n_slots)))

    def first(rows: pa.RecordBatch) -> pa.RecordBatch:
        src = rows.column("src").to_numpy()
        nodes, place = np.unique(rows.column("dst").to_numpy(), return_inverse=True)
        bits = np.stack([rows.column(f"w{i}").to_numpy() for i in range(words)], axis=1).astype("<i8")
        row, slot = np.nonzero(np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little"))
        parent = np.full(len(nodes) * n_slots, NO_NODE)
        np.minimum.at(parent, place[row] * n_slots + slot, src[row])
        found = np.flatnonzero(parent != NO_NODE)
        return pa.RecordBatch.from_arrays(
            [pa.array((found % n_slots).astype("int32")), pa.array(nodes[found // n_slots]), pa.array(parent[found])], ["slot", "id", "parent"])

    return reduced


def frontier_expand(frontier: DataFrame, links: DataFrame, visited: DataFrame, keys: list[str], words: int) -> DataFrame:
    """Next BFS level: unseen targets per source, parent = smallest id that reaches them.

    A node meets its links once, with all the sources that reach it as bits of ``w0``, ...; targets are reduced per
    (source, node) in the tasks that find them, before the shuffle.
    """
    held = [f"w{i}" for i in range(words)]
    met = links.join(frontier, keys).select("src", "dst", *held)
    found = met.mapInArrow(_first_reached(words), "slot int, id bigint, parent bigint").groupBy("slot", "id").agg(F.min("parent").alias("parent"))
    return found.join(visited.select("slot", "id"), ["slot", "id"], "left_anti")


def _bfs(
    g: IndexedGraph, sources: DataFrame, max_depth: int | None = None,
    rows_per_split: int = ROWS_PER_SPLIT, sent_nodes: int = SENT_KEYS,
) -> tuple[DataFrame, DataFrame]:
    """Trees as (slot, id, parent, depth) and the sources as (slot, id).

    Links lie in ranges of (dst, src), so most links of a target are reduced by one task. A level of at most
    ``sent_nodes`` nodes is sent to the links, a bigger one meets them by shuffle, where heavy nodes are cut into parts.
    """
    spark = g.links.sparkSession
    links = g.links.where("src <> dst").select("src", "dst")
    heavy = materialize(
        links.groupBy("src").agg(F.ceil(F.count("*") / rows_per_split).cast("int").alias("parts"))
        .where("parts > 1"), "heavy")
    split = not heavy.isEmpty()
    if split:
        links = links.join(heavy, "src", "left").select(
            "src", "dst", part_of(F.coalesce("parts", F.lit(1)), F.col("dst")).alias("part"))
    links = materialize(links.repartitionByRange("dst", "src").sortWithinPartitions("dst"), "links")

    # Sources are a short list by contract, so numbering them in one task is cheap.
    numbered = materialize(sources.select("node_id").distinct().join(g.ids, "node_id").select(
        (F.row_number().over(Window.orderBy("id")) - 1).alias("slot"), "id"), "sources")
    words = max(1, -(-numbered.count() // WORD))
    bit = F.expr(f"shiftleft(1L, slot % {WORD})")
    held = [F.bit_or(F.when(F.floor(F.col("slot") / WORD) == i, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"w{i}") for i in range(words)]

    # a folder for all levels: whatever the depth, the nodes seen so far are one scan
    path, depth = scratch_path(spark, "levels"), 0
    numbered.select("slot", "id", F.lit(None).cast("bigint").alias("parent")).write.parquet(f"{path}/depth=0")
    while True:
        tree = spark.read.schema("slot int, id bigint, parent bigint, depth int").parquet(path)
        front = materialize(tree.where(F.col("depth") == depth).groupBy(F.col("id").alias("src")).agg(*held), "front")
        n_front = front.count()
        if n_front == 0 or depth == max_depth:
            return tree, numbered
        keys = ["src"]
        if n_front <= sent_nodes:
            front = F.broadcast(front)
        elif split:
            front = front.join(heavy, "src", "left").withColumn("part", all_parts(F.coalesce("parts", F.lit(1)))).drop("parts")
            keys = ["src", "part"]
        depth += 1
        frontier_expand(front, links, tree, keys, words).write.parquet(f"{path}/depth={depth}")


def bfs_tree(
    nodes: DataFrame, edges: DataFrame, sources: DataFrame, max_depth: int | None = None,
    rows_per_split: int = ROWS_PER_SPLIT, indexed: IndexedGraph | None = None,
) -> DataFrame:
    """One BFS tree per source over outgoing edges: (source, node_id, parent, depth).

    A node with more than ``rows_per_split`` links has them cut into parts, each under a key
    of its own.
    """
    g = indexed or index_graph(nodes, edges, rows_per_split)
    tree, numbered = _bfs(g, sources, max_depth, rows_per_split)
    rooted = tree.join(numbered.select("slot", F.col("id").alias("root")), "slot")
    return g.named(rooted, root="source", id="node_id", parent="parent_id").select(
        "source", "node_id", F.col("parent_id").alias("parent"), "depth")


def seeded_sources(universe: DataFrame, n: int = 100, seed: int = 0) -> DataFrame:
    """Uniform sample of ``n`` nodes that depends only on the seed and the ids."""
    return universe.orderBy(order_key(seed, F.col("node_id")), "node_id").limit(n).select("node_id")


def betweenness_sampled(
    nodes: DataFrame, edges: DataFrame, sources: int = 100, seed: int = 0,
    rows_per_split: int = ROWS_PER_SPLIT, indexed: IndexedGraph | None = None,
) -> DataFrame:
    """Interior visits over one BFS tree per sampled source, over (N - 1)(N - 2).

    The paths that pass a node are as many as its descendants in the tree, so levels are
    folded from the deepest up and no path is ever built.
    """
    g = indexed or index_graph(nodes, edges, rows_per_split)
    tree, numbered = _bfs(g, seeded_sources(g.ids, sources, seed), None, rows_per_split)
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    below = tree.limit(0).select("slot", "id", F.lit(0).cast("bigint").alias("n_below"))
    counts = []
    for depth in range(deepest, 1, -1):
        folded = (
            tree.where(F.col("depth") == depth).join(below, ["slot", "id"], "left")
            .groupBy("slot", F.col("parent").alias("id"))
            .agg(F.sum(1 + F.coalesce("n_below", F.lit(0))).alias("n_below"))
        )
        below = materialize(folded, "below")
        counts.append(below.select("id", "n_below"))
    norm = float((g.n - 1) * (g.n - 2)) if g.n > 2 else 1.0
    # Depth 1 nodes hang off the source, which is an end of every path.
    visits = g.ids.select("id", F.lit(0).cast("bigint").alias("n_below"))
    for part in counts:
        visits = visits.unionByName(part)
    total = visits.groupBy("id").agg((F.sum("n_below") / F.lit(norm)).alias("betweenness_centrality"))
    return g.ids.join(total, "id").select("node_id", "betweenness_centrality")


METRICS = [
    "pagerank_score", "in_degree", "out_degree", "total_degree", "betweenness_centrality",
    "clustering_coefficient", "incoming_exposure", "outgoing_exposure", "net_exposure",
    "total_exposure",
]


def feature_join(nodes: DataFrame, metrics: list[DataFrame]) -> DataFrame:
    """Nodes with every metric table; all joins share the node id partitioning."""
    out = nodes
    for metric in metrics:
        out = out.join(metric, "node_id", "left")
    return out


def node_features(
    nodes: DataFrame, edges: DataFrame, iters: int = 20, sources: int = 100, seed: int = 0, written: bool = False,
) -> DataFrame:
    """Node table with ten graph measures; every missing cell becomes zero.

    Both inputs are read many times, so they are written out once, unless they are ``written`` tables already.
    The measures do not need each other: they run side by side, and the many small stages of the searches
    and rounds leave no cores idle.
    """
    if not written:
        nodes, edges = materialize(nodes, "nodes"), materialize(
            edges.select("source_id", "target_id", "weight"), "edges")
    g = index_graph(nodes, edges)
    joined = feature_join(nodes, together(nodes.sparkSession, [
        lambda: materialize(pagerank(nodes, edges, iters, indexed=g), "pagerank"),
        lambda: materialize(degree(nodes, edges), "degree"),
        lambda: materialize(betweenness_sampled(nodes, edges, sources, seed, indexed=g), "betweenness"),
        lambda: materialize(clustering(nodes, edges, indexed=g), "clustering"),
        lambda: materialize(exposure(nodes, edges), "exposure"),
    ]))
    return materialize(fill_zero_all(joined.select(*nodes.columns, *METRICS)), "features")
