"""What a failing bank reaches: its stock, the holders, and what those holders also own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators.skew import PAIRS_PER_CELL, ROWS_PER_SPLIT, SENT_KEYS, grid_join, heavy_keys, sized_join, split_join
from riskweave.session import materialize

LISTED, OWNED = "PUBLICLY_TRADED_AS", "equity_ownership"


def _listings(nodes: DataFrame, edges: DataFrame, banks: DataFrame | None) -> DataFrame:
    """(bank, stock) from the listing edges; ``banks`` holds institution ids, all if absent."""
    chosen = nodes.where("node_type = 'bank'").select(
        F.col("node_id").alias("bank_node"), F.col("institution_id").alias("bank"))
    if banks is not None:
        chosen = chosen.join(banks.select(F.col("institution_id").alias("bank")), "bank", "left_semi")
    listed = edges.where(F.col("relationship_type") == LISTED).select(
        F.col("source_id").alias("bank_node"), F.col("target_id").alias("stock"))
    return chosen.join(listed, "bank_node").select("bank", "stock")


def _holdings(edges: DataFrame) -> DataFrame:
    """Holdings, with their weight if the edges carry one: counts need none."""
    return edges.where(F.col("relationship_type") == OWNED).select(
        F.col("source_id").alias("investor"), F.col("target_id").alias("stock"), *[c for c in edges.columns if c == "weight"])


def _owned(holdings: DataFrame, listings: DataFrame, rows_per_split: int, sent_listings: int = SENT_KEYS) -> DataFrame:
    """Holdings of listed stocks. Up to ``sent_listings`` listings are sent to the holdings, which then do not move."""
    listings = materialize(listings, "listings")
    if listings.count() <= sent_listings:
        return holdings.join(F.broadcast(listings), ["stock"])
    return sized_join(holdings, listings, ["stock"], rows_per_split)


def _second(book: DataFrame, first: DataFrame, pairs_per_cell: int) -> DataFrame:
    """The other stocks of reached investors. Both sides are counted by investor before they meet, so they are written once."""
    return grid_join(materialize(book, "book"), first, ["investor"], pairs_per_cell).where("stock <> stock1")


def _stocks(nodes: DataFrame) -> DataFrame:
    return nodes.where("node_type = 'stock'").select(
        F.col("node_id").alias("stock"), "ticker", "sector", "market_cap")


def _forced_sales(first: DataFrame, holdings: DataFrame, pairs_per_cell: int) -> DataFrame:
    """Per (bank, stock): summed weight and path count of what the bank's holders own.

    Parallel edges are reduced on both sides before they meet. An investor with a large book that
    many banks reach is cut on both sides. ``first`` is (bank, stock1, investor, paths).
    """
    book = holdings.groupBy("investor", "stock").agg(
        F.sum(F.col("weight").cast("decimal(28,2)")).alias("w"))
    reached = _second(book, first, pairs_per_cell)
    return reached.groupBy("bank", "stock").agg(
        F.sum(F.col("w") * F.col("paths").cast("decimal(10,0)")).alias("impact"))


def cascade_impact(
    nodes: DataFrame, edges: DataFrame, banks: DataFrame | None = None,
    require_all_hops: bool = False, rows_per_split: int = ROWS_PER_SPLIT, pairs_per_cell: int = PAIRS_PER_CELL,
) -> DataFrame:
    """Impact rows of every asked bank over three hops.

    Hop 1 is the bank's stock, hop 2 one row per holding of it, hop 3 the other stocks of
    those holders with their summed weight. ``require_all_hops`` keeps a bank only when each
    hop has a row.
    """
    listings, holdings, stocks = _listings(nodes, edges, banks), _holdings(edges), _stocks(nodes)
    people = nodes.where("node_type = 'institutional_investor'").select(
        F.col("node_id").alias("investor"), F.col("name").alias("investor_name"))

    def row(hop, kind, entity, name, impact, value, sector):
        return ["bank", F.lit(hop).alias("hop"), F.lit(kind).alias("entity_type"),
                entity.alias("entity_id"), name.alias("entity_name"),
                F.lit(impact).alias("impact_type"), value.alias("impact_value"),
                sector.alias("sector")]

    ticker, sector = F.col("ticker"), F.col("sector")
    hop1 = listings.join(stocks, "stock").select(
        *row(1, "stock", ticker, ticker, "Direct Crash", F.col("market_cap"), sector))
    owned = _owned(holdings, listings, rows_per_split)
    hop2 = sized_join(owned, people, ["investor"], rows_per_split).select(
        *row(2, "investor", F.col("investor"), F.col("investor_name"), "Portfolio Loss",
             F.col("weight"), F.lit("Investment")))
    first = materialize(owned.groupBy("bank", F.col("stock").alias("stock1"), "investor").agg(
        F.count("*").alias("paths")), "first")
    hop3 = _forced_sales(first, holdings, pairs_per_cell).join(stocks, "stock").select(
        *row(3, "stock", ticker, ticker, "Forced Selling", F.col("impact").cast("double"), sector))
    out = hop1.unionByName(hop2).unionByName(hop3)
    if require_all_hops:
        complete = out.groupBy("bank").agg(F.count_distinct("hop").alias("hops")).where("hops = 3")
        out = out.join(complete.select("bank"), "bank", "left_semi")
    return out


def cascade_summary(
    nodes: DataFrame, edges: DataFrame, banks: DataFrame | None = None,
    rows_per_split: int = ROWS_PER_SPLIT, pairs_per_cell: int = PAIRS_PER_CELL,
) -> DataFrame:
    """Per bank: distinct listed stocks, holders and other stocks of those holders.

    Banks without a listing keep a row of zeros.
    """
    everyone = nodes.where("node_type = 'bank'").select(
        F.col("institution_id").alias("bank"), F.col("name").alias("bank_name"),
        F.col("total_assets").alias("assets"))
    if banks is not None:
        everyone = everyone.join(banks.select(F.col("institution_id").alias("bank")), "bank", "left_semi")
    listings, holdings = _listings(nodes, edges, banks), _holdings(edges)
    direct = listings.distinct().groupBy("bank").agg(F.count("*").alias("direct_stocks"))
    first = materialize(_owned(holdings, listings, rows_per_split).select(
        "bank", F.col("stock").alias("stock1"), "investor").distinct(), "first")
    investors = first.select("bank", "investor").distinct().groupBy("bank").agg(
        F.count("*").alias("affected_investors"))
    book = holdings.select("investor", "stock").distinct()
    second = _second(book, first, pairs_per_cell).select(
        "bank", "stock").distinct().groupBy("bank").agg(F.count("*").alias("cascade_stocks"))
    counts = ["direct_stocks", "affected_investors", "cascade_stocks"]
    out = everyone
    for part in (direct, investors, second):
        out = out.join(part, "bank", "left")
    return out.fillna(0, counts).select("bank", "bank_name", "assets", *counts)


def total_impact():
    return F.col("direct_stocks") + F.col("affected_investors") + F.col("cascade_stocks")


def systemic_score(summary: DataFrame) -> DataFrame:
    """Score out of ten and the verbal assessment by number of affected investors."""
    hit = F.col("affected_investors")
    return summary.withColumns({
        "systemic_score": F.least(F.lit(10.0), total_impact() / F.lit(8.0)),
        "assessment": F.when(hit > 30, "CRITICAL").when(hit > 15, "HIGH").otherwise("MODERATE"),
    })


def systemic_ranking(nodes: DataFrame, edges: DataFrame, banks: DataFrame) -> DataFrame:
    """The asked banks by total impact, named only by their place in the request.

    ``banks`` has ``institution_id`` and ``position``, the place in the request.
    """
    asked = banks.select(F.col("institution_id").alias("bank"), "position")
    return cascade_summary(nodes, edges, banks).join(asked, "bank").select(
        F.concat(F.lit("Bank_Group_"), F.col("position").cast("string")).alias("bank_group"),
        F.col("direct_stocks").alias("direct_impact"),
        F.col("affected_investors").alias("investors"),
        F.col("cascade_stocks").alias("cascade_impact"),
        total_impact().alias("total_impact"),
    ).orderBy(F.desc("total_impact"), "bank_group")


def sector_breakdown(
    nodes: DataFrame, edges: DataFrame, banks: DataFrame | None = None, k: int = 3,
    rows_per_split: int = ROWS_PER_SPLIT, pairs_per_cell: int = PAIRS_PER_CELL,
) -> DataFrame:
    """Per bank and sector: distinct stocks hit by forced selling, groups below ``k`` left out."""
    listings, holdings = _listings(nodes, edges, banks), _holdings(edges)
    first = materialize(_owned(holdings, listings, rows_per_split).select(
        "bank", F.col("stock").alias("stock1"), "investor").distinct(), "first")
    book = holdings.select("investor", "stock").distinct()
    reached = _second(book, first, pairs_per_cell).select(
        "bank", "stock").distinct()
    return reached.join(_stocks(nodes).select("stock", "sector"), "stock").groupBy("bank", "sector").agg(
        F.count("*").alias("affected_count")).where(F.col("affected_count") >= k)


# Banks of a node that one row holds; longer lists are cut.
BANKS_PER_ROW = 1_000


def cascade_subgraph(
    nodes: DataFrame, edges: DataFrame, bank: str | None = None, limit: int | None = None,
    rows_per_split: int = ROWS_PER_SPLIT, pairs_per_cell: int = PAIRS_PER_CELL, banks_per_row: int = BANKS_PER_ROW,
) -> DataFrame:
    """Per bank the edges among the nodes of its cascade, of all banks or of one, all of them or the first ``limit`` in order.

    The pattern's steps may be skipped, so a chain that stops early still adds its nodes. Without holders the
    pattern has no match and the bank has no rows. Every node takes the list of its banks along, and only banks
    that the lists of an edge's ends share become rows.
    """
    stocks = nodes.where("node_type = 'stock'").select(F.col("node_id").alias("stock"))
    people = nodes.where("node_type = 'institutional_investor'").select(F.col("node_id").alias("investor"))
    start = nodes.where("node_type = 'bank' and institution_id is not null").select(F.col("institution_id").alias("bank"), F.col("node_id").alias("id"))
    asked = None
    if bank is not None:
        start = start.where(F.col("bank") == bank)
        asked = start.select(F.col("bank").alias("institution_id")).distinct()
    listings = materialize(_listings(nodes, edges, asked).where("bank is not null").distinct().join(stocks, "stock", "left_semi"), "listings")
    book = materialize(_holdings(edges).select("investor", "stock").distinct().join(stocks, "stock", "left_semi").join(people, "investor", "left_semi"), "book")
    investors = materialize(_owned(book, listings, rows_per_split).select("bank", "investor").distinct(), "investors")
    second = grid_join(book, investors, ["investor"], pairs_per_cell).select("bank", "stock")
    whole = investors.select("bank").distinct()
    members = materialize(
        start.join(whole, "bank", "left_semi").select("bank", "id")
        .union(listings.join(whole, "bank", "left_semi").select("bank", "stock"))
        .union(investors.select("bank", "investor")).union(second).distinct(), "members")

    chunks = max(1, -(-whole.count() // banks_per_row))
    held = materialize(members.groupBy("id", F.pmod(F.xxhash64("bank"), F.lit(chunks)).alias("_chunk")).agg(F.collect_list("bank").alias("_banks")), "held")
    known = held.select("id").distinct()
    inside = materialize(
        edges.select("source_id", "target_id", "relationship_type", "weight")
        .join(known.select(F.col("id").alias("source_id")), "source_id", "left_semi")
        .join(known.select(F.col("id").alias("target_id")), "target_id", "left_semi"), "inside")
    near = sized_join(inside, held.withColumnRenamed("id", "source_id"), ["source_id"], rows_per_split)
    far = held.select(F.col("id").alias("target_id"), "_chunk", F.col("_banks").alias("_others"))
    # the rows of a target are its edges, once for each list of banks
    hot = materialize(heavy_keys(inside, ["target_id"], rows_per_split), "heavy")
    if hot.isEmpty():
        met = near.join(far, ["target_id", "_chunk"])
    else:
        every = hot.crossJoin(edges.sparkSession.range(chunks).select(F.col("id").alias("_chunk")))
        met = split_join(near, far, ["target_id", "_chunk"], rows_per_split, hot=materialize(every, "heavy"))
    out = met.select(F.explode(F.array_intersect("_banks", "_others")).alias("bank"), "source_id", "target_id", "relationship_type", "weight")
    if limit is None:
        return out
    return out.orderBy("bank", "source_id", "target_id", "relationship_type").limit(limit)
