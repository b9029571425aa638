"""The same results as SQL over the raw tables, for a second engine.

Each statement is written independently of the DataFrame code: plain joins, window
functions and path enumeration where the jobs use folded or partial forms.
"""

from __future__ import annotations

from riskweave.functions.hashing import PRIME, coefficients
from riskweave.operators.graph import METRICS
from riskweave.operators.lsh import NUM_BANDS, NUM_HASHES
from riskweave.plans.tables import AMOUNT_SCALE, BANK_STEP, LINE, RULES, SERIES, TABLES
from riskweave import schemas

NODE_COLS = schemas.NODES.names
EDGE_COLS = schemas.EDGES.names
NODE_TYPES = {f.name: f.dataType.simpleString() for f in schemas.NODES}
EDGE_TYPES = {f.name: f.dataType.simpleString() for f in schemas.EDGES}


def _project(cols, types, given):
    return ", ".join(f"cast({given.get(c, 'null')} as {types[c].replace('string', 'varchar')}) as {c}" for c in cols)


def _nodes(given, source):
    return f"select {_project(NODE_COLS, NODE_TYPES, given)} from {source}"


def _edges(given, source):
    return f"select {_project(EDGE_COLS, EDGE_TYPES, given)} from {source}"


_KIND = ("case f.l_returnflag when 'A' then 'overnight_lending' when 'R' then 'repo_agreement' "
         "else 'interbank_lending' end")

# -- shared sub-queries -----------------------------------------------------------------

LINE_ORDER = f"""
placed as (select *, row_number() over (order by l_orderkey, {", ".join(LINE)}) - 1 as seq from lineitem)"""

TRANSACTIONS = LINE_ORDER + f""",
tx as (select f.seq, 'BANK_' || (f.l_suppkey * {BANK_STEP}) as source_id,
  'BANK_' || (g.l_suppkey * {BANK_STEP}) as target_id, {_KIND} as relationship_type,
  f.l_extendedprice * cast({AMOUNT_SCALE} as double) as weight, cast(f.l_shipdate as date) as transaction_date,
  cast(f.l_quantity as bigint) as maturity_days, f.l_discount as interest_rate
  from placed f join placed g on f.l_orderkey = g.l_orderkey and g.seq = f.seq + 1 where f.l_suppkey <> g.l_suppkey)"""

CORRELATIONS = """
corr as (select f.seq, cast(f.l_partkey as varchar) as symbol1, cast(g.l_partkey as varchar) as symbol2,
  (f.l_discount - cast(0.05 as double)) * cast(16.0 as double) as correlation
  from placed f join placed g on f.l_orderkey = g.l_orderkey and g.seq = f.seq + 1 where f.l_partkey <> g.l_partkey)"""

HOLDINGS = """
held as (select cast(o_custkey as varchar) as filer_cik, cast(o_orderdate as date) as filing_date,
  cast(l_partkey as varchar) as issuer_name, l_extendedprice as value, cast(l_quantity as bigint) as shares,
  l_orderkey as seq from lineitem join orders on l_orderkey = o_orderkey)"""

NODES = "\nnodes as (" + "\nunion all ".join([
    _nodes({
        "node_id": f"'BANK_' || (s_suppkey * {BANK_STEP})", "node_type": "'bank'", "network_layer": "'banking'",
        "name": "s_name", "institution_id": f"s_suppkey * {BANK_STEP}", "tier": "r_name",
        "total_assets": "s_acctbal", "total_deposits": "s_acctbal * 0.5", "total_loans": "s_acctbal * 0.25",
        "equity": "s_acctbal * 0.125", "num_branches": "s_nationkey + 1", "num_employees": "s_nationkey * 100",
    }, "supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"),
    _nodes({
        "node_id": "'FDIC_' || n_nationkey", "node_type": "'fdic_bank'", "network_layer": "'banking'",
        "name": "n_name", "cert": "n_nationkey", "assets": "0", "city": "r_name", "state": "substr(n_name, 1, 2)",
    }, "nation join region on n_regionkey = r_regionkey"),
    _nodes({
        "node_id": "'STOCK_' || p_partkey", "node_type": "'stock'", "network_layer": "'market'", "name": "p_name",
        "ticker": "p_partkey", "sector": "p_type", "industry": "p_brand",
        "market_cap": "p_retailprice * 1024.0", "trailing_pe": "p_size", "debt_to_equity": "nullif(p_size, 1)",
        "beta": "1.0",
    }, "part"),
    _nodes({
        "node_id": "'INST_' || cik", "node_type": "'institutional_investor'", "network_layer": "'ownership'",
        "name": "'Institution_' || cik", "cik": "cik",
    }, "(select distinct o_custkey as cik from orders)"),
]) + ")"

MAPPING = """
banks as (select * from nodes where node_type = 'bank'), stocks as (select * from nodes where node_type = 'stock'),
mapping as (select coalesce(b.institution_id, s.ticker) as ticker, b.node_id as bank_node_id, s.node_id as stock_node_id,
  coalesce(b.name, s.name) as entity_name,
  case when s.node_id is null then 'bank_not_public' when b.node_id is null then 'stock_not_bank' else 'publicly_traded_bank' end as entity_type,
  b.node_id is not null and s.node_id is not null as matched,
  coalesce(b.total_assets, 0) as total_assets, coalesce(s.market_cap, 0) as market_cap
  from banks b full join stocks s on b.institution_id = s.ticker)"""

BRIDGES = """
bridges as (
  select bank_node_id as source_id, stock_node_id as target_id, 'PUBLICLY_TRADED_AS' as relationship_type,
    'cross_layer_bridge' as network_layer, true as layer_bridge, 'corporate_identity' as bridge_type, ticker,
    cast(1.0 as double) as weight, cast(0.9 as double) as propagation_factor from mapping where matched
  union all
  select stock_node_id, bank_node_id, 'REPRESENTS_BANK', 'cross_layer_bridge', true, 'corporate_identity', ticker,
    cast(1.0 as double), cast(0.8 as double) from mapping where matched)"""


def _first(source, keys, order):
    return (f"(select * from (select *, row_number() over (partition by {keys} order by {order}) rn "
            f"from {source}) where rn = 1)")


EDGES = "\nedges as (" + "\nunion all ".join([
    _edges({
        "source_id": "source_id", "target_id": "target_id", "relationship_type": "relationship_type",
        "network_layer": "'banking'", "weight": "weight", "transaction_date": "transaction_date",
        "maturity_days": "maturity_days", "interest_rate": "interest_rate", "currency": "'USD'",
    }, _first("tx", "source_id, target_id, relationship_type", "seq")),
    _edges({
        "source_id": "'STOCK_' || symbol1", "target_id": "'STOCK_' || symbol2",
        "relationship_type": "'market_correlation'", "network_layer": "'market'", "weight": "abs(correlation)",
        "correlation": "correlation", "window_days": "90",
    }, _first("corr", "symbol1, symbol2", "seq")),
    _edges({
        "source_id": "'INST_' || filer_cik", "target_id": "'STOCK_' || issuer_name",
        "relationship_type": "'equity_ownership'", "network_layer": "'ownership'", "weight": "value",
        "shares_held": "shares",
    }, _first("held", "filer_cik, issuer_name", "seq, value, shares")),
    _edges({c: c for c in ("source_id", "target_id", "relationship_type", "network_layer", "weight",
                           "layer_bridge", "bridge_type", "ticker", "propagation_factor")}, "bridges"),
]) + ")"

GRAPH = ",".join([TRANSACTIONS, CORRELATIONS, HOLDINGS, NODES, MAPPING, BRIDGES, EDGES])


def graph(body: str, *more: str) -> str:
    return "with " + ",".join([GRAPH, *more]) + "\n" + body


def nodes(body: str, *more: str) -> str:
    return "with " + ",".join([NODES, MAPPING, *more]) + "\n" + body


def tx(body: str, *more: str) -> str:
    return "with " + ",".join([TRANSACTIONS, *more]) + "\n" + body


UNIVERSE = """
universe as materialized (select node_id from nodes union select source_id from edges union select target_id from edges)"""

# -- graph measures ---------------------------------------------------------------------

LINKS = """
links as materialized (select source_id as src, target_id as dst, count(*) as m from edges group by all),
outs as (select src, sum(m) as out_edges from links group by src),
shares as materialized (select l.src, l.dst, l.m / o.out_edges as share from links l join outs o on l.src = o.src)"""

PR_ROUNDS = 20


def _pagerank() -> str:
    n = "(select count(*) from universe)"
    parts = [LINKS, f"\nr0 as materialized (select node_id, 1.0 / {n} as rank from universe)"]
    for i in range(PR_ROUNDS):
        parts.append(
            f"\nr{i + 1} as materialized (select u.node_id, (1 - 0.85) / {n} + 0.85 * coalesce(sum(r.rank * s.share), 0) as rank "
            f"from universe u left join shares s on s.dst = u.node_id left join r{i} r on r.node_id = s.src group by u.node_id)")
    parts.append(f"\npagerank as (select node_id, rank as pagerank_score from r{PR_ROUNDS})")
    return ",".join(parts)


DEGREE = """
degree as (select u.node_id, cast(coalesce(i.n, 0) as bigint) as in_degree, cast(coalesce(o.n, 0) as bigint) as out_degree,
  cast(coalesce(i.n, 0) + coalesce(o.n, 0) as bigint) as total_degree from universe u
  left join (select target_id, count(*) n from edges group by 1) i on i.target_id = u.node_id
  left join (select source_id, count(*) n from edges group by 1) o on o.source_id = u.node_id)"""


def _exposure(source: str) -> str:
    return f"""
exposure as (select node_id, cast(i as double) as incoming_exposure, cast(o as double) as outgoing_exposure,
  cast(i - o as double) as net_exposure, cast(i + o as double) as total_exposure from (
  select u.node_id, coalesce(a.s, 0) as i, coalesce(b.s, 0) as o from universe u
  left join (select target_id, sum(cast(cast(weight as varchar) as decimal(28,12))) s from {source} group by 1) a on a.target_id = u.node_id
  left join (select source_id, sum(cast(cast(weight as varchar) as decimal(28,12))) s from {source} group by 1) b on b.source_id = u.node_id))"""


CLUSTERING = """
nb as materialized (select source_id as c, target_id as n from edges union select target_id, source_id from edges),
directed as materialized (select distinct source_id, target_id from edges),
ks as (select c, count(*) as k from nb group by c),
between_n as (select a.c, count(*) as e from nb a join nb b on a.c = b.c and a.n <> b.n
  join directed d on d.source_id = a.n and d.target_id = b.n group by a.c),
clustering as (select u.node_id, case when coalesce(k, 0) < 2 then 0.0 else coalesce(e, 0) / cast(k * (k - 1) as double) end
  as clustering_coefficient from universe u left join ks on ks.c = u.node_id left join between_n b on b.c = u.node_id)"""

# Levels written out; a test checks that no tree is deeper.
BFS_LEVELS = 14


def _bfs(sources: int = 100, seed: int = 0) -> str:
    parts = [
        f"\nsources as materialized (select node_id from universe order by md5('{seed}|' || node_id), node_id limit {sources})",
        "\nhops as materialized (select distinct source_id as src, target_id as dst from edges where source_id <> target_id)",
        "\nt0 as materialized (select node_id as source, node_id, cast(null as varchar) as parent, 0 as depth from sources)",
    ]
    for d in range(BFS_LEVELS):
        parts.append(
            f"\nt{d + 1} as materialized (select * from t{d} union all (select t.source, h.dst, min(h.src), {d + 1} from t{d} t "
            f"join hops h on h.src = t.node_id anti join t{d} seen on seen.source = t.source and seen.node_id = h.dst "
            f"where t.depth = {d} group by t.source, h.dst))")
    parts.append(f"\ntree as materialized (select * from t{BFS_LEVELS})")
    return ",".join(parts)


BETWEENNESS = """
anc as (select source, node_id, parent as a from tree where depth > 1
  union all select x.source, x.node_id, t.parent from anc x join tree t on t.source = x.source and t.node_id = x.a where t.depth > 1),
visits as (select a, count(*) as n from anc where a <> source group by a),
betweenness as (select u.node_id, coalesce(v.n, 0) / cast(((select count(*) from universe) - 1) * ((select count(*) from universe) - 2) as double)
  as betweenness_centrality from universe u left join visits v on v.a = u.node_id)"""


def recursive(body: str, *more: str) -> str:
    return "with recursive " + ",".join([GRAPH, UNIVERSE, *more]) + "\n" + body


FEATURE_PARTS = [_pagerank(), DEGREE, _exposure("edges"), CLUSTERING, _bfs(), BETWEENNESS, """
features as materialized (select n.node_id, n.node_type, coalesce(n.tier, '0') as tier, coalesce(n.total_assets, 0) as total_assets,
  coalesce(n.equity, 0) as equity, pagerank_score, in_degree, out_degree, total_degree, betweenness_centrality,
  clustering_coefficient, incoming_exposure, outgoing_exposure, net_exposure, total_exposure
  from nodes n join pagerank using (node_id) join degree using (node_id) join betweenness using (node_id)
  join clustering using (node_id) join exposure using (node_id))"""]


def features(body: str, *more: str) -> str:
    return recursive(body, *FEATURE_PARTS, *more)


def _scaled(expr: str) -> str:
    return f"case when max({expr}) over () > min({expr}) over () then (({expr}) - min({expr}) over ()) / (max({expr}) over () - min({expr}) over ()) else 0 end"


RISK = f"""
parts as (select node_id, incoming_exposure, {_scaled('total_exposure / (equity + 1)')} as lev, {_scaled('pagerank_score')} as pr,
  {_scaled('betweenness_centrality')} as bt, {_scaled('total_degree')} as dg, {_scaled('clustering_coefficient')} as cl,
  {_scaled('incoming_exposure + outgoing_exposure')} as fl from features),
risk as materialized (select node_id, incoming_exposure, 0.40 * lev + 0.30 * (0.4 * pr + 0.3 * bt + 0.3 * dg) + 0.30 * (0.6 * (1 - cl) + 0.4 * fl) as risk_score from parts),
shock as materialized (select *, case when risk_score >= (select quantile_cont(risk_score, 0.85) from risk) then 1 else 0 end as initial_shock from risk)"""


def _hex(text: str, start: int, length: int) -> str:
    return f"cast(concat('0x', substr(md5({text}), {start}, {length})) as bigint)"


def _draw(tag: str, id_col: str) -> str:
    return f"({_hex(f'''concat('{tag}|', {id_col})''', 1, 8)} / 4294967296.0)"


def _wave(w: int, source: str, exposed: str) -> str:
    return (f"select n.*, case when fell = 0 and {exposed} and {_draw(f'42:wave{w}', 'n.node_id')} "
            f"< risk_score * 0.35 * {w + 1} * 0.5 then 1 else fell end as fell{w} from {source} n")


def _labels(exposed: list[str]) -> str:
    return f"""
w0 as materialized (select * exclude (fell0), fell0 as fell from (select * exclude (fell), fell0 from ({_wave(0, '(select *, initial_shock as fell from shock)', exposed[0])}))),
w1 as materialized (select * exclude (fell1), fell1 as fell from (select * exclude (fell), fell1 from ({_wave(1, 'w0', exposed[1])}))),
safe as materialized (select node_id, row_number() over (order by {_hex("concat('42:random|', node_id)", 1, 14)}, node_id) as place from w1 where fell = 0),
labels as (select w1.node_id, case when s.place <= floor((select count(*) from safe) * 0.10) then 1 else fell end as cascade_occurred
  from w1 left join safe s on s.node_id = w1.node_id)"""


_EXPOSED = ["incoming_exposure > 0"] * 2
_FALLEN = [
    "n.node_id in (select e.target_id from edges e join shock s on s.node_id = e.source_id where s.initial_shock = 1)",
    "n.node_id in (select e.target_id from edges e join w0 s on s.node_id = e.source_id where s.fell = 1)",
]

UNLEARN = f"""
us as materialized (select node_id, {_scaled('pagerank_score')} * 0.3 + {_scaled('total_degree')} * 0.2 + {_scaled('betweenness_centrality')} * 0.3 + {_scaled('total_exposure')} * 0.2 as s from features)"""

# -- hashing, sketches, similarity ------------------------------------------------------


def _base31(col: str) -> str:
    return f"({_hex(col, 1, 8)} % {PRIME})"


def _bits(key: str, source: str, m: int, k: int) -> str:
    hashed = f"select distinct {key} as key, {_hex(key, 1, 14)} as h1, {_hex(key, 15, 14)} as h2 from {source}"
    return "select key, unnest([{}]) as bit from ({})".format(
        ", ".join(f"(h1 + {i} * h2) % {m}" for i in range(k)), hashed)


def _part_bits(source: str, held: str) -> str:
    """``key, part, bit`` in a filter sized by the distinct keys of ``held`` for one error in 128."""
    hashed = f"select distinct {_KEY} as key, {_hex(_KEY, 1, 14)} as h1, {_hex(_KEY, 15, 14)} as h2 from {source}"
    parts = f"(select cast(ceil(ceil(count(distinct {_KEY}) * ln(128) / power(ln(2), 2)) / 32768) as bigint) from {held})"
    return "select key, part, unnest([{}]) as bit from (select *, h1 % parts as part, h1 // parts as start from (select *, {} as parts from ({})))".format(
        ", ".join(f"(start + {i} * (2 * h2 + 1)) % 32768" for i in range(7)), parts, hashed)


_KEY = "source_id || '-' || target_id"


def _zeros(h: str) -> str:
    return f"(case when {h} = 0 then 1 else bit_count(cast((({h}) & (-({h}))) - 1 as bigint)) end)"


def _fm(col: str, source: str, by: str = "") -> str:
    regs = ", ".join(
        f"max({_zeros(f'((b * {a} + {o}) % {PRIME})')}) as r{i}" for i, (a, o) in enumerate(coefficients(10)))
    group = f"group by {by}" if by else ""
    lead = f"{by}, " if by else ""
    names = ", ".join(f"r{i}" for i in range(10))
    return (f"select {lead}concat_ws(',', {names}) as max_trailing_zeros, "
            f"cast(floor(pow(2, list_sort([{names}])[6]) / 0.77351) as bigint) as estimated_cardinality "
            f"from (select {lead}{regs} from (select {lead}{_base31(col)} as b from {source}) {group})")


SETS = """
sets as (select distinct * from (select source_id as node_id, target_id as neighbour from edges
  union all select target_id, source_id from edges))"""

_ROWS = NUM_HASHES // NUM_BANDS
SIGNATURES = SETS + f""",
sigs as materialized (select node_id as entity, {", ".join(f"min((b * {a} + {o}) % {PRIME}) as h{i}" for i, (a, o) in enumerate(coefficients(NUM_HASHES)))}
  from (select node_id, {_base31('neighbour')} as b from sets) group by node_id),
bands as materialized ({" union all ".join(
    f"select entity, {band} as band, concat_ws('_', {', '.join(f'h{band * _ROWS + r}' for r in range(_ROWS))}) as band_key from sigs"
    for band in range(NUM_BANDS))})"""

_ALL = ", ".join(f"h{i}" for i in range(NUM_HASHES))
_SIM = "(" + " + ".join(f"cast(a.h{i} = b.h{i} as integer)" for i in range(NUM_HASHES)) + f") / {float(NUM_HASHES)}"

PAIRS = f"""
reps as materialized (select min(entity) as entity, count(*) as copies, {_ALL} from sigs group by {_ALL}),
cand as (select distinct x.entity as e1, y.entity as e2 from bands x join bands y on x.band = y.band and x.band_key = y.band_key
  and x.entity < y.entity where x.entity in (select entity from reps) and y.entity in (select entity from reps)),
pairs as materialized (select a.entity as entity1, b.entity as entity2, {_SIM} as similarity, a.copies as copies1, b.copies as copies2
  from cand join reps a on a.entity = e1 join reps b on b.entity = e2
  union all select entity, entity, 1.0::double, copies, copies from reps where copies > 1)"""

# Running position and ones of the loan stream, and the sizes after n ones.
_BIT = "cast(weight > 1e9 as bigint)"


def _running(by: str = "") -> str:
    part = f"partition by {by} " if by else ""
    lead = f"{by}, " if by else ""
    return f"""
run as materialized (select {lead}seq, row_number() over ({part}order by seq) as pos, {_BIT} as bit,
  cast(sum({_BIT}) over ({part}order by seq) as bigint) as ones from tx)"""


def _trailing(window: int, by: str = "") -> str:
    part = f"partition by {by} " if by else ""
    lead = f"{by}, " if by else ""
    return (f"select {lead}seq, row_number() over ({part}order by seq) as pos, {_BIT} as bit, cast(sum({_BIT}) over "
            f"({part}order by seq rows between {window - 1} preceding and current row) as bigint) as ones_in_window from tx")




def _dgim(window: int, by: str = "") -> str:
    lead, link = (f"{by}, ", f"and r.{by} = o.{by}") if by else ("", "")
    group, part = (f"group by {by}", f"partition by {by} ") if by else ("", "")
    return f""",
total as (select {lead}max(pos) as now, max(ones) as n from run {group}),
lens as (select {lead}unnest(range(0, cast(floor(log2(n + 1)) as bigint))) as lvl, n, now from total),
sizes as (select {lead}now, n, cast(1 as bigint) << lvl as size, lvl, unnest(range(0, 1 + cast(((n + 1) >> lvl) & 1 as bigint))) as j from lens),
ordered as (select {lead}now, n, size, sum(size) over ({part}order by lvl, j rows between unbounded preceding and current row) - size as newer from sizes),
dgim as (select {"o." + by + ", " if by else ""}o.size as bucket_size, r.pos as bucket_end, o.now as "current_time" from ordered o
  join run r on r.bit = 1 and r.ones = o.n - o.newer {link} where r.pos > o.now - {window})"""


DGIM = _running() + _dgim(1000)
EVENT_DGIM = """
run as materialized (select user_id, event_id, row_number() over w as pos, cast(value > 50 as bigint) as bit,
  cast(sum(cast(value > 50 as bigint)) over w as bigint) as ones from events window w as (partition by user_id order by event_id))""" + _dgim(20, "user_id")

# -- cascades ---------------------------------------------------------------------------

CASCADE = """
listed as (select n.institution_id as bank, e.target_id as stock from nodes n join edges e on e.source_id = n.node_id
  and e.relationship_type = 'PUBLICLY_TRADED_AS' where n.node_type = 'bank'),
own as materialized (select source_id as investor, target_id as stock, weight from edges where relationship_type = 'equity_ownership'),
impact as materialized (
  select bank, 1 as hop, 'stock' as entity_type, n.ticker as entity_id, n.ticker as entity_name, 'Direct Crash' as impact_type,
    n.market_cap as impact_value, n.sector from listed join nodes n on n.node_id = stock
  union all
  select bank, 2, 'investor', o.investor, n.name, 'Portfolio Loss', o.weight, 'Investment' from listed l
    join own o on o.stock = l.stock join nodes n on n.node_id = o.investor
  union all
  select bank, 3, 'stock', n.ticker, n.ticker, 'Forced Selling', cast(sum(cast(o2.weight as decimal(28,2))) as double), n.sector
    from listed l join own o on o.stock = l.stock join own o2 on o2.investor = o.investor and o2.stock <> l.stock
    join nodes n on n.node_id = o2.stock group by bank, n.ticker, n.sector),
summary as (select b.institution_id as bank, any_value(b.name) as bank_name, any_value(b.total_assets) as assets,
  count(distinct l.stock) as direct_stocks, count(distinct o.investor) as affected_investors, count(distinct o2.stock) as cascade_stocks
  from banks b left join listed l on l.bank = b.institution_id left join own o on o.stock = l.stock
  left join own o2 on o2.investor = o.investor and o2.stock <> l.stock group by b.institution_id)"""

_QUASI = "bank, entity_type, sector, impact_type"
_LABEL = "concat('Group[bank=', bank, ', entity_type=', entity_type, ', sector=', sector, ', impact_type=', impact_type, ']')"

# -- audit and series -------------------------------------------------------------------

PRED = """
pred as (select cast(d.doc_id as varchar) as node_id, lang as node_type, source as tier, quality as cascade_prediction,
  n_chars / (n_chars + 1000.0::double) as cascade_probability, toxic as truth from documents d join labels l on d.doc_id = l.doc_id)"""


def _audit(group: str) -> str:
    return (f"select cast({group} as varchar) as group_value, count(*) as count, round(avg(cascade_prediction), 9) as predicted_cascade_rate, "
            f"round(avg(cascade_probability), 9) as avg_probability, count_if(cascade_probability > 0.7) as high_risk_count "
            f"from pred where {group} is not null group by {group}")


def _impact_ratio(group: str) -> str:
    return (f"select group_value, round(rate, 9) as rate, round(rate / top_rate, 9) as ratio, "
            f"coalesce(rate / top_rate between 0.8 and 1.25, false) as is_fair from "
            f"(select *, first_value(rate) over w as top_rate, row_number() over w as rn from "
            f"(select {group} as group_value, avg(cascade_prediction) as rate, count(*) as n from pred group by {group}) "
            f"window w as (order by rate desc, n desc, group_value)) where rn > 1")


METRICS_SQL = """
classes as (select unnest([0, 1]) as cls),
per as (select cls, count_if(truth = cls) as support, count_if(cascade_prediction = cls) as predicted,
  count_if(truth = cls and cascade_prediction = cls) as tp from pred, classes group by cls),
scored as (select cls, support, tp, case when predicted = 0 then 0.0 else tp / predicted end as precision,
  case when support = 0 then 0.0 else tp / support end as recall,
  case when support + predicted = 0 then 0.0 else 2 * tp / (support + predicted) end as f1_score from per)"""

HOURLY = """
hourly as (select strftime(date_trunc('hour', ts), '%Y-%m-%d %H') as date, event_type as series_id,
  cast(sum(cast(value as decimal(18,2))) as double) / count(*) as value from events group by 1, 2),
wide as (select date, """ + ", ".join(f"max(case when series_id = '{s}' then value end) as \"{s}\"" for s in SERIES) + """
  from hourly group by date),
filled as (select date, """ + ", ".join(
    f"last_value(\"{s}\" ignore nulls) over (order by date rows between unbounded preceding and current row) as \"{s}\"" for s in SERIES) + """
  from wide)"""
_SCORE = " + ".join(f"case when \"{c}\" {t} {v} then 2 else 0 end" for c, t, v in RULES)

EVENT_NODES = "select 'USER_' || user_id as node_id, event_id, event_type, value from events"


def _rounded(cols, places):
    return ", ".join(f'round("{c}", {places}) as "{c}"' for c in cols)


_LOANS = "(select * from edges where network_layer = 'banking')"

SQL: dict[str, str] = {
    "unified_nodes": nodes("select * from nodes"),
    "unified_edges": graph("select * from edges"),
    "entity_mapping": nodes("select * from mapping"),
    "bridge_edges": nodes("select * from bridges", BRIDGES),
    "ticker_sets": nodes("""select ticker, case when matched then 'both' when bank_node_id is not null then 'bank_only'
        else 'stock_only' end as side from mapping"""),
    "network_statistics": graph("""select n.network_layer, n.nodes, cast(coalesce(e.edges, 0) as bigint) as edges,
        coalesce(e.edges, 0) / n.nodes as avg_degree,
        case when n.nodes > 1 then coalesce(e.edges, 0) / (cast(n.nodes as double) * (n.nodes - 1)) else 0.0 end as density
        from (select network_layer, count(*) as nodes from nodes group by 1) n
        left join (select network_layer, count(*) as edges from edges group by 1) e using (network_layer)"""),
    "type_counts": graph("""select 'node_type' as item, network_layer, node_type as type, count(*) as n from nodes group by all
        union all select 'relationship_type', network_layer, relationship_type, count(*) from edges group by all"""),
    "bridge_stats": graph("""select count(*) as total_bridge_edges, count_if(relationship_type = 'PUBLICLY_TRADED_AS') as publicly_traded_as,
        count_if(relationship_type = 'REPRESENTS_BANK') as represents_bank,
        (select count_if(matched) from mapping) as connected_entities from edges where network_layer = 'cross_layer_bridge'"""),
    "layer_connectivity": graph("""select count_if(relationship_type = 'PUBLICLY_TRADED_AS') as banking_to_market,
        count_if(relationship_type = 'REPRESENTS_BANK') as market_to_banking,
        count_if(network_layer = 'ownership' and source_id like 'INST\\_%' escape '\\') as market_to_ownership,
        cast(0 as bigint) as banking_to_ownership from edges"""),
    "path_count": graph("""select m as matched, o as ownership_edges, m * o as possible_paths from
        (select (select count_if(matched) from mapping) as m, (select count(*) from edges where network_layer = 'ownership') as o)"""),
    "validation_report": graph("""select 'node_counts' as section, network_layer as item, cast(count(*) as varchar) as value from nodes group by 2
        union all select 'entity_matching', entity_type, cast(count(*) as varchar) from mapping group by 2
        union all select 'entity_matching', 'total', cast(count(*) as varchar) from mapping
        union all select 'matched_entities', ticker, entity_name from mapping where matched
        union all select 'bridge_edges', relationship_type, cast(count(*) as varchar) from bridges group by 2
        union all select 'propagation_paths', 'banking_to_market', cast(count_if(matched) as varchar) from mapping
        union all select 'propagation_paths', 'market_to_ownership', cast(count(*) as varchar) from edges where network_layer = 'ownership'
        union all select 'propagation_paths', 'full_chain', cast((select count_if(matched) from mapping)
            * (select count(*) from edges where network_layer = 'ownership') as varchar)
        union all (select 'example_contagion', unnest(['trigger', 'propagates_to', 'holders_of']), unnest([bank_node_id, stock_node_id, ticker])
            from (select * from mapping where matched order by ticker limit 1))"""),
    "dataset_summary": " union all ".join(
        f"select '{t}' as dataset, (select count(*) from {t}) as rows, "
        f"(select count(*) from (describe {t})) as columns" for t in TABLES),
    "distinct_keys": graph("select distinct network_layer, relationship_type from edges"),
    "import_nodes": nodes('select * exclude (node_id), node_id as "node_id:ID", node_type as ":LABEL" from nodes'),
    "import_edges": graph('select * exclude (source_id, target_id, relationship_type), source_id as ":START_ID", '
                          'target_id as ":END_ID", relationship_type as ":TYPE" from edges'),
    "cik_to_ticker": "with " + HOLDINGS + """ select filer_cik as owner_cik, coalesce('T' || p_partkey, 'UNK_' || issuer_name) as owned_ticker,
        issuer_name as owned_company_name, value as ownership_value, shares as shares_held, filing_date,
        'equity_ownership' as relationship_type, 'ownership' as network_layer
        from held left join part on cast(p_partkey as varchar) = issuer_name and p_size > 25""",
    "sec_union": "with " + HOLDINGS + """
        select cast(p_partkey as varchar) as cik, p_name as title, 'company' as record_type, null as filer_cik, cast(null as date) as filing_date,
          null as issuer_name, cast(null as double) as value, cast(null as bigint) as shares, null as company_cik,
          cast(null as double) as price_per_share, null as owner_cik, null as owned_ticker, cast(null as double) as ownership_value,
          cast(null as bigint) as shares_held from part
        union all select null, null, '13f', filer_cik, filing_date, issuer_name, value, shares, null, null, null, null, null, null from held
        union all select null, null, 'insider', null, null, null, null, null, cast(o_custkey as varchar), o_totalprice, null, null, null, null from orders
        union all select null, null, 'ownership', null, null, null, null, null, null, null, filer_cik, issuer_name, value, shares from held""",
    "sanitize_rel_type": """select o_orderpriority, coalesce(nullif(regexp_replace(upper(trim(o_orderpriority)), '[^A-Z0-9_]', '_', 'g'), ''), 'REL') as rel_type,
        count(*) as n from orders group by 1, 2""",
    "safe_casts": """select o_orderkey, cast(cast(o_orderdate as date) as varchar) as order_date, cast(null as varchar) as bad_date,
        cast(substr(o_orderpriority, 1, 1) as bigint) as priority, cast(substr(o_orderpriority, 1, 1) as bigint) as priority_from_float,
        coalesce(try_cast(o_orderpriority as double), 0.0) as bad_number, cast(try_cast(o_orderpriority as timestamp) as varchar) as bad_ts from orders""",
    "zfill10": """select c_custkey, case when length(cast(c_custkey as varchar)) < 10 then lpad(cast(c_custkey as varchar), 10, '0')
        else cast(c_custkey as varchar) end as padded, c_name as kept from customer""",
    "company_columns": "select lpad(cast(c_custkey as varchar), 10, '0') as cik, c_mktsegment as ticker, c_name as title from customer",
    "sic_financial": "select p_partkey, cast(6000 + p_size * 20 as varchar) as sic_code from part where 6000 + p_size * 20 < 6800",
    "blank_to_null": """select o_orderkey, case when o_orderpriority ~ '^[0-9]-(LOW|HIGH)$' then null else o_orderpriority end as priority,
        cast(1 + cast(not o_orderpriority ~ '^[0-9]-(LOW|HIGH)$' as integer) as integer) as n_properties from orders""",
    "prefixed_keys": "select 'INST_' || c_custkey as node_id, 'FDIC_' || c_nationkey as fdic_id from customer",
    "min_max": """select c_custkey, c_acctbal, 1.0::double as constant, 0.0::double as norm_constant,
        round((c_acctbal - min(c_acctbal) over ()) / (max(c_acctbal) over () - min(c_acctbal) over ()), 10) as norm_c_acctbal from customer""",
    "nan_inf_to_zero": """select l_returnflag, count_if(r = 0) as zeros, max(r) as largest from (select l_returnflag,
        case when l_tax = 0 or l_discount = 0 then 0.0 else l_extendedprice / l_discount end as r from lineitem) group by 1""",
    "fill_zero_all": nodes("select " + ", ".join(
        f"coalesce({c}, {repr('0') if NODE_TYPES[c] == 'string' else 0}) as {c}" for c in NODE_COLS) + " from nodes"),
    "quarter_ends": """with spans as (select o_custkey, cast(min(o_orderdate) as date) as s, cast(max(o_orderdate) as date) as e from orders group by 1),
        ends as (select o_custkey, s, e, cast(unnest(generate_series(cast(date_trunc('quarter', s) as timestamp), cast(e as timestamp), interval 3 month))
            + interval 3 month - interval 1 day as date) as q from spans)
        select o_custkey, cast(q as varchar) as quarter_end from ends where q between s and e""",
    "flatten_records": "select event_id, event_type, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from events",
    "parse_records": """select event_id, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from events
        union all select event_id, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) from events where event_type = 'view'""",
    "high_risk_flag": tx("select seq, weight > 1e9 as is_high_risk from tx"),
    "risk_level": "with " + PRED + """ select node_id, case when cascade_probability > 0.7 then 'High' when cascade_probability > 0.3 then 'Medium'
        when cascade_probability > 0 then 'Low' end as risk_level from pred""",
    "node_universe": graph("select * from universe", UNIVERSE),
    "degree": graph("select * from degree", UNIVERSE, DEGREE),
    "exposure_sum": graph("select * from exposure", UNIVERSE, _exposure("edges")),
    "exposure_last": "with " + ",".join([TRANSACTIONS, NODES, """
        universe as (select node_id from nodes union select source_id from tx union select target_id from tx),
        last_pair as (select source_id, target_id, any_value(lw) * count(*) as weight from (select source_id, target_id,
          last_value(weight) over (partition by source_id, target_id order by seq rows between unbounded preceding and unbounded following) as lw from tx)
          group by 1, 2)""", _exposure("last_pair")]) + " select * from exposure",
    "neighbour_sets": graph("select * from sets", SETS),
    "clustering": graph("select node_id, round(clustering_coefficient, 10) as clustering_coefficient from clustering", UNIVERSE, CLUSTERING),
    "pagerank": graph("select node_id, round(pagerank_score, 12) as pagerank_score from pagerank", UNIVERSE, _pagerank()),
    "bfs_tree": graph("select * from tree", UNIVERSE, _bfs()),
    "betweenness_sampled": recursive("select node_id, round(betweenness_centrality, 12) as betweenness_centrality from betweenness", _bfs(), BETWEENNESS),
    "node_features": features("select * replace (round(pagerank_score, 10) as pagerank_score, round(betweenness_centrality, 10) as betweenness_centrality, "
                              "round(clustering_coefficient, 10) as clustering_coefficient) from features"),
    "risk_score": features("select node_id, round(risk_score, 9) as risk_score from risk", RISK),
    "cascade_shock": features("select node_id, initial_shock from shock", RISK),
    "cascade_labels": features("select * from labels", RISK, _labels(_EXPOSED)),
    "neighbour_contagion": features("select * from labels", RISK, _labels(_FALLEN)),
    "unlearn_score": features("select node_id, round(s, 9) as unlearn_score, cast(s > (select quantile_cont(s, 0.9) from us) as integer) as cascade_occurred from us", UNLEARN),
    "bloom_bits": graph(f"select distinct bit from ({_bits(_KEY, 'edges', 10000, 5)})"),
    "bloom_pack": graph(f"select cast(bit // 32768 + 1 as bigint) as bucket, count(distinct bit) as bits_set from ({_bits(_KEY, 'edges', 200000, 5)}) group by 1"),
    "bloom_contains": graph(f"""select p.key, bool_and(b.bit is not null) as maybe_present from ({_bits(_KEY, 'edges', 200000, 5)}) p
        left join (select distinct bit from ({_bits(_KEY, _LOANS, 200000, 5)})) b on p.bit = b.bit group by p.key"""),
    "bloom_parts": graph(f"select part, count(distinct bit) as bits_set from ({_part_bits('edges', 'edges')}) group by part"),
    "bloom_parts_contains": graph(f"""select p.key, bool_and(b.bit is not null) as maybe_present from ({_part_bits('edges', "edges where network_layer = 'banking'")}) p
        left join (select distinct part, bit from ({_part_bits("edges where network_layer = 'banking'", "edges where network_layer = 'banking'")})) b using (part, bit) group by 1"""),
    "bloom_stats": tx(f"""select cast(10000 as bigint) as size, cast(5 as bigint) as hash_count, n as items_added, b as bits_set,
        round(b / 10000, 9) as fill_rate, round(pow(1 - exp(-5.0 * n / 10000), 5), 9) as estimated_fpr from (select
        (select count(distinct {_KEY}) from tx) as n, (select count(distinct bit) from ({_bits(_KEY, 'tx', 10000, 5)})) as b)"""),
    "bloom_dedupe": tx(f"select seq, row_number() over (partition by {_KEY} order by seq) > 1 as is_duplicate from tx"),
    "trailing_ones": tx(_trailing(1000)),
    "trailing_ones_by_lender": tx(_trailing(20, "source_id")),
    "dgim": tx("select * from dgim", DGIM),
    "dgim_stats": tx("""select cast(1000 as bigint) as window_size, max("current_time") as "current_time", count(*) as num_buckets,
        cast(sum(bucket_size) - floor(max(bucket_size) / 2) as bigint) as estimated_count from dgim""", DGIM),
    "fm_distinct": graph(f"select *, 'source' as side from ({_fm('source_id', 'edges')}) union all "
                         f"select *, 'target' as side from ({_fm('target_id', 'edges')})"),
    "fm_distinct_by_layer": graph(_fm("target_id", "edges", "network_layer")),
    "reservoir": tx("select seq, source_id, target_id, relationship_type, weight from tx order by md5('0|' || seq), seq limit 100"),
    "reservoir_stats": tx("""select cast(100 as bigint) as reservoir_size, count(*) as items_processed,
        cast(least(count(*), 100) as bigint) as current_sample_size, 100.0::double / count(*) as sampling_probability from tx"""),
    "edge_stream_report": tx(f"""select u.keys as items_added, b.bits_set, u.n as "current_time", d.num_buckets, d.estimated_count, s.estimated_cardinality as distinct_sources,
        t.estimated_cardinality as distinct_targets, cast(least(u.n, 100) as bigint) as current_sample_size, u.n as edges_processed, u.n - u.keys as duplicates_detected, u.high as high_risk_edges
        from (select count(*) as n, count(distinct {_KEY}) as keys, count_if(weight > 1e9) as high from tx) u, (select count(distinct bit) as bits_set from ({_bits(_KEY, 'tx', 10000, 5)})) b,
        (select count(*) as num_buckets, cast(coalesce(sum(bucket_size) - floor(max(bucket_size) / 2), 0) as bigint) as estimated_count from dgim) d,
        ({_fm('source_id', 'tx')}) s, ({_fm('target_id', 'tx')}) t""", DGIM),
    "stream_summary": tx(f"select count(*) as edges_processed, count(*) - count(distinct {_KEY}) as duplicates_detected, "
                         "count_if(weight > 1e9) as high_risk_edges from tx"),
    "minhash_signature": graph(f"select entity, concat_ws('_', {_ALL}) as signature from sigs", SIGNATURES),
    "lsh_bands": graph("select * from bands", SIGNATURES),
    "lsh_stats": graph("""select (select count(*) from sigs) as num_entities, cast(20 as bigint) as num_bands, cast(100 as bigint) as num_hashes,
        count(*) as total_buckets, round(avg(n), 9) as avg_bucket_size, max(n) as max_bucket_size
        from (select count(*) as n from bands group by band, band_key)""", SIGNATURES),
    "signature_groups": graph(f"""select entity, min(entity) over w as representative, count(*) over w as copies from sigs
        window w as (partition by {_ALL})""", SIGNATURES),
    "similar_pairs": graph("select * from pairs where similarity >= 0.5", SIGNATURES, PAIRS),
    "lsh_candidates": graph("select entity1, entity2 from pairs", SIGNATURES, PAIRS),
    "similar_to": graph(f"""select a.entity, b.entity as other, {_SIM} as similarity from (select distinct x.entity as e1, y.entity as e2
        from bands x join bands y on x.band = y.band and x.band_key = y.band_key and x.entity <> y.entity
        where x.entity like 'BANK%') c join sigs a on a.entity = e1 join sigs b on b.entity = e2 where {_SIM} >= 0.5""", SIGNATURES),
    "similar_entities": graph("select * from pairs where similarity >= 0.3 order by similarity desc, entity1, entity2 limit 15", SIGNATURES, PAIRS),
    "cascade_impact": graph("select * from impact", CASCADE),
    "cascade_impact_all_hops": graph("""select bank, hop, entity_type, impact_type, count(*) as n from impact
        where bank in (select bank from impact group by bank having count(distinct hop) = 3) group by all""", CASCADE),
    "cascade_summary": graph("""select *, least(10.0, (direct_stocks + affected_investors + cascade_stocks) / 8.0::double) as systemic_score,
        case when affected_investors > 30 then 'CRITICAL' when affected_investors > 15 then 'HIGH' else 'MODERATE' end as assessment from summary""", CASCADE),
    "systemic_ranking": graph(f"""select 'Bank_Group_' || (cast(bank as bigint) // {BANK_STEP} + 1) as bank_group, direct_stocks as direct_impact,
        affected_investors as investors, cascade_stocks as cascade_impact, direct_stocks + affected_investors + cascade_stocks as total_impact from summary""", CASCADE),
    "sector_breakdown": graph("""select bank, n.sector, count(distinct o2.stock) as affected_count from listed l join own o on o.stock = l.stock
        join own o2 on o2.investor = o.investor and o2.stock <> l.stock join nodes n on n.node_id = o2.stock
        group by 1, 2 having count(distinct o2.stock) >= 3""", CASCADE),
    "cascade_subgraph": graph("""select m.bank, e.source_id, e.target_id, e.relationship_type, e.weight from edges e
        join members m on m.id = e.source_id join members o on o.id = e.target_id and o.bank = m.bank""", CASCADE, """
        inv as materialized (select distinct l.bank, o.investor from listed l join own o on o.stock = l.stock),
        members as materialized (select bank, 'BANK_' || bank as id from inv union select bank, stock from listed where bank in (select bank from inv)
          union select bank, investor from inv union select i.bank, o.stock from inv i join own o on o.investor = i.investor)"""),
    "k_anonymize": graph(f"""select bank, hop, entity_type, impact_type, impact_value, sector, n as group_size, {_LABEL} as entity_id_anonymized,
        {_LABEL} as entity_name_anonymized, '***REDACTED***' as entity_id_original, '***REDACTED***' as entity_name_original,
        'k-anonymous' as anonymization_level from (select *, count(*) over (partition by {_QUASI}) as n from impact) where n >= 3""", CASCADE),
    "group_size": "select c_custkey, count(*) over (partition by c_nationkey, c_mktsegment) as group_size from customer",
    "k_anon_summary": graph(f"""select hop, {_QUASI}, count(*) as entity_count, cast(sum(cast(impact_value as decimal(28,2))) as double) as total_impact
        from impact group by hop, {_QUASI} having count(*) >= 3""", CASCADE),
    "anonymization_report": graph(f"""select cast(3 as bigint) as k_value, count_if(n >= 3) as groups_created,
        cast(coalesce(sum(n) filter (n < 3), 0) as bigint) as entities_suppressed, cast(coalesce(sum(n) filter (n >= 3), 0) as bigint) as entities_generalized,
        cast(sum(n) as bigint) as total_entities from (select count(*) as n from impact group by {_QUASI})""", CASCADE),
    "fairness_by_group": "with " + PRED + " " + _audit("node_type"),
    "disparate_impact": "with " + PRED + " " + _impact_ratio("tier"),
    "fairness_report": "with " + PRED + f""" select *, 'audit_by_node_type' as section, cast(null as double) as ratio, cast(null as boolean) as is_fair from ({_audit('node_type')})
        union all select *, 'audit_by_tier', null, null from ({_audit('tier')})
        union all select group_value, null, null, null, null, 'disparate_impact', ratio, is_fair from ({_impact_ratio('node_type')})""",
    "classification_metrics": "with " + PRED + "," + METRICS_SQL + """
        select cast(cls as varchar) as class, round(precision, 9) as precision, round(recall, 9) as recall, round(f1_score, 9) as f1_score, support from scored
        union all select 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1_score), 9), cast(sum(support) as bigint) from scored
        union all select 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
            round(sum(f1_score * support) / sum(support), 9), cast(sum(support) as bigint) from scored
        union all select 'accuracy', round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9),
            cast(sum(support) as bigint) from scored""",
    "class_balance": "with " + PRED + " select truth as label, count(*) as count from pred group by truth",
    "high_risk_entities": "with " + PRED + " select node_id, round(cascade_probability, 9) as cascade_probability from pred where cascade_probability > 0.7",
    "top_predictions": "with " + PRED + """ select node_id, round(cascade_probability, 9) as cascade_probability from pred
        order by pred.cascade_probability desc, node_id limit 5""",
    "pivot_series": "with " + HOURLY + f" select date, {_rounded(SERIES, 9)} from wide",
    "forward_fill": "with " + HOURLY + f" select date, {_rounded(SERIES, 9)} from filled",
    "stress_index": "with " + HOURLY + f""" select date, {_SCORE} as stress_score, case when {_SCORE} >= 4 then 1 else 0 end as high_stress_flag from filled""",
    "sector_correlation": "with " + LINE_ORDER + "," + CORRELATIONS + """
        select sector1, sector2, round(avg(correlation), 9) as correlation, count(distinct a) as num_stocks_sector1, count(distinct b) as num_stocks_sector2
        from (select least(p.p_type, q.p_type) as sector1, greatest(p.p_type, q.p_type) as sector2, correlation,
          case when p.p_type < q.p_type then symbol1 else symbol2 end as a, case when p.p_type < q.p_type then symbol2 else symbol1 end as b
          from corr join part p on cast(p.p_partkey as varchar) = symbol1 join part q on cast(q.p_partkey as varchar) = symbol2
          where p.p_type <> q.p_type) group by 1, 2""",
    "largest": "select c_custkey, c_acctbal from customer order by c_acctbal desc, c_custkey limit 100",
    "quantile": " union all ".join(
        f"select {p}::double as p, round(quantile_cont(l_extendedprice, {p}), 6) as value from lineitem" for p in (0.5, 0.85, 0.9)),
    "values_at_ranks": """select user_id, k, value from (select user_id, value, row_number() over (partition by user_id order by value) - 1 as k,
        count(*) over (partition by user_id) as n from events where value is not null) where k in (0, n // 2, n - 1)""",
    "stratified_split": f"""select c_custkey, c_mktsegment, case when row_number() over (partition by c_mktsegment order by {_hex("'42|' || c_custkey", 1, 14)}, c_custkey)
        <= floor(count(*) over (partition by c_mktsegment) * 0.3 + 0.5) then 'test' else 'train' end as split from customer""",
    "standard_scale": """select p_partkey, round((p_retailprice - avg(p_retailprice) over ()) / stddev_pop(p_retailprice) over (), 7) as z_p_retailprice,
        round((p_size - avg(p_size) over ()) / stddev_pop(p_size) over (), 7) as z_p_size from part""",
    "class_weight": "with " + PRED + """ select truth, round((select count(*) from pred) / ((select count(distinct truth) from pred) * count(*)), 9) as class_weight,
        count(*) as n from pred group by truth""",
    "smote": features("""select cascade_occurred, max(n) over () as n from (
        select cascade_occurred, count(*) - cast(floor(count(*) * 0.3 + 0.5) as bigint) as n from labels group by 1)""", RISK, _labels(_EXPOSED)),
    "nearest_neighbours": """with p as (select distinct cast(p_retailprice as double) as a, cast(p_size as double) as b from part),
        q as (select p.a as price, p.b as size, o.a as near_price, o.b as near_size,
          row_number() over (partition by p.a, p.b order by (p.a - o.a) * (p.a - o.a) + (p.b - o.b) * (p.b - o.b), o.a, o.b) as rank
          from p join p o on p.a <> o.a or p.b <> o.b)
        select * from q where rank <= 5""",
    "forget": nodes("select node_id, node_type from nodes where not (node_type = 'bank' and coalesce(total_assets, 0) < 0)"),
    "verify_forgotten": nodes("select count(*) as requested, count(*) as forgotten from nodes where node_type = 'bank' and total_assets < 0"),
    "unified_stream": """
        select 'market' as layer, 'price_tick' as stream, cast(event_id as varchar) as symbol, cast(null as varchar) as series_id,
          cast(null as varchar) as cert, cast(null as varchar) as filer_cik, value as amount from events where event_type = 'view'
        union all select 'banking', 'rate', null, cast(event_id as varchar), null, null, value from events where event_type = 'click'
        union all select 'fdic', 'Bank ' || event_id, null, null, cast(event_id as varchar), null, value from events where event_type = 'signup'
        union all select 'fred', cast(event_id as varchar), null, cast(event_id as varchar), null, null, value from events where event_type = 'error'
        union all select 'sedc', '13f', null, null, null, cast(event_id as varchar), value from events where event_type = 'purchase'""",
    "replay_stream": "select event_id, user_id, event_type from events",
    "stream_dedupe": "select distinct user_id, event_type from events",
    "stream_bloom_dedupe": "select min(event_id) as event_id, user_id, event_type from events group by 2, 3",
    "stream_distinct": _fm("cast(user_id as varchar)", "events"),
    "stream_dgim": "with " + EVENT_DGIM + """ select user_id, cast(20 as bigint) as window_size, max("current_time") as "current_time", count(*) as num_buckets,
        cast(sum(bucket_size) - floor(max(bucket_size) / 2) as bigint) as estimated_count from dgim group by user_id""",
    "stream_reservoir": "select event_id, user_id from events order by md5('0|' || event_id), event_id limit 100",
    "graph_upsert_nodes": f"""select node_id, max_by(event_type, event_id) as last_type,
        max_by(value, event_id) filter (value > 100) as last_large from ({EVENT_NODES}) group by node_id""",
    "first_rows_of_files": """select cast(o_custkey as varchar) as ticker, cast(min_by(o_orderkey, (o_orderdate, o_orderkey)) as varchar) as name,
        min_by(o_totalprice, (o_orderdate, o_orderkey)) as market_cap from orders group by 1""",
    "last_rows_of_files": f"""select node_id, max_by(event_type, event_id) as node_type,
        max_by(value, event_id) filter (value > 100) as total_assets from ({EVENT_NODES}) group by node_id""",
    "graph_upsert_edges": tx("""select source_id, target_id, upper(relationship_type) as relationship_type, max_by(weight, seq) as weight
        from tx group by 1, 2, 3"""),
    "graph_upsert_files": nodes("select * from nodes"),
    "graph_round_trip": graph("select * from edges"),
    "uniform_draws": f"select c_custkey, round({_draw('7', 'c_custkey')}, 9) as draw from customer",
}
SQL["training_matrix"] = features(
    "select node_id, round(pagerank_score, 10) as pagerank_score, cast(in_degree as double) as in_degree, cast(out_degree as double) as out_degree, "
    "cast(total_degree as double) as total_degree, round(betweenness_centrality, 10) as betweenness_centrality, "
    "round(clustering_coefficient, 10) as clustering_coefficient, incoming_exposure, "
    "outgoing_exposure, total_exposure, total_assets, equity from features")
