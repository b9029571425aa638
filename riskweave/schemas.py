"""Explicit schemas of every dataset, stream and unified table."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
}


def schema(text: str) -> T.StructType:
    """Flat schema from ``name type, ...``; needs no running session."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


DATASETS: dict[str, T.StructType] = {name: schema(text) for name, text in {
    "institution_profiles": (
        "institution_id string, institution_name string, tier string, total_assets double, "
        "total_deposits double, total_loans double, equity double, num_branches bigint, "
        "num_employees bigint, layer string"),
    "interbank_lending": (
        "transaction_id string, transaction_date date, from_institution string, "
        "to_institution string, relationship_type string, amount_usd double, currency string, "
        "maturity_days int, interest_rate double, risk_weight double, collateral_type string, "
        "layer string"),
    "banking_indicators": (
        "date date, indicator_name string, series_id string, value double, layer string"),
    "stress_events": (
        "event_id string, event_date date, affected_institution string, event_type string, "
        "severity_score double, financial_impact_usd double, resolved boolean, "
        "resolution_days int, contagion_risk double, layer string"),
    "daily_positions": (
        "date date, institution_id string, total_assets double, cash_equivalents double, "
        "securities double, loans double, other_assets double, total_liabilities double, "
        "deposits double, borrowings double, equity double, layer string"),
    "fdic_active_banks": (
        "NAME string, CERT bigint, ASSET double, DEP double, DEPDOM double, ROA double, "
        "ROE double, NETINC double, CITY string, STNAME string, STALP string, ZIP string, "
        "DATEUPDT string, OFFICES bigint, COLLECTION_DATE timestamp"),
    "bank_financials": (
        "CERT bigint, REPDTE string, ASSET double, LIAB double, DEP double, DEPDOM double, "
        "EQTOT double, NETINC double, ROA double, ROE double, LNRE double, LNCI double"),
    "fdic_failed_banks": (
        "NAME string, CERT bigint, FAILDATE string, QBFDEP double, COST double, CITY string, "
        "STNAME string, RESTYPE1 string"),
    "fdic_lending": (
        "lender_cert bigint, lender_name string, borrower_cert bigint, borrower_name string, "
        "lending_amount double, relationship_type string, start_date timestamp, "
        "is_synthetic boolean"),
    "company_fundamentals": (
        "symbol string, company_name string, sector string, industry string, "
        "market_cap double, enterprise_value double, trailing_pe double, forward_pe double, "
        "peg_ratio double, price_to_book double, debt_to_equity double, "
        "return_on_equity double, return_on_assets double, profit_margin double, "
        "operating_margin double, revenue double, earnings double, employees bigint, "
        "beta double, dividend_yield double, layer string"),
    "sector_correlations": (
        "sector1 string, sector2 string, correlation double, num_stocks_sector1 int, "
        "num_stocks_sector2 int, relationship_type string, layer string"),
    "market_correlations": (
        "symbol1 string, symbol2 string, correlation double, window_days int"),
    "company_cik": "cik string, ticker string, title string",
    "13f_holdings": (
        "filer_cik string, filing_date date, issuer_name string, cusip string, value double, "
        "shares bigint, relationship_type string, is_synthetic boolean"),
    "insider_transactions": (
        "company_cik string, filing_date date, accession_number string, "
        "transaction_type string, shares bigint, price_per_share double, "
        "relationship_type string, filing_type string, is_synthetic boolean"),
    "ownership_network": (
        "owner_cik string, owned_ticker string, owned_company_name string, "
        "ownership_value double, shares_held bigint, filing_date timestamp, "
        "relationship_type string, network_layer string, is_synthetic boolean"),
    "economic_indicators": "date date, value double, series_id string, description string",
}.items()}

# Where each dataset lives below the data root; ``*`` marks timestamped snapshots.
DATASET_PATHS: dict[str, str] = {
    "banking_indicators": "banking_upscaled/banking_indicators_timeseries_*.csv",
    "interbank_lending": "banking_upscaled/interbank_lending_network_*.csv",
    "institution_profiles": "banking_upscaled/institution_profiles_*.csv",
    "stress_events": "banking_upscaled/stress_events_*.csv",
    "daily_positions": "banking_upscaled/daily_positions_*.csv",
    "market_correlations": "market_upscaled/market_correlations_*.csv",
    "company_fundamentals": "market_upscaled/company_fundamentals_*.csv",
    "sector_correlations": "market_upscaled/sector_correlations_*.csv",
    "fdic_active_banks": "banking/active_banks.csv",
    "fdic_failed_banks": "banking/failed_banks.csv",
    "bank_financials": "banking/bank_financials_timeseries.csv",
    "company_cik": "ownership/company_cik_mapping.csv",
    "13f_holdings": "ownership/13f_institutional_holdings.csv",
    "insider_transactions": "ownership/insider_transactions.csv",
    "ownership_network": "ownership/corporate_ownership_network.csv",
    "economic_indicators": "**/fred_economic_*.csv",
}

NODES = schema(
    "node_id string, node_type string, network_layer string, name string, "
    "institution_id string, tier string, total_assets double, total_deposits double, "
    "total_loans double, equity double, num_branches bigint, num_employees bigint, "
    "cert bigint, assets double, city string, state string, ticker string, sector string, "
    "industry string, market_cap double, trailing_pe double, debt_to_equity double, "
    "beta double, cik string")

EDGES = schema(
    "source_id string, target_id string, relationship_type string, network_layer string, "
    "weight double, transaction_date date, maturity_days bigint, interest_rate double, "
    "currency string, correlation double, window_days bigint, shares_held bigint, "
    "layer_bridge boolean, bridge_type string, ticker string, propagation_factor double")

# Record streams: the column that names the record kind, and the columns of each layer.
STREAM_KIND = {
    "market": "type",
    "banking": "indicator_name",
    "fdic": "name",
    "fred": "series_id",
    "sedc": "record_type",
}

STREAMS: dict[str, T.StructType] = {name: schema(text) for name, text in {
    "market": "symbol string, timestamp string, price double, type string",
    "banking": "date string, indicator_name string, series_id string, value double",
    "fdic": "cert string, name string, city string, state string, asset double, liability double",
    "fred": "date string, series_id string, value double, description string",
    "sedc": (
        "record_type string, filer_cik string, issuer_name string, owned_ticker string, "
        "value double, shares double, filing_date string"),
}.items()}

# The market feed may nest the quote and name its kind differently.
MARKET_WIRE = T.StructType([
    *schema("symbol string, timestamp string, price double, type string, stream_type string"),
    T.StructField("payload", schema("symbol string, price double")),
])
