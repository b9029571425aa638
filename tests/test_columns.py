from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from riskweave.functions import columns as C
from riskweave.functions.calendar import quarter_ends
from riskweave.functions.hashing import draw


def values(df, col):
    return [r[col] for r in df.collect()]


def test_keys_and_casts(spark):
    df = spark.createDataFrame([("628.0", "12"), (None, "x"), ("bad", "123456789012")], "cert string, cik string")
    assert values(df.select(C.fdic_key("cert").alias("k")), "k") == ["FDIC_628", None, None]
    assert values(df.select(C.zfill10("cik").alias("k")), "k") == ["0000000012", "000000000x", "123456789012"]
    assert values(df.select(C.safe_cast("cert", "double", 0.0).alias("k")), "k") == [628.0, 0.0, 0.0]
    assert values(df.select(C.safe_int("cert").alias("k")), "k") == [628, None, None]


def test_dates_keep_only_iso(spark):
    df = spark.createDataFrame([("2024-02-03",), ("03/02/2024",), ("",)], "d string")
    assert values(df.select(C.safe_date("d").alias("k")), "k") == [dt.date(2024, 2, 3), None, None]
    assert values(df.select(C.safe_ts("d").isNull().alias("k")), "k") == [False, True, True]


def test_relationship_type_cleaning(spark):
    df = spark.createDataFrame([(" credit line ",), ("a-b",), ("",), (None,)], "t string")
    assert values(df.select(C.sanitize_rel_type("t").alias("k")), "k") == ["CREDIT_LINE", "A_B", "REL", "REL"]


def test_aliases_prefer_the_first_existing_column(spark):
    df = spark.createDataFrame([(None, "b")], "source string, `from` string")
    assert df.select(C.resolve_alias(df, [":START_ID", "source", "from"]).alias("k")).first()["k"] is None
    assert df.select(C.resolve_alias(df, ["none"], "unknown").alias("k")).first()["k"] == "unknown"


def test_fuzzy_registry_columns(spark):
    df = spark.createDataFrame([(7, "JPM", "Bank")], "cik_str int, Ticker string, Company_Name string")
    row = C.company_columns(df).first()
    assert (row["cik"], row["ticker"], row["title"]) == ("0000000007", "JPM", "Bank")
    assert C.upper_columns(df).columns == ["CIK_STR", "TICKER", "COMPANY_NAME"]


def test_industry_filter_is_half_open_and_optional(spark):
    df = spark.createDataFrame([("5999",), ("6000",), ("6799",), ("6800",), ("x",)], "SIC string")
    assert values(C.sic_financial(df), "SIC") == ["6000", "6799"]
    other = spark.createDataFrame([("a",)], "name string")
    assert C.sic_financial(other).count() == 1


def test_missing_cells_become_zero(spark):
    df = spark.createDataFrame([(1.0, None, None), (float("nan"), 3, "a"), (float("inf"), 4, "b")], "x double, n long, t string")
    assert values(C.nan_inf_to_zero(df, ["x"]), "x") == [1.0, 0.0, 0.0]
    filled = C.fill_zero_all(df).collect()
    assert filled[0]["n"] == 0 and filled[0]["t"] == "0"


def test_min_max_of_a_constant_is_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "x double, c double")
    out = C.min_max(df, ["x", "c"])
    assert values(out, "norm_x") == [0.0, 1.0, 0.5]
    assert values(out, "norm_c") == [0.0, 0.0, 0.0]


def test_risk_levels_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.31,), (0.7,), (1.0,)], "p double")
    assert values(df.select(C.risk_level("p").alias("k")), "k") == [None, "Low", "Medium", "Medium", "High"]


def test_high_risk_is_strict(spark):
    df = spark.createDataFrame([(1e9,), (1e9 + 1,), (None,)], "w double")
    assert values(df.select(C.high_risk_flag("w").alias("k")), "k") == [False, True, False]


def test_properties_and_redaction(spark):
    df = spark.createDataFrame([("", "x", None)], "a string, b string, c string")
    assert df.select(C.properties_map(df, ["a", "b", "c"]).alias("m")).first()["m"] == {"b": "x"}
    hidden = C.redact(df, ["b"])
    assert "b" not in hidden.columns and hidden.first()["b_original"] == C.REDACTED


def test_defaults(spark):
    df = spark.createDataFrame([(None,)], "currency string")
    row = C.with_defaults(df, {"currency": "USD", "window_days": 90}).first()
    assert (row["currency"], row["window_days"]) == ("USD", 90)


def test_quarter_ends(spark):
    spans = spark.createDataFrame([(dt.date(2020, 1, 15), dt.date(2020, 10, 1))], "start date, end date")
    assert values(quarter_ends(spans), "quarter_end") == [dt.date(2020, 3, 31), dt.date(2020, 6, 30), dt.date(2020, 9, 30)]


def test_draws_are_uniform_and_fixed(spark):
    df = spark.range(20000).select("id", draw(3, F.col("id")).alias("u"), draw(3, F.col("id"), kind="md5").alias("v"))
    mean = df.agg(F.avg("u"), F.avg("v")).first()
    assert all(math.isclose(m, 0.5, abs_tol=0.01) for m in mean)
    assert df.where("u < 0 or u >= 1 or v < 0 or v >= 1").count() == 0
