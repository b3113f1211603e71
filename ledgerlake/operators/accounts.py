"""Filing lines -> one typed row per filing -> amounts and ratios
(A1, X20, F6, X5-X19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import AMOUNT_CODES, MODEL_CODE_KEY, PERIOD_END_KEY, PIVOT_KEYS
from ..functions import expr as X

FILING_KEYS = ("enterprise_key", "filing_ref", "file_path")


def amount_column(code: str) -> str:
    """Column name of an amount code: '70/76A' -> 'val_70_76A'."""
    return "val_" + code.replace("/", "_")


AMOUNT_COLUMNS = tuple(amount_column(c) for c in AMOUNT_CODES)


def _first_by_line(code: str, value, lines_order: str = "line_no"):
    """Value of the first line (by line number) that carries ``code`` and a
    non-null text.  Rows of other codes have a null ordering and are skipped
    by min_by."""
    hit = (F.col("code") == code) & F.col("value").isNotNull()
    return F.min_by(value, F.when(hit, F.col(lines_order)))


def pivot_accounts(lines: DataFrame, group_keys=FILING_KEYS) -> DataFrame:
    """A1 + X20: one row per filing with typed columns.

    * period_end_date: DateType (null when the first date text is malformed)
    * layout: int code of the accounts model (X5), null when absent
    * val_<code>: double per amount code (null when absent or malformed)

    Written as one groupBy().agg() of min_by over fixed-width values instead
    of ``.pivot()``, so the plan is a single HashAggregate with map-side
    partial aggregation and one exchange.  Lines of other codes are dropped
    before the shuffle (the filter reaches the scan).
    """
    keep = lines.filter(F.col("code").isin(list(PIVOT_KEYS)))
    aggs = [
        _first_by_line(PERIOD_END_KEY, X.period_end(F.col("value"))).alias("period_end_date"),
        _first_by_line(MODEL_CODE_KEY, X.layout_code(F.col("value"))).alias("layout"),
    ]
    aggs += [_first_by_line(code, F.col("value").try_cast("double")).alias(amount_column(code))
             for code in AMOUNT_CODES]
    return keep.groupBy(*group_keys).agg(*aggs)


def valid_period(df: DataFrame, col: str = "period_end_date") -> DataFrame:
    """F6 + X32: keep rows whose period end parses, with its ``year``.
    Accepts a DateType column or yyyy-MM-dd text."""
    c = F.col(col)
    dtype = dict(df.dtypes)[col]
    year = F.year(c) if dtype == "date" else X.period_year(c)
    return df.withColumn("year", year).filter(F.col("year").isNotNull())


FACT_COLUMNS = ("ca", "achats", "variation_stocks", "ebit", "resultat_net", "tresorerie",
                "dettes_financieres", "fonds_propres", "capital_souscrit", "marge_brute",
                "marge_nette", "roe", "liquidite", "endettement")


def financial_facts(wide: DataFrame) -> DataFrame:
    """X5-X19 after F6: amounts and ratios per filing (flat fact table).

    Output: enterprise_key, filing_ref, period_end_date, year, schema_type,
    then FACT_COLUMNS.  Computed in two projections that Catalyst collapses
    into the aggregate's output stage.
    """
    v = {c: F.col(amount_column(c)) for c in AMOUNT_CODES}
    dated = valid_period(wide)
    base = dated.select(
        "enterprise_key", "filing_ref", "period_end_date", "year",
        X.layout_name(F.coalesce("layout", F.lit(X.LAYOUT_FULL))).alias("schema_type"),
        X.revenue(v["70"], v["70/76A"], v["70/74"]).alias("ca"),
        X.purchases(v["60"], v["60/61"], v["60/64"], v["60/66A"]).alias("achats"),
        X.stock_change(v["71"]).alias("variation_stocks"),
        X.ebit(v["9901"]).alias("ebit"),
        X.net_result(v["9904"]).alias("resultat_net"),
        X.cash(v["54"], v["55"], v["54/58"]).alias("tresorerie"),
        X.financial_debt(v["17"], v["43"], v["17/49"]).alias("dettes_financieres"),
        X.equity(v["10/15"]).alias("fonds_propres"),
        X.subscribed_capital(v["100"], v["1011"]).alias("capital_souscrit"),
    )
    return base.select(
        "*",
        X.gross_margin("ca", "achats", "variation_stocks").alias("marge_brute"),
        X.net_margin("resultat_net", "ca").alias("marge_nette"),
        X.roe("resultat_net", "fonds_propres").alias("roe"),
        X.liquidity("tresorerie", "dettes_financieres").alias("liquidite"),
        X.debt_ratio("dettes_financieres", "fonds_propres").alias("endettement"),
    )


def facts_from_lines(lines: DataFrame) -> DataFrame:
    """Filing lines straight to the flat fact table."""
    return financial_facts(pivot_accounts(lines))
