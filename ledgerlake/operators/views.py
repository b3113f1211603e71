"""Views over silver and gold: company profile (J7), P&L flow edges (G1)
and node totals (A8), ratio series (X29), display texts (X24-X28) and
non-finite cleaning (X21)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (ACTIVE_LABEL, DEFAULT_ADDRESS, DEFAULT_FORM, DEFAULT_NAME, NOT_AVAILABLE,
                         UNKNOWN_STATUS)
from ..functions import expr as X


# ------------------------------------------------------------------ profile

def company_profile(silver: DataFrame, gold: DataFrame, numbers: DataFrame | None = None,
                    number_col: str = "q") -> DataFrame:
    """Silver companies with ``gold_data`` (last_updated, years) from the
    gold row keyed by the dotted number, else by the digits-only number;
    null when neither exists.  With ``numbers`` (a table of requested
    numbers in any form), only those companies are returned (X2 applied).

    Gold rows are gathered by the digits-only key first (a key has one row a
    written form), so companies join once and nested documents are never
    sorted or windowed."""
    s = silver
    g = gold.select(F.col("enterprise_number").alias("_gnum"),
                    F.translate("enterprise_number", ".", "").alias("_gk"),
                    F.struct("last_updated", "years").alias("gold_data"))
    if numbers is not None:
        # a lookup batch: both sides are cut to the requested companies
        # before the join (semi-joins with the small request table)
        wanted = numbers.select(X.normalize_company_number(F.col(number_col)).alias("EnterpriseNumber")).distinct()
        s = s.join(wanted, "EnterpriseNumber", "left_semi")
        g = g.join(wanted.select(F.translate("EnterpriseNumber", ".", "").alias("_gk")), "_gk", "left_semi")
    forms = g.groupBy("_gk").agg(F.collect_list(F.struct("_gnum", "gold_data")).alias("_forms"))
    j = s.withColumn("_k", F.translate("EnterpriseNumber", ".", "")).join(forms, F.col("_k") == F.col("_gk"), "left")

    def written(number: str) -> Column:
        own = F.filter("_forms", lambda f: f["_gnum"] == F.col(number))
        return F.try_element_at(own, F.lit(1))["gold_data"]

    return j.withColumn("gold_data", F.coalesce(written("EnterpriseNumber"), written("_k"))).drop("_k", "_gk", "_forms")


# ------------------------------------------------------------------ flows

def year_rows(gold: DataFrame) -> DataFrame:
    """Gold years flattened: enterprise_number, year, filing_ref and amounts."""
    return (gold.select("enterprise_number", F.explode("years").alias("y"))
            .select("enterprise_number", "y.*"))


def first_filing_per_year(years: DataFrame) -> DataFrame:
    """One row per (company, year): the smallest filing_ref (the screen
    shows the first filing of a year)."""
    w = Window.partitionBy("enterprise_number", "year").orderBy("filing_ref")
    return years.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _num0(c: Column) -> Column:
    """JS ``x || 0`` for a double: null and NaN -> 0."""
    return F.when(c.isNull() | F.isnan(c), F.lit(0.0)).otherwise(c)


def _with_edges(years: DataFrame) -> DataFrame:
    """G1 on one row per (company, year): ``_ca`` and ``_edges``, the array of
    edges source -> target with value > 0.  Nodes: 0 revenue, 1 gross margin, 2 cost of sales, 3 EBIT,
    4 operating charges, 5 net profit, 6 financial charges and taxes,
    7 net loss.  Flows need not balance."""
    ca = F.greatest(F.lit(0.0), _num0(F.col("ca")))
    mb = F.greatest(F.lit(0.0), _num0(F.col("marge_brute")))
    ebit = _num0(F.col("ebit"))
    rn = _num0(F.col("resultat_net"))
    base = years.select("enterprise_number", "year", ca.alias("_ca"), mb.alias("_mb"), ebit.alias("_ebit"),
                        rn.alias("_rn"))
    cost = F.greatest(F.lit(0.0), F.col("_ca") - F.col("_mb"))
    ebit_pos = F.greatest(F.lit(0.0), F.col("_ebit"))
    base = base.select("*", cost.alias("_cost"), ebit_pos.alias("_ep"))
    opex = F.greatest(F.lit(0.0), F.col("_mb") - F.col("_ep"))
    net_pos = F.greatest(F.lit(0.0), F.col("_rn"))
    loss = F.when(F.col("_rn") < 0, -F.col("_rn")).otherwise(F.lit(0.0))
    base = base.select("*", opex.alias("_opex"), net_pos.alias("_np"), loss.alias("_loss"))
    tax = F.greatest(F.lit(0.0), F.col("_ep") - F.col("_np") - F.col("_loss"))

    def e(s, t, v):
        return F.struct(F.lit(s).alias("source"), F.lit(t).alias("target"), v.alias("value"))

    edges = F.array(
        e(0, 1, F.col("_mb")), e(0, 2, F.col("_cost")), e(1, 3, F.col("_ep")), e(1, 4, F.col("_opex")),
        e(3, 5, F.col("_np")), e(3, 6, tax),
        F.struct(F.when(F.col("_ep") > 0, F.lit(3)).otherwise(F.lit(1)).alias("source"), F.lit(7).alias("target"),
                 F.col("_loss").alias("value")))
    return base.select("enterprise_number", "year", "_ca", F.filter(edges, lambda x: x["value"] > 0).alias("_edges"))


def flow_edges(years: DataFrame) -> DataFrame:
    """G1 on one row per (company, year): one row per edge."""
    return (_with_edges(years).select("enterprise_number", "year", F.explode("_edges").alias("e"))
            .select("enterprise_number", "year", "e.source", "e.target", "e.value"))


def _years_of(df: DataFrame) -> DataFrame:
    """Gold rows (with ``years``) flattened, or flat facts as they are."""
    return year_rows(df) if "years" in df.columns else df


def pnl_flows(gold: DataFrame) -> DataFrame:
    """G1 for all companies and years at once, from gold rows or from flat
    facts (with ``enterprise_number``)."""
    return flow_edges(first_filing_per_year(_years_of(gold)))


def flow_node_totals(years: DataFrame) -> DataFrame:
    """Total per node: node 0 = revenue (max(0, ca)); other nodes = sum
    of incoming edges, or, when that is 0, the sum of outgoing edges.
    ``years``: one row per (company, year) with the amounts.  One row per node
    0..7 of every (company, year), all from that row's edge array: no join,
    no aggregation."""
    def through(end: str, node: Column) -> Column:
        return F.aggregate(F.filter("_edges", lambda e: e[end] == node), F.lit(0.0), lambda s, e: s + e["value"])

    node = F.col("node")
    incoming = through("target", node)
    total = F.when(node == 0, F.col("_ca")).when(incoming != 0, incoming).otherwise(through("source", node))
    return (_with_edges(years).withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(7))))
            .select("enterprise_number", "year", "node", total.alias("total")))


# ------------------------------------------------------------------ series

RATIO_SERIES = ("roe", "marge_brute", "marge_nette", "endettement", "liquidite")


def ratio_series(gold: DataFrame) -> DataFrame:
    """Per company and year entry (ascending), the five ratios rounded
    to 2 decimals; null, NaN and 0 give 0."""
    if "years" not in gold.columns:   # flat facts: ratios are top-level columns
        cols = [F.round(_num0(F.col(r)), 2).alias(r) for r in RATIO_SERIES]
        return gold.select("enterprise_number", "year", "filing_ref", *cols)
    y = gold.select("enterprise_number", F.explode("years").alias("y"))
    cols = [F.round(_num0(F.col(f"y.ratios.{r}")), 2).alias(r) for r in RATIO_SERIES]
    return y.select("enterprise_number", F.col("y.year").alias("year"), F.col("y.filing_ref").alias("filing_ref"),
                    *cols)


# ------------------------------------------------------------------ display

def display_name(denominations: Column) -> Column:
    """First name; the default only when there is no name at all."""
    return F.when(F.coalesce(F.size(denominations), F.lit(0)) > 0,
                  X.first_element(denominations)["Denomination"]).otherwise(F.lit(DEFAULT_NAME))


def display_address(addresses: Column) -> Column:
    """X25: 'street number, zip town' of the first address, trimmed; '' is
    missing; default text when there is no address."""
    a = X.first_element(addresses)
    b = X.blank_to_null
    street = F.coalesce(b(a["StreetFR"]), b(a["StreetNL"]), F.lit(""))
    num = F.coalesce(b(a["HouseNumber"]), F.lit(""))
    zipc = F.coalesce(b(a["Zipcode"]), F.lit(""))
    city = F.coalesce(b(a["MunicipalityFR"]), b(a["MunicipalityNL"]), F.lit(""))
    text = X.py_strip(F.concat(street, F.lit(" "), num, F.lit(", "), zipc, F.lit(" "), city))
    return F.when(F.coalesce(F.size(addresses), F.lit(0)) > 0, text).otherwise(F.lit(DEFAULT_ADDRESS))


def display_defaults(df: DataFrame) -> DataFrame:
    """Active flag, status text (profile and list), form and date."""
    b = X.blank_to_null
    return df.withColumns({
        "is_active": F.coalesce(F.col("StatusLabel") == ACTIVE_LABEL, F.lit(False)),
        "status_text": F.coalesce(b(F.col("StatusLabel")), F.lit(ACTIVE_LABEL)),
        "status_list_text": F.coalesce(b(F.col("StatusLabel")), F.lit(UNKNOWN_STATUS)),
        "form_text": F.coalesce(b(F.col("JuridicalFormLabel")), F.lit(DEFAULT_FORM)),
        "start_text": F.coalesce(b(F.col("StartDate")), F.lit(NOT_AVAILABLE)),
    })


def ratio_texts(years: DataFrame) -> DataFrame:
    """Ratio cells of the yearly table (descending years)."""
    return years.select(
        "enterprise_number", "year", "filing_ref",
        *[X.ratio_text(F.col(f"ratios.{r}")).alias(f"{r}_text") for r in ("roe", "marge_brute", "marge_nette",
                                                                            "endettement")],
        X.liquidity_text(F.col("ratios.liquidite")).alias("liquidite_text"))


def amount_texts(years: DataFrame) -> DataFrame:
    """Amount cells (null -> N/C, 0 shown)."""
    amounts = ("ca", "marge_brute", "ebit", "resultat_net", "tresorerie", "dettes_financieres", "fonds_propres",
               "capital_souscrit")
    return years.select("enterprise_number", "year", "filing_ref",
                        *[X.amount_text(F.col(a)).alias(f"{a}_text") for a in amounts])


# ------------------------------------------------------------------ cleaning

def _clean(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)
    if isinstance(dtype, T.StructType):
        if not any(_has_float(f.dataType) for f in dtype.fields):
            return c
        return F.when(c.isNotNull(), F.struct(*[_clean(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]))
    if isinstance(dtype, T.ArrayType) and _has_float(dtype.elementType):
        return F.transform(c, lambda x: _clean(x, dtype.elementType))
    if isinstance(dtype, T.MapType) and _has_float(dtype.valueType):
        return F.transform_values(c, lambda k, v: _clean(v, dtype.valueType))
    return c


def _has_float(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return True
    if isinstance(dtype, T.StructType):
        return any(_has_float(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_float(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _has_float(dtype.valueType)
    return False


def null_nonfinite(df: DataFrame) -> DataFrame:
    """NaN, +Inf and -Inf become null at any depth (top level, structs,
    arrays, map values)."""
    return df.select(*[_clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
