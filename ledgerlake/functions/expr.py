"""Column expressions (Column -> Column).  All are built-in Spark SQL
functions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import NOT_AVAILABLE

# Python's str.split()/str.strip() whitespace, written as one regex class that
# Java regex and RE2 read the same way.
PY_WHITESPACE = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                 r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

_ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- identifiers

def company_key(c) -> Column:
    """Company number without dots and spaces, trimmed."""
    return py_strip(F.translate(_c(c), ". ", ""))


def normalize_company_number(c) -> Column:
    """Digits only; 9 digits get a leading 0; 10 digits become
    dddd.ddd.ddd; anything else is returned unchanged."""
    c = _c(c)
    digits = F.regexp_replace(c, r"[^0-9]", "")
    d10 = F.when(F.length(digits) == 9, F.concat(F.lit("0"), digits)).otherwise(digits)
    dotted = F.concat_ws(".", F.substring(d10, 1, 4), F.substring(d10, 5, 3), F.substring(d10, 8, 3))
    return F.when(F.length(d10) == 10, dotted).otherwise(c)


def digit_count(c) -> Column:
    return F.length(F.regexp_replace(_c(c), r"[^0-9]", ""))


def query_kind(q) -> Column:
    """A query with at least five digits is a number query."""
    return F.when(digit_count(q) >= 5, F.lit("number")).otherwise(F.lit("name"))


def py_strip(c) -> Column:
    """Python-style strip(): remove leading and trailing whitespace."""
    return F.regexp_replace(_c(c), rf"^{PY_WHITESPACE}+|{PY_WHITESPACE}+$", "")


def clean_code(c) -> Column:
    """Code as trimmed string."""
    return py_strip(_c(c).cast("string"))


def collapse_spaces(c) -> Column:
    """Runs of whitespace become one space; leading/trailing removed."""
    return py_strip(F.regexp_replace(_c(c), rf"{PY_WHITESPACE}+", " "))


def ascii_lower(c) -> Column:
    """Lower-case ASCII letters only (what a case-insensitive Java regex
    without the UNICODE_CASE flag folds)."""
    return F.translate(_c(c), _ASCII_UPPER, _ASCII_LOWER)


# ---------------------------------------------------------------- dates

def flip_date(c) -> Column:
    """X3: 'a-b-c' -> 'c-b-a' when there are exactly three parts.
    Not idempotent: apply once, from bronze to silver."""
    c = _c(c)
    parts = F.split(c, "-", -1)
    flipped = F.concat_ws("-", parts[2], parts[1], parts[0])
    return F.when(c.isNotNull() & (F.size(parts) == 3), flipped).otherwise(c)


def period_end(c) -> Column:
    """Period end date text as DateType; null when it does not parse."""
    return F.try_to_date(_c(c), "yyyy-MM-dd")


def period_year(c) -> Column:
    """Year of a yyyy-MM-dd text, null when unparseable."""
    return F.year(period_end(c))


# ---------------------------------------------------------------- filings

# The layout of the landed filing tree: /{company}/hbb/{ref}.csv
FILING_FOLDER, FILING_SUFFIX = "/hbb/", ".csv"


def csv_ref(ref) -> Column:
    """File name of a filing."""
    return F.concat(_c(ref), F.lit(FILING_SUFFIX))


def filing_path(key, ref) -> Column:
    """/{key}/hbb/{ref}.csv"""
    return F.concat(F.lit("/"), _c(key), F.lit(FILING_FOLDER), csv_ref(ref))


# Layout of the accounts model: small int codes so the pivot aggregate keeps
# fixed-width buffers (HashAggregate), names on output.
LAYOUT_FULL, LAYOUT_ABREGE, LAYOUT_MICRO = 0, 1, 2
LAYOUT_NAMES = {LAYOUT_FULL: "full", LAYOUT_ABREGE: "abrege", LAYOUT_MICRO: "micro"}


def layout_code(model_code) -> Column:
    """X5 as an int: 'f' anywhere -> full; else 'a'/'v' -> abrege; else 'm'
    -> micro; else (null too) full.  Case-insensitive; order matters."""
    m = _c(model_code)
    return (F.when(m.rlike("(?i)f"), F.lit(LAYOUT_FULL))
            .when(m.rlike("(?i)[av]"), F.lit(LAYOUT_ABREGE))
            .when(m.rlike("(?i)m"), F.lit(LAYOUT_MICRO))
            .otherwise(F.lit(LAYOUT_FULL)))


def layout_name(code) -> Column:
    code = _c(code)
    return (F.when(code == LAYOUT_ABREGE, F.lit("abrege"))
            .when(code == LAYOUT_MICRO, F.lit("micro"))
            .otherwise(F.lit("full")))


def layout_type(model_code) -> Column:
    """Layout name from the model code."""
    return layout_name(layout_code(model_code))


def to_amount(c) -> Column:
    """Amount text to double, malformed -> null."""
    return F.expr(f"try_cast({c} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")


# ---------------------------------------------------------------- ratios

def _first(*cols) -> Column:
    return F.coalesce(*[_c(x) for x in cols], F.lit(0.0))


def revenue(v70, v70_76a, v70_74) -> Column:
    """X6 (ca)."""
    return _first(v70, v70_76a, v70_74)


def purchases(v60, v60_61, v60_64, v60_66a) -> Column:
    """X7 (achats)."""
    return _first(v60, v60_61, v60_64, v60_66a)


def stock_change(v71) -> Column:
    """X8 (variation_stocks)."""
    return _first(v71)


def ebit(v9901) -> Column:
    """X9."""
    return _first(v9901)


def net_result(v9904) -> Column:
    """X10 (resultat_net)."""
    return _first(v9904)


def cash(v54, v55, v54_58) -> Column:
    """X11 (tresorerie): 54+55 when both, else 54, else 55, else 54/58."""
    return _first(_c(v54) + _c(v55), v54, v55, v54_58)


def financial_debt(v17, v43, v17_49) -> Column:
    """X12 (dettes_financieres): 17+43, else 17, else 43, else 17/49."""
    return _first(_c(v17) + _c(v43), v17, v43, v17_49)


def equity(v10_15) -> Column:
    """X13 (fonds_propres)."""
    return _first(v10_15)


def subscribed_capital(v100, v1011) -> Column:
    """X14 (capital_souscrit)."""
    return _first(v100, v1011)


def gross_margin(ca, achats, variation) -> Column:
    """X15 (marge_brute): an amount, not a percentage."""
    return _c(ca) - _c(achats) + _c(variation)


def _ratio(num, den, scale: float | None) -> Column:
    q = _c(num) / _c(den)
    if scale is not None:
        q = q * F.lit(scale)
    return F.when(_c(den) != 0.0, q)


def net_margin(net, ca) -> Column:
    """Net / revenue * 100, null when revenue is 0."""
    return _ratio(net, ca, 100.0)


def roe(net, eq) -> Column:
    """Net / equity * 100, null when equity is 0."""
    return _ratio(net, eq, 100.0)


def liquidity(cash_, debt) -> Column:
    """Cash / debt (no * 100), null when debt is 0."""
    return _ratio(cash_, debt, None)


def debt_ratio(debt, eq) -> Column:
    """Debt / equity * 100, null when equity is 0."""
    return _ratio(debt, eq, 100.0)


# ---------------------------------------------------------------- deeds

def deed_filename(key, deed_date, doc_id) -> Column:
    """{key}_{date without dashes, or 'unknown'}_{docId}.pdf"""
    date_part = F.coalesce(F.replace(_c(deed_date), F.lit("-"), F.lit("")), F.lit("unknown"))
    return F.concat(_c(key), F.lit("_"), date_part, F.lit("_"), _c(doc_id), F.lit(".pdf"))


def parse_deed_filename(name) -> Column:
    """struct(company_key, deed_date, doc_id); parts missing -> 'unknown'."""
    parts = F.split(F.replace(_c(name), F.lit(".pdf"), F.lit("")), "_", -1)
    return F.struct(
        parts[0].alias("company_key"),
        F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("unknown")).alias("deed_date"),
        F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit("unknown")).alias("doc_id"),
    )


# ---------------------------------------------------------------- arrays

def first_element(a) -> Column:
    """First element of an array, null when empty or null."""
    return F.try_element_at(_c(a), F.lit(1))


def refs_difference(a, b) -> Column:
    """Refs of a that are not in b (b null counts as empty)."""
    return F.array_except(_c(a), F.coalesce(_c(b), F.array().cast("array<string>")))


def append_refs(old, new) -> Column:
    """Old refs extended with new ones, each ref once, order kept."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(_c(old), empty), F.coalesce(_c(new), empty)))


def not_in_nullsafe(c, values) -> Column:
    """document-store style 'not in' that keeps null values."""
    c = _c(c)
    return c.isNull() | ~c.isin(list(values))


def has_sector(activities, codes, classification: str | None = None) -> Column:
    """F10 (any activity with a sector code) or, with ``classification``, the
    element match of F1 (both tests on the same element)."""
    codes = list(codes)

    def test(a):
        t = a["NaceCode"].isin(codes)
        if classification is not None:
            t = t & (a["Classification"] == classification)
        return t

    return F.exists(_c(activities), test)


# ---------------------------------------------------------------- display

def blank_to_null(c) -> Column:
    c = _c(c)
    return F.when(c != "", c)


def ratio_text(x, decimals: int = 1) -> Column:
    """Fixed decimals (no grouping) + ' %'; null, NaN or 0 -> N/C."""
    x = _c(x)
    ok = x.isNotNull() & ~F.isnan(x) & (x != 0)
    return F.when(ok, F.format_string(f"%.{decimals}f %%", x)).otherwise(F.lit(NOT_AVAILABLE))


def liquidity_text(x) -> Column:
    """X27 for liquidity: two decimals, no unit."""
    x = _c(x)
    ok = x.isNotNull() & ~F.isnan(x) & (x != 0)
    return F.when(ok, F.format_string("%.2f", x)).otherwise(F.lit(NOT_AVAILABLE))


def amount_text(x) -> Column:
    """Grouped number with up to 3 decimals + ' €'; null -> N/C."""
    x = _c(x)
    txt = F.regexp_replace(F.format_number(x, 3), r"(\.[0-9]*[1-9])0+$|\.0+$", "$1")
    return F.when(x.isNotNull(), F.concat(txt, F.lit(" €"))).otherwise(F.lit(NOT_AVAILABLE))
