"""Silver: clean the flat register tables, then nest the children under each
company once (A5, A6, F7, F9, J1-J3, O3, X3).

Cleaning runs on the flat child tables before nesting, which gives the same
documents as nest-then-clean with less data in the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (NACE_DEFAULT_VERSION, NACE_FALLBACK_ORDER, NACE_VERSIONS, OFFICIAL_NAME_TYPE,
                         REGISTERED_ADDRESS_TYPE)
from ..functions import expr as X


def text_key(c) -> Column:
    """Python ``str(x).strip()`` of a nullable string: null -> 'None'."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(X.py_strip(c), F.lit("None"))


# ------------------------------------------------------------------ codes

def code_dictionary(codes: DataFrame, language: str = "FR", order: str = "_seq") -> DataFrame:
    """F9 + A6: (category, code, label) for one language.  Rows with an
    empty category are dropped; the code is the trimmed text; the last row
    (by ``order``) of a (category, code) wins."""
    c = codes.filter((F.col("Language") == language)
                     & F.col("Category").isNotNull() & (F.col("Category") != ""))
    c = c.select(F.col("Category").alias("category"), text_key("Code").alias("code"),
                 F.col("Description").alias("label"), F.col(order).alias("_o"))
    c = c.filter(F.col("code") != "")
    return c.groupBy("category", "code").agg(F.max_by("label", "_o").alias("label"))


def _as_dictionary(codes: DataFrame) -> DataFrame:
    """A raw code table (Category, Code, Language, Description) or an
    already built dictionary (category, code, label)."""
    return code_dictionary(codes) if "Category" in codes.columns else codes


def with_code_labels(df: DataFrame, dictionary: DataFrame, fields: dict) -> DataFrame:
    """For each ``field -> (category, label_col)`` (or ``field ->
    label_col``, category = field name) add the label of the trimmed code;
    unmatched -> ''; blank code -> null (no label).  A null code reads as
    'None' (then usually unmatched -> '').  ``dictionary``: a code table
    or the output of ``code_dictionary``."""
    dictionary = _as_dictionary(dictionary)
    out = df
    for field, spec in fields.items():
        category, label_col = (field, spec) if isinstance(spec, str) else spec
        d = (dictionary.filter(F.col("category") == category)
             .select(F.col("code").alias("_lc"), F.col("label").alias("_ll")))
        out = (out.withColumn("_lk", text_key(field))
               .join(d, F.col("_lk") == F.col("_lc"), "left")
               .withColumn(label_col, F.when(F.col("_lk") != "", F.coalesce("_ll", F.lit(""))))
               .drop("_lk", "_lc", "_ll"))
    return out


def nace_label_table(dictionary: DataFrame, versions=NACE_VERSIONS) -> DataFrame:
    """One row per NACE code with a label column per version (nace_<v>)."""
    d = dictionary.filter(F.col("category").isin([f"Nace{v}" for v in versions]))
    return d.groupBy("code").agg(*[
        F.max(F.when(F.col("category") == f"Nace{v}", F.col("label"))).alias(f"nace_{v}") for v in versions])


def with_activity_labels(activities: DataFrame, dictionary: DataFrame, default: str = NACE_DEFAULT_VERSION,
                         order=NACE_FALLBACK_ORDER, versions=NACE_VERSIONS) -> DataFrame:
    """NaceLabel from the version's category (unknown version ->
    default); missing or empty -> try ``order``; else ''.  ``dictionary``:
    a code table or the output of ``code_dictionary``."""
    labels = nace_label_table(_as_dictionary(dictionary), versions)
    version = F.coalesce(F.col("NaceVersion").cast("string"), F.lit("None"))
    primary = F.lit(None).cast("string")
    for v in versions:
        primary = F.when(version == v, F.col(f"nace_{v}")).otherwise(primary)
    primary = F.when(version.isin(list(versions)), primary).otherwise(F.col(f"nace_{default}"))
    label = F.coalesce(X.blank_to_null(primary), *[X.blank_to_null(F.col(f"nace_{v}")) for v in order],
                       F.lit(""))
    return (activities.withColumn("_nk", text_key("NaceCode"))
            .join(labels.withColumnRenamed("code", "_nk"), "_nk", "left")
            .withColumn("NaceLabel", label)
            .drop("_nk", *[f"nace_{v}" for v in versions]))


# ------------------------------------------------------------------ children

def first_per_key(df: DataFrame, keys: list, order: list) -> DataFrame:
    """First row per key by ``order`` (row_number = 1)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_activities(activities: DataFrame, key: str = "EntityNumber", order: str = "_seq") -> DataFrame:
    """A5: the first activity per (company, trimmed NaceCode, trimmed
    Classification); the NACE version is ignored."""
    return first_per_key(activities.withColumns({"_nc": text_key("NaceCode"), "_cl": text_key("Classification")}),
                         [key, "_nc", "_cl"], [F.col(order)]).drop("_nc", "_cl")


def registered_address(addresses: DataFrame) -> DataFrame:
    """addresses whose trimmed type is REGO."""
    return addresses.filter(text_key("TypeOfAddress") == REGISTERED_ADDRESS_TYPE)


def number_code(c) -> Column:
    """A code that the register numbers: trimmed text, of all-digit codes
    without leading zeros (``001`` is type ``1``)."""
    return F.regexp_replace(text_key(c), "^0+(?=[0-9]+$)", "")


def official_name_flag(denominations: DataFrame) -> DataFrame:
    """O3 (flat): ``_name_rank`` 0 for the official name type, else 1."""
    return denominations.withColumn(
        "_name_rank", F.when(number_code("TypeOfDenomination") == OFFICIAL_NAME_TYPE, 0).otherwise(1))


def official_name_first(names: Column) -> Column:
    """O3 on an array of denomination structs that carry ``_seq``: official
    names first, otherwise input order (stable)."""
    def rank(x):
        return F.when(number_code(x["TypeOfDenomination"]) == OFFICIAL_NAME_TYPE, 0).otherwise(1)
    keyed = F.transform(names, lambda x: F.struct(rank(x).alias("r"), x["_seq"].alias("s"), x.alias("v")))
    return F.transform(F.array_sort(keyed), lambda k: k["v"])


def flip_start_dates(df: DataFrame, col: str = "StartDate") -> DataFrame:
    """X3 applied to a flat table (company, branch or establishment)."""
    return df.withColumn(col, X.flip_date(F.col(col)))


def nest_children(parent: DataFrame, children: dict[str, tuple[DataFrame, str]],
                  key: str = "EnterpriseNumber", order: str = "_seq",
                  sort_fields: dict[str, list[str]] | None = None) -> DataFrame:
    """J1 + A2: each child table becomes an array column of structs on its
    parent, in ``order`` (or by ``sort_fields[name]`` then ``order``).
    A parent without children gets an empty array, never null.  Parent
    duplicates are kept; child rows with a null key fall away; each child
    keeps its own key column.

    Every child is reduced by its key first and joined on the same key, so
    the joins reuse the aggregation's hash partitioning (one exchange per
    input).  A parent's children become one array, so a parent's rows meet in
    one task; AQE cannot split them there."""
    out = parent
    sort_fields = sort_fields or {}
    for name, (child, child_key) in children.items():
        fields = [c for c in child.columns]
        front = [F.col(f) for f in sort_fields.get(name, [])] + [F.col(order)]
        elem = F.struct(*[c.alias(f"_s{i}") for i, c in enumerate(front)],
                        F.struct(*[F.col(f) for f in fields]).alias("v"))
        grouped = (child.filter(F.col(child_key).isNotNull())
                   .groupBy(F.col(child_key).alias("_k"))
                   .agg(F.array_sort(F.collect_list(elem)).alias("_arr"))
                   .select("_k", F.transform("_arr", lambda e: e["v"]).alias(name)))
        empty = F.array().cast(grouped.schema[name].dataType)
        out = (out.join(grouped, F.col(key) == F.col("_k"), "left")
               .withColumn(name, F.coalesce(F.col(name), empty)).drop("_k"))
    return out
