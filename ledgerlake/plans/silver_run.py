"""Bronze register tables -> silver companies (one row per company with six
cleaned child arrays and code labels)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import HOTEL_NACE_CODES, MAIN_CLASSIFICATION
from ..operators import silver as S
from ..sources import sinks

CHILD_KEYS = {
    "activities": ("activity", "EntityNumber"),
    "addresses": ("address", "EntityNumber"),
    "branches": ("branch", "EnterpriseNumber"),
    "contacts": ("contact", "EntityNumber"),
    "denominations": ("denomination", "EntityNumber"),
    "establishments": ("establishment", "EnterpriseNumber"),
}

LABEL_FIELDS = {"JuridicalForm": ("JuridicalForm", "JuridicalFormLabel"),
                "Status": ("Status", "StatusLabel")}


def build_silver(tables: dict[str, DataFrame], sector_codes=HOTEL_NACE_CODES) -> DataFrame:
    """Silver companies from bronze tables (keys as in CHILD_KEYS).

    Adds flat helper columns ``main_sector_codes`` (NACE codes of MAIN
    activities) so that target filters can be pushed to a Parquet scan
    instead of evaluating ``exists()`` over the nested array."""
    codes = tables["code"]
    dictionary = S.code_dictionary(codes)
    ent = S.with_code_labels(S.flip_start_dates(tables["enterprise"]), dictionary, LABEL_FIELDS)

    flat = {}
    for name, (tname, key) in CHILD_KEYS.items():
        flat[name] = (tables[tname], key)
    # clustered by company once: the dedup window (company, code, class) and
    # the nesting aggregate (company) both reuse this partitioning
    act_in = flat["activities"][0].filter(F.col("EntityNumber").isNotNull()).repartition("EntityNumber")
    act = S.with_activity_labels(S.dedup_activities(act_in), dictionary)
    flat["activities"] = (act, "EntityNumber")
    flat["addresses"] = (S.registered_address(flat["addresses"][0]), "EntityNumber")
    flat["branches"] = (S.flip_start_dates(flat["branches"][0]), "EnterpriseNumber")
    flat["establishments"] = (S.flip_start_dates(flat["establishments"][0]), "EnterpriseNumber")
    flat["denominations"] = (S.official_name_flag(flat["denominations"][0]), "EntityNumber")
    silver = S.nest_children(ent, flat, key="EnterpriseNumber",
                             sort_fields={"denominations": ["_name_rank"]})
    silver = silver.withColumn("denominations",
                               F.transform("denominations", lambda d: d.dropFields("_name_rank")))
    main_codes = F.transform(
        F.filter("activities", lambda a: a["Classification"] == MAIN_CLASSIFICATION),
        lambda a: a["NaceCode"])
    return silver.withColumn("main_sector_codes", F.array_distinct(main_codes))


def write_silver(tables: dict[str, DataFrame], silver_table: str) -> str:
    """Full rewrite of the silver table as a new snapshot."""
    return sinks.write_replace(build_silver(tables), silver_table)
