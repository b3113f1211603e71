"""Adapters: the driver's test tables (TPC-H-like parquet) shaped into the
tables this library works on.  Each adapter is a plain DataFrame plan over the
whole input tables, so its work grows with them.  The same shapes are written
in SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import AMOUNT_CODES, MODEL_CODE_KEY, PERIOD_END_KEY
from ..functions import expr as X


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def key_of(c) -> F.Column:
    """Company key (10 digits) from an integer id."""
    return F.lpad(c.cast("string"), 10, "0")


def number_of(c) -> F.Column:
    """Dotted company number from an integer id (X2 of the padded key)."""
    return X.normalize_company_number(key_of(c))


def model_code_of(priority) -> F.Column:
    return (F.when(priority == "1-URGENT", F.lit("m02-f"))
            .when(priority == "2-HIGH", F.lit("A01"))
            .when(priority == "3-MEDIUM", F.lit("m04-p")))


def period_text_of(orders: DataFrame) -> F.Column:
    """Period end as text; low-priority pending orders carry a malformed date
    ('dd/MM/yyyy'), which drops the filing (F6)."""
    spoiled = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    return F.when(spoiled, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))


def filing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filing lines: company = o_custkey, filing = order, one amount line per
    lineitem.  Columns as ``read_filing_lines``."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount")

    def ids(df):
        key = key_of(F.col("o_custkey"))
        ref = F.col("o_orderkey").cast("string")
        return df.withColumns({"enterprise_key": key, "filing_ref": ref,
                               "file_path": X.filing_path(key, ref)})

    cols = ["enterprise_key", "filing_ref", "file_path", "line_no", "code", "value"]
    o = ids(orders)
    period = o.select("*", F.lit(-2).cast("long").alias("line_no"), F.lit(PERIOD_END_KEY).alias("code"),
                      period_text_of(orders).alias("value")).select(cols)
    model = (o.select("*", F.lit(-1).cast("long").alias("line_no"), F.lit(MODEL_CODE_KEY).alias("code"),
                      model_code_of(F.col("o_orderpriority")).alias("value"))
             .filter(F.col("value").isNotNull()).select(cols))
    codes = F.array(*[F.lit(c) for c in AMOUNT_CODES])
    code_idx = F.lit(1) + F.pmod(F.col("l_linenumber") * 3 + F.pmod(F.col("l_suppkey"), F.lit(3)),
                                 F.lit(len(AMOUNT_CODES)))
    amounts = (ids(lineitem.join(orders.select("o_orderkey", "o_custkey"),
                                 F.col("l_orderkey") == F.col("o_orderkey")))
               .select(
                   "enterprise_key", "filing_ref", "file_path",
                   (F.col("l_partkey") * 1000000 + F.col("l_suppkey") * 10 + F.col("l_linenumber"))
                   .cast("long").alias("line_no"),
                   F.element_at(codes, code_idx.cast("int")).alias("code"),
                   # a zero discount marks a malformed amount text
                   F.when(F.col("l_discount") == 0, F.lit("n/a"))
                   .otherwise(F.col("l_extendedprice").cast("string")).alias("value")))
    return period.unionByName(model).unionByName(amounts)


AS_OF = "2024-06-30 12:00:00"


def as_of() -> F.Column:
    """Fixed run time so results are repeatable."""
    return F.to_timestamp(F.lit(AS_OF))


def download_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """download_state: one row per customer; refs = its orders; status
    'done' when the account balance is not negative, else 'pending'."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    refs = (table(spark, sf_dir, "orders")
            .groupBy("o_custkey")
            .agg(F.array_sort(F.collect_list(F.col("o_orderkey").cast("string"))).alias("filings_done")))
    empty = F.array().cast("array<string>")
    return (cust.join(refs, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select(number_of(F.col("c_custkey")).alias("_id"),
                    F.when(F.col("c_acctbal") >= 0, F.lit("done")).otherwise(F.lit("pending")).alias("status"),
                    F.size(F.coalesce("filings_done", empty)).alias("filings_count"),
                    F.coalesce("filings_done", empty).alias("filings_done"),
                    empty.alias("filings_migrated")))


def gold_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gold_state: customers outside the BUILDING segment were processed
    before; open orders ('O') are the filings not processed yet."""
    cust = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING").select("c_custkey")
    refs = (table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "O")
            .groupBy("o_custkey")
            .agg(F.array_sort(F.collect_list(F.col("o_orderkey").cast("string"))).alias("processed_filings")))
    empty = F.array().cast("array<string>")
    return (cust.join(refs, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select(number_of(F.col("c_custkey")).alias("_id"),
                    F.coalesce("processed_filings", empty).alias("processed_filings"),
                    F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("last_processed")))


NACE_VERSIONS_OF_ORDERS = ("2003", "2008", "2025", "1999")


def _s(c) -> F.Column:
    return c.cast("string")


def register_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Bronze register tables (all strings + ``_seq``) from the test tables.

    * enterprise = customer: Status 'AC' when the balance is not negative,
      else the nation key; kind '2' except the AUTOMOBILE segment; legal form
      = segment, null for HOUSEHOLD; StartDate = first order date dd-MM-yyyy.
    * activity = orders: code = priority, class = status, version by key.
    * address = orders: REGO for finished orders, else BAET.
    * denomination = orders: type 001/002/003 by priority.
    * branch = open orders (ISO dates), establishment = pending orders
      (dd-MM-yyyy), contact = low-priority orders.
    * code = nation (Status), segments (JuridicalForm) and priorities (Nace*).
    """
    cust = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    nation = table(spark, sf_dir, "nation")
    first_order = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_date"))
    enterprise = (cust.join(first_order, F.col("o_custkey") == F.col("c_custkey"), "left")
                  .select(number_of(F.col("c_custkey")).alias("EnterpriseNumber"),
                          F.when(F.col("c_acctbal") >= 0, F.lit("AC"))
                          .otherwise(_s(F.col("c_nationkey"))).alias("Status"),
                          F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("1")).otherwise(F.lit("2"))
                          .alias("TypeOfEnterprise"),
                          F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment"))
                          .alias("JuridicalForm"),
                          F.date_format("first_date", "dd-MM-yyyy").alias("StartDate"),
                          F.col("c_custkey").alias("_seq")))
    o = orders.select("*", number_of(F.col("o_custkey")).alias("_num"), F.col("o_orderkey").alias("_seq"))
    versions = F.array(*[F.lit(v) for v in NACE_VERSIONS_OF_ORDERS])
    activity = o.select(F.col("_num").alias("EntityNumber"),
                        F.element_at(versions, (F.pmod("o_orderkey", F.lit(4)) + 1).cast("int")).alias("NaceVersion"),
                        F.col("o_orderpriority").alias("NaceCode"),
                        F.col("o_orderstatus").alias("Classification"), "_seq")
    address = o.select(F.col("_num").alias("EntityNumber"),
                       F.when(F.col("o_orderstatus") == "F", F.lit("REGO")).otherwise(F.lit("BAET"))
                       .alias("TypeOfAddress"),
                       F.date_format("o_orderdate", "MMdd").alias("Zipcode"),
                       F.when(F.col("o_orderpriority") != "1-URGENT", F.lower(F.substring("o_orderpriority", 3, 20)))
                       .alias("MunicipalityFR"),
                       F.upper(F.col("o_orderpriority")).alias("MunicipalityNL"),
                       F.when(F.col("o_orderpriority") != "2-HIGH", F.concat(F.lit("Rue "), _s(F.col("o_orderkey"))))
                       .alias("StreetFR"),
                       F.concat(F.lit("Straat "), _s(F.col("o_orderkey"))).alias("StreetNL"),
                       _s(F.dayofmonth("o_orderdate")).alias("HouseNumber"), "_seq")
    denomination = o.select(F.col("_num").alias("EntityNumber"),
                            F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("001"))
                            .when(F.col("o_orderpriority") == "2-HIGH", F.lit("002")).otherwise(F.lit("003"))
                            .alias("TypeOfDenomination"),
                            F.concat(F.lit("Name "), _s(F.col("o_orderkey"))).alias("Denomination"), "_seq")
    branch = o.filter(F.col("o_orderstatus") == "O").select(
        F.col("_num").alias("EnterpriseNumber"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("StartDate"),
        "_seq")
    establishment = o.filter(F.col("o_orderstatus") == "P").select(
        F.col("_num").alias("EnterpriseNumber"), F.date_format("o_orderdate", "dd-MM-yyyy").alias("StartDate"),
        "_seq")
    contact = o.filter(F.col("o_orderpriority") == "5-LOW").select(
        F.col("_num").alias("EntityNumber"), F.lit("EMAIL").alias("ContactType"),
        F.concat(F.lit("c"), _s(F.col("o_orderkey")), F.lit("@example.org")).alias("Value"), "_seq")
    # code table: nation names as Status labels (region 4 only in NL), a
    # second, later FR label for region-0 nations (last wins), segments as
    # legal forms (HOUSEHOLD has none), priorities as NACE labels.
    st = nation.select(F.lit("Status").alias("Category"), _s(F.col("n_nationkey")).alias("Code"),
                       F.when(F.col("n_regionkey") == 4, F.lit("NL")).otherwise(F.lit("FR")).alias("Language"),
                       F.col("n_name").alias("Description"), F.col("n_nationkey").cast("long").alias("_seq"))
    st2 = nation.filter(F.col("n_regionkey") == 0).select(
        F.lit("Status").alias("Category"), _s(F.col("n_nationkey")).alias("Code"), F.lit("FR").alias("Language"),
        F.lower("n_name").alias("Description"), (F.col("n_nationkey") + 1000).cast("long").alias("_seq"))
    seg = cust.select("c_mktsegment").distinct().filter(F.col("c_mktsegment") != "HOUSEHOLD").select(
        F.lit("JuridicalForm").alias("Category"), F.col("c_mktsegment").alias("Code"), F.lit("FR").alias("Language"),
        F.lower("c_mktsegment").alias("Description"), F.lit(2000).cast("long").alias("_seq"))
    pri = orders.select("o_orderpriority").distinct()
    n = F.substring("o_orderpriority", 1, 1)
    nace = pri.select(
        F.explode(F.array(
            F.struct(F.lit("Nace2008").alias("Category"), F.when(n.isin("1", "3", "5"), F.lower("o_orderpriority"))
                     .alias("Description")),
            F.struct(F.lit("Nace2003").alias("Category"), F.when(n.isin("1", "2"), F.upper("o_orderpriority"))
                     .alias("Description")),
            F.struct(F.lit("Nace2025").alias("Category"), F.when(n.isin("2", "4"), F.concat(F.lit("n25 "), F.col("o_orderpriority")))
                     .alias("Description")))).alias("e"), "o_orderpriority"
    ).filter(F.col("e.Description").isNotNull()).select(
        F.col("e.Category").alias("Category"), F.col("o_orderpriority").alias("Code"), F.lit("FR").alias("Language"),
        F.col("e.Description").alias("Description"), F.lit(3000).cast("long").alias("_seq"))
    code = st.unionByName(st2).unionByName(seg).unionByName(nace)
    return {"enterprise": enterprise, "activity": activity, "address": address, "branch": branch,
            "contact": contact, "denomination": denomination, "establishment": establishment, "code": code}


def director_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages (company, html): one per customer with orders, whose
    section ``Functies`` names an office holder per order (by order key), between
    other sections."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    row = F.concat(F.lit('<tr><td class="QL">'), F.col("o_orderpriority"), F.lit('</td><td class="RL">  Clerk <i>&amp;</i>\n '),
                   _s(F.col("o_orderkey")), F.lit(" </td><td>"),
                   F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("</td></tr>"))
    rows = (o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("row")))).alias("rows")))
    before = "<html><table><tr><td><h2>Algemeen</h2></td></tr><tr><td class='QL'>Status</td><td>Actief</td></tr><tr><td><h2>Functies</h2></td></tr>"
    after = "<tr><td>no class</td><td>skipped</td></tr><tr><td><h2>Vaardigheden</h2></td></tr><tr><td class='QL'>X</td><td>not read</td></tr></table></html>"
    return rows.select(number_of(F.col("o_custkey")).alias("company"), F.concat(
        F.lit(before), F.array_join(F.transform("rows", lambda r: r["row"]), ""), F.lit(after)).alias("html"))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified companies (enterprise + nested activities) for target tests."""
    from ..operators.silver import nest_children
    t = register_tables(spark, sf_dir)
    return nest_children(t["enterprise"], {"activities": (t["activity"], "EntityNumber")})


def deposits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deposit listing rows from orders: one deposit per order.  Urgent
    pending orders have an empty period end; finished orders are migrated;
    pending ones carry no migration flag."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        number_of(F.col("o_custkey")).alias("company"),
        F.col("o_orderkey").cast("string").alias("reference"),
        F.year("o_orderdate").alias("periodEndDateYear"),
        F.concat(F.lit("d"), F.col("o_orderkey").cast("string")).alias("id"),
        F.when(F.col("o_orderstatus") == "F", F.lit(True)).when(F.col("o_orderstatus") == "O", F.lit(False))
        .alias("migration"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P"), F.lit(""))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("periodEndDate"),
        F.date_format(F.date_add("o_orderdate", F.pmod(F.col("o_orderkey"), F.lit(90)).cast("int")), "yyyy-MM-dd")
        .alias("depositDate"))


def deposit_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State for deposit tests: open urgent/high orders are done already,
    finished low-priority ones are migrated already."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    o = table(spark, sf_dir, "orders")
    ref = F.col("o_orderkey").cast("string")
    lists = o.groupBy("o_custkey").agg(
        F.array_sort(F.collect_list(F.when((F.col("o_orderstatus") == "O")
                                           & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), ref)))
        .alias("filings_done"),
        F.array_sort(F.collect_list(F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW"),
                                           ref))).alias("filings_migrated"))
    empty = F.array().cast("array<string>")
    return (cust.join(lists, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select(number_of(F.col("c_custkey")).alias("_id"),
                    F.when(F.col("c_acctbal") >= 0, F.lit("done")).otherwise(F.lit("pending")).alias("status"),
                    F.size(F.coalesce("filings_done", empty)).alias("filings_count"),
                    F.coalesce("filings_done", empty).alias("filings_done"),
                    F.coalesce("filings_migrated", empty).alias("filings_migrated")))


def search_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies for search tests from ``part``: official name = p_name,
    second name = type and brand, one MAIN activity coded by the type."""
    p = table(spark, sf_dir, "part")
    return p.select(
        number_of(F.col("p_partkey")).alias("EnterpriseNumber"),
        F.lit("Actif").alias("StatusLabel"), F.lower("p_type").alias("JuridicalFormLabel"),
        F.array(F.struct(F.lit("1").alias("TypeOfDenomination"), F.col("p_name").alias("Denomination")),
                F.struct(F.lit("2").alias("TypeOfDenomination"),
                         F.concat_ws(" ", "p_type", "p_brand").alias("Denomination"))).alias("denominations"),
        F.array(F.struct(F.col("p_size").cast("string").alias("Zipcode"),
                         F.col("p_brand").alias("MunicipalityFR"))).alias("addresses"),
        F.array(F.struct(F.col("p_type").alias("NaceCode"), F.lit("MAIN").alias("Classification"),
                         F.lower("p_type").alias("NaceLabel"))).alias("activities"))


def progress_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress events from ``events``: view -> downloading, purchase ->
    downloaded, error -> download_failed, click -> statutes_count, signup ->
    done (error when value > 40).  document = user id, run = day,
    seq = event id; props.k (JSON) names the deed."""
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    kind = (F.when(t == "view", F.lit("downloading")).when(t == "purchase", F.lit("downloaded"))
            .when(t == "error", F.lit("download_failed")).when(t == "click", F.lit("statutes_count"))
            .when((t == "signup") & (F.col("value") > 40), F.lit("error")).when(t == "signup", F.lit("done")))
    k = F.from_json("props", "k int")["k"]
    doc_kinds = t.isin("view", "purchase", "error")
    uid = F.col("user_id").cast("string")
    return e.select(
        kind.alias("event"),
        F.when(doc_kinds, uid).alias("documentId"),
        F.when(doc_kinds, F.date_format("ts", "yyyy-MM-dd")).alias("deedDate"),
        F.when(t == "view", F.concat(F.lit("deed k"), k.cast("string"))).alias("description"),
        F.when(t == "purchase", F.concat(uid, F.lit("_"), F.date_format("ts", "yyyyMMdd"), F.lit("_"),
                                         F.col("event_id").cast("string"), F.lit(".pdf"))).alias("filename"),
        F.when(t == "purchase", F.round(F.col("value") * 1000).cast("long")).alias("sizeBytes"),
        F.when(t == "click", F.col("user_id")).alias("count"),
        F.when(kind == "done", F.floor("value").cast("long")).alias("total"),
        F.when(kind == "done", k.cast("long")).alias("downloaded"),
        F.when(kind == "error", F.concat(F.lit("failed "), uid)).alias("message"),
        F.lit(None).cast("string").alias("enterprise"),
        F.date_format("ts", "yyyy-MM-dd").alias("run"),
        F.col("event_id").alias("seq"))


def deeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deed listing rows from orders (low-priority deeds carry no date)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        key_of(F.col("o_custkey")).alias("company_key"),
        F.concat(F.lit("doc"), F.col("o_orderkey").cast("string")).alias("documentId"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("deedDate"),
        F.col("o_orderpriority").alias("deedNatureDecoded"),
        F.when(F.col("o_orderstatus").isin("F", "O"), F.lit("DONE")).otherwise(F.lit("PENDING")).alias("documentStatus"),
        F.col("o_orderstatus").alias("_status"), F.col("o_totalprice").alias("_price"))


def deed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files on disk: finished orders' deeds (filename, size)."""
    from ..functions.expr import deed_filename
    d = deeds(spark, sf_dir).filter(F.col("_status") == "F")
    return d.select(deed_filename(F.col("company_key"), F.col("deedDate"), F.col("documentId")).alias("filename"),
                    F.floor("_price").cast("long").alias("size"))


def deed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deed state: done for non-negative balances; acts done = deeds of
    urgent finished orders."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    o = table(spark, sf_dir, "orders")
    acts = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"),
               F.concat(F.lit("doc"), F.col("o_orderkey").cast("string"))))).alias("acts_done"))
    empty = F.array().cast("array<string>")
    return (cust.join(acts, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select(number_of(F.col("c_custkey")).alias("_id"),
                    F.when(F.col("c_acctbal") >= 0, F.lit("done")).otherwise(F.lit("pending")).alias("status"),
                    F.size(F.coalesce("acts_done", empty)).alias("acts_count"),
                    F.coalesce("acts_done", empty).alias("acts_done")))
