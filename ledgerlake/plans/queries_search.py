"""Registered queries of search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import search as SE
from . import adapters as AD
from . import oracle as O
from .registry import register

LIMIT = 50
SECTOR = ("ECONOMY", "LARGE", "PROMO", "STANDARD")

# A batch of user queries: words, partial words, regex text, numbers in
# several forms, too short, mixed.
QUERY_BATCH = [
    (1, "red"), (2, "small ring"), (3, "Hot"), (4, "widg"), (5, "ld an"), (6, "x"), (7, "zz"),
    (8, "000000042"), (9, "0000.000.107"), (10, "00042"), (11, "r.d"), (12, "gear 12345"),
    (13, "  blue  "), (14, "ECONOMY"), (15, "Ge"), (16, "0000 000 1 99"), (17, "Brand#1"), (18, "o"),
    (19, "000000001"), (20, "0000.000.011"), (21, "00 0000 0014"), (22, "BE 0000000003"), (23, "0000-000-022"),
]


def query_batch(spark):
    return spark.createDataFrame(QUERY_BATCH, "query_id int, q string")


_values = ", ".join(f"({i}, '{q}')" for i, q in QUERY_BATCH)
_sector = ", ".join(f"'{c}'" for c in SECTOR)

SEARCH_SQL = f"""
WITH q AS (SELECT * FROM (VALUES {_values}) t(query_id, q)),
comp AS (SELECT {O.number_sql('p_partkey')} AS EnterpriseNumber, p_name, p_type || ' ' || p_brand AS name2
         FROM part WHERE p_type IN ({_sector})),
names AS (SELECT EnterpriseNumber, p_name AS name FROM comp UNION ALL SELECT EnterpriseNumber, name2 FROM comp),
qc AS (SELECT query_id, q, trim(q) AS qt, regexp_replace(trim(q), '[^0-9]', '', 'g') AS digits
       FROM q WHERE length(q) >= 2),
num AS (SELECT query_id,
          CASE WHEN length(digits) IN (9, 10) THEN
                 substr(lpad(digits, 10, '0'), 1, 4) || '.' || substr(lpad(digits, 10, '0'), 5, 3) || '.'
                 || substr(lpad(digits, 10, '0'), 8, 3)
               ELSE digits END AS pat
        FROM qc WHERE length(digits) >= 5),
numhits AS (SELECT DISTINCT query_id, EnterpriseNumber, 'number' AS source
            FROM num JOIN comp ON regexp_matches(EnterpriseNumber, pat)),
qtok AS (SELECT query_id, unnest(string_split_regex(lower(strip_accents(qt)), '[^\\pL\\pN]+')) AS tok
         FROM qc WHERE length(digits) < 5),
ntok AS (SELECT EnterpriseNumber, unnest(string_split_regex(lower(strip_accents(name)), '[^\\pL\\pN]+')) AS tok
         FROM names),
tokhits AS (SELECT DISTINCT query_id, EnterpriseNumber, 'token' AS source FROM qtok JOIN ntok USING (tok)
            WHERE tok <> ''),
rxhits AS (SELECT DISTINCT query_id, EnterpriseNumber, 'regex' AS source
           FROM qc JOIN names ON regexp_matches(name, '(?i)' || qt)
           WHERE length(digits) < 5 AND query_id NOT IN (SELECT query_id FROM tokhits)),
allh AS (SELECT * FROM numhits UNION ALL SELECT * FROM tokhits UNION ALL SELECT * FROM rxhits)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY EnterpriseNumber) AS INTEGER) AS rank,
       EnterpriseNumber, source
FROM allh QUALIFY rank <= {LIMIT}"""


@register("search", SEARCH_SQL)
def q_search(spark, sf_dir):
    res = SE.search(AD.search_companies(spark, sf_dir), query_batch(spark), limit=LIMIT, codes=SECTOR)
    return res.select("query_id", "rank", "EnterpriseNumber", "source")


# One name query and one number query a part row.
PART_QUERIES = """SELECT CAST(p_partkey AS INTEGER) AS query_id, p_name AS q FROM part
           UNION ALL SELECT CAST(p_partkey + 10000000 AS INTEGER), lpad(CAST(p_partkey AS VARCHAR), 9, '0') FROM part"""


@register("search_part_batch", SEARCH_SQL.replace(f"SELECT * FROM (VALUES {_values}) t(query_id, q)", PART_QUERIES))
def q_search_part_batch(spark, sf_dir):
    """Search with a batch that grows with the tables: every part's name and number."""
    p = AD.table(spark, sf_dir, "part")
    batch = p.select(F.col("p_partkey").cast("int").alias("query_id"), F.col("p_name").alias("q")).unionByName(
        p.select((F.col("p_partkey") + 10000000).cast("int").alias("query_id"),
                 F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("q")))
    res = SE.search(AD.search_companies(spark, sf_dir), batch, limit=LIMIT, codes=SECTOR)
    return res.select("query_id", "rank", "EnterpriseNumber", "source")


QUERY_KIND_SQL = f"""
WITH q AS (SELECT * FROM (VALUES {_values}) t(query_id, q)
           UNION ALL SELECT CAST(p_partkey + 1000 AS INTEGER), p_name FROM part
           UNION ALL SELECT CAST(p_partkey + 100000 AS INTEGER), lpad(CAST(p_partkey AS VARCHAR), 9, '0') FROM part)
SELECT query_id, CASE WHEN length(regexp_replace(trim(q), '[^0-9]', '', 'g')) >= 5 THEN 'number' ELSE 'name' END AS kind
FROM q WHERE length(q) >= 2"""


@register("query_kind", QUERY_KIND_SQL)
def q_query_kind(spark, sf_dir):
    """X30 over the fixed batch plus every part name and every part key
    written as a 9-digit number."""
    p = AD.table(spark, sf_dir, "part")
    batch = query_batch(spark).unionByName(
        p.select((F.col("p_partkey") + 1000).cast("int").alias("query_id"), F.col("p_name").alias("q"))).unionByName(
        p.select((F.col("p_partkey") + 100000).cast("int").alias("query_id"),
                 F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("q")))
    return SE.classify(batch).select("query_id", "kind")


@register("any_sector_activity", f"""
SELECT {O.number_sql('p_partkey')} AS EnterpriseNumber FROM part WHERE p_type IN ({_sector})""")
def q_any_sector_activity(spark, sf_dir):
    c = AD.search_companies(spark, sf_dir)
    return c.filter(SE.has_sector(F.col("activities"), SECTOR)).select("EnterpriseNumber")


@register("search_projection", f"""
SELECT {O.number_sql('p_partkey')} AS EnterpriseNumber, p_name AS first_name, CAST(p_size AS VARCHAR) AS first_zip,
       lower(p_type) AS first_label, 2 AS n_names
FROM part""")
def q_search_projection(spark, sf_dir):
    p = SE.search_projection(AD.search_companies(spark, sf_dir))
    return p.select("EnterpriseNumber", F.col("denominations")[0]["Denomination"].alias("first_name"),
                    F.col("addresses")[0]["Zipcode"].alias("first_zip"),
                    F.col("activities")[0]["NaceLabel"].alias("first_label"),
                    F.size("denominations").alias("n_names"))


@register("search_indexed", SEARCH_SQL)
def q_search_indexed(spark, sf_dir):
    """J11-J13 with a persistent token index built from the whole table."""
    from .queries_silver import _scratch
    companies = AD.search_companies(spark, sf_dir)
    path = _scratch(spark)
    SE.build_name_index(companies, path, buckets=16)
    res = SE.search_indexed(companies, path, query_batch(spark), limit=LIMIT, codes=SECTOR)
    return res.select("query_id", "rank", "EnterpriseNumber", "source")


# Every part's name as a phrase, its name without companies of its type, and its type and brand as a
# phrase without companies named with its name's first word; each text once.
TEXT_QUERIES = """SELECT CAST(min(p_partkey) AS INTEGER) AS query_id, '"' || p_name || '"' AS q FROM part GROUP BY p_name
           UNION ALL SELECT CAST(min(p_partkey) + 10000000 AS INTEGER), p_name || ' -' || p_type FROM part GROUP BY p_name, p_type
           UNION ALL SELECT CAST(min(p_partkey) + 20000000 AS INTEGER), '"' || lower(p_type) || ' ' || p_brand || '" -"' || split_part(p_name, ' ', 1) || '"'
                     FROM part GROUP BY p_type, p_brand, split_part(p_name, ' ', 1)"""

_NORM = "' ' || regexp_replace(lower(strip_accents({})), '[^\\pL\\pN]+', ' ', 'g') || ' '"

TEXT_SQL = f"""
WITH q AS ({TEXT_QUERIES}),
comp AS (SELECT {O.number_sql('p_partkey')} AS EnterpriseNumber, p_name, p_type || ' ' || p_brand AS name2
         FROM part WHERE p_type IN ({_sector})),
names AS (SELECT EnterpriseNumber, {_NORM.format('p_name')} AS norm FROM comp
          UNION ALL SELECT EnterpriseNumber, {_NORM.format('name2')} FROM comp),
parts AS (SELECT query_id, unnest(regexp_extract_all(q, '-?"[^"]*"|[^\\s"]+')) AS part FROM q WHERE length(regexp_replace(q, '[^0-9]', '', 'g')) < 5),
runs AS (SELECT DISTINCT query_id, CASE left(part, 1) WHEN '-' THEN 'minus' WHEN '"' THEN 'phrase' ELSE 'plus' END AS kind,
                {_NORM.format('part')} AS run FROM parts),
tidy AS (SELECT query_id, kind, ' ' || trim(run) || ' ' AS run FROM runs),
fits AS (SELECT DISTINCT t.query_id, t.kind, t.run, n.EnterpriseNumber
         FROM (SELECT DISTINCT run FROM tidy) r JOIN names n ON contains(n.norm, r.run) JOIN tidy t ON t.run = r.run),
whole AS (SELECT query_id, EnterpriseNumber FROM fits WHERE kind = 'phrase' GROUP BY query_id, EnterpriseNumber
          HAVING count(*) = (SELECT count(*) FROM tidy t WHERE t.kind = 'phrase' AND t.query_id = fits.query_id)),
loose AS (SELECT DISTINCT query_id, EnterpriseNumber FROM fits
          WHERE kind = 'plus' AND query_id NOT IN (SELECT query_id FROM tidy WHERE kind = 'phrase')),
hits AS (SELECT * FROM (SELECT * FROM whole UNION SELECT * FROM loose)
         WHERE (query_id, EnterpriseNumber) NOT IN (SELECT (query_id, EnterpriseNumber) FROM fits WHERE kind = 'minus'))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY EnterpriseNumber) AS INTEGER) AS rank, EnterpriseNumber
FROM hits QUALIFY rank <= {LIMIT}"""


def text_batch(spark, sf_dir):
    p = AD.table(spark, sf_dir, "part").withColumn("first", F.split("p_name", " ")[0])

    def texts(offset, q, *by):
        return p.groupBy(*by).agg((F.min("p_partkey") + offset).cast("int").alias("query_id")).select("query_id", q.alias("q"))

    return (texts(0, F.concat(F.lit('"'), "p_name", F.lit('"')), "p_name")
            .unionByName(texts(10000000, F.concat("p_name", F.lit(" -"), "p_type"), "p_name", "p_type"))
            .unionByName(texts(20000000, F.concat(F.lit('"'), F.lower("p_type"), F.lit(" "), "p_brand", F.lit('" -"'), "first", F.lit('"')),
                               "p_type", "p_brand", "first")))


@register("search_phrases", TEXT_SQL)
def q_search_phrases(spark, sf_dir):
    """Phrases and excluded words, over the names themselves."""
    res = SE.search(AD.search_companies(spark, sf_dir), text_batch(spark, sf_dir), limit=LIMIT, codes=SECTOR)
    return res.filter(F.col("source") == "token").select("query_id", "rank", "EnterpriseNumber")


@register("search_index_updated", TEXT_SQL)
def q_search_index_updated(spark, sf_dir):
    """J11 by an index built when some companies were absent or had other names, and one was since dissolved:
    two updates (of changed companies only) and a merge between them lead to the answers of today's names."""
    from .queries_silver import _scratch
    now, path = AD.search_companies(spark, sf_dir), _scratch(spark)
    third = F.pmod(F.crc32("EnterpriseNumber"), F.lit(3))
    swapped = now.withColumn("denominations", F.when(third == 1, F.reverse("denominations")).otherwise(F.slice("denominations", 1, 1)))
    gone = now.limit(1).withColumn("EnterpriseNumber", F.lit("9999.999.999"))
    SE.build_name_index(swapped.filter(third > 0).unionByName(gone), path, buckets=16)
    SE.update_name_index(now.filter(third < 2).unionByName(swapped.filter(third == 2)), path)
    SE.merge_name_index(spark, path)
    SE.update_name_index(now, path)
    res = SE.search_indexed(now, path, text_batch(spark, sf_dir), limit=LIMIT, codes=SECTOR)
    return res.filter(F.col("source") == "token").select("query_id", "rank", "EnterpriseNumber")
