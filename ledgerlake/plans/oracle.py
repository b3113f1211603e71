"""SQL text (DuckDB dialect) of the adapters and of reference results, used
as the independent oracle for the Spark queries.  Views ``orders``,
``lineitem``, ``customer`` ... are registered by the checker."""

from __future__ import annotations

from ..constants import AMOUNT_CODES, MODEL_CODE_KEY, PERIOD_END_KEY

_codes_list = "[" + ", ".join(f"'{c}'" for c in AMOUNT_CODES) + "]"


def amount_column(code: str) -> str:
    return "val_" + code.replace("/", "_")


def key_sql(col: str) -> str:
    return f"lpad(CAST({col} AS VARCHAR), 10, '0')"


def number_sql(col: str) -> str:
    k = key_sql(col)
    return f"(substr({k}, 1, 4) || '.' || substr({k}, 5, 3) || '.' || substr({k}, 8, 3))"


FILING_LINES_CTE = f"""
o_ AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_orderstatus,
         {key_sql('o_custkey')} AS enterprise_key, CAST(o_orderkey AS VARCHAR) AS filing_ref
  FROM orders),
lines AS (
  SELECT enterprise_key, filing_ref, '/' || enterprise_key || '/hbb/' || filing_ref || '.csv' AS file_path,
         CAST(-2 AS BIGINT) AS line_no, '{PERIOD_END_KEY}' AS code,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN strftime(o_orderdate, '%d/%m/%Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS value
  FROM o_
  UNION ALL
  SELECT enterprise_key, filing_ref, '/' || enterprise_key || '/hbb/' || filing_ref || '.csv',
         CAST(-1 AS BIGINT), '{MODEL_CODE_KEY}',
         CASE o_orderpriority WHEN '1-URGENT' THEN 'm02-f' WHEN '2-HIGH' THEN 'A01' WHEN '3-MEDIUM' THEN 'm04-p' END
  FROM o_ WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  UNION ALL
  SELECT o_.enterprise_key, o_.filing_ref, '/' || o_.enterprise_key || '/hbb/' || o_.filing_ref || '.csv',
         CAST(l_partkey * 1000000 + l_suppkey * 10 + l_linenumber AS BIGINT),
         ({_codes_list})[1 + ((l_linenumber * 3 + l_suppkey % 3) % {len(AMOUNT_CODES)})],
         CASE WHEN l_discount = 0 THEN 'n/a' ELSE CAST(l_extendedprice AS VARCHAR) END
  FROM lineitem JOIN o_ ON l_orderkey = o_orderkey)"""


def _first(code: str) -> str:
    return f"arg_min(value, line_no) FILTER (WHERE code = '{code}' AND value IS NOT NULL)"


_amounts = ",\n    ".join(f"TRY_CAST({_first(c)} AS DOUBLE) AS {amount_column(c)}" for c in AMOUNT_CODES)

WIDE_CTE = f"""
wide AS (
  SELECT enterprise_key, filing_ref, file_path,
    TRY_STRPTIME({_first(PERIOD_END_KEY)}, '%Y-%m-%d') AS period_end_ts,
    {_first(MODEL_CODE_KEY)} AS model_code,
    {_amounts}
  FROM lines GROUP BY enterprise_key, filing_ref, file_path)"""


def _v(c: str) -> str:
    return amount_column(c)


FACTS_CTE = f"""
base AS (
  SELECT enterprise_key, filing_ref, CAST(period_end_ts AS DATE) AS period_end_date,
    CAST(year(period_end_ts) AS INTEGER) AS year,
    CASE WHEN regexp_matches(model_code, '(?i)f') THEN 'full'
         WHEN regexp_matches(model_code, '(?i)[av]') THEN 'abrege'
         WHEN regexp_matches(model_code, '(?i)m') THEN 'micro' ELSE 'full' END AS schema_type,
    coalesce({_v('70')}, {_v('70/76A')}, {_v('70/74')}, 0.0) AS ca,
    coalesce({_v('60')}, {_v('60/61')}, {_v('60/64')}, {_v('60/66A')}, 0.0) AS achats,
    coalesce({_v('71')}, 0.0) AS variation_stocks,
    coalesce({_v('9901')}, 0.0) AS ebit,
    coalesce({_v('9904')}, 0.0) AS resultat_net,
    coalesce({_v('54')} + {_v('55')}, {_v('54')}, {_v('55')}, {_v('54/58')}, 0.0) AS tresorerie,
    coalesce({_v('17')} + {_v('43')}, {_v('17')}, {_v('43')}, {_v('17/49')}, 0.0) AS dettes_financieres,
    coalesce({_v('10/15')}, 0.0) AS fonds_propres,
    coalesce({_v('100')}, {_v('1011')}, 0.0) AS capital_souscrit
  FROM wide WHERE period_end_ts IS NOT NULL),
facts AS (
  SELECT *, ca - achats + variation_stocks AS marge_brute,
    CASE WHEN ca <> 0 THEN resultat_net / ca * 100.0 END AS marge_nette,
    CASE WHEN fonds_propres <> 0 THEN resultat_net / fonds_propres * 100.0 END AS roe,
    CASE WHEN dettes_financieres <> 0 THEN tresorerie / dettes_financieres END AS liquidite,
    CASE WHEN fonds_propres <> 0 THEN dettes_financieres / fonds_propres * 100.0 END AS endettement
  FROM base)"""

FACTS_WITH = "WITH " + FILING_LINES_CTE + "," + WIDE_CTE + "," + FACTS_CTE


def _num(col: str) -> str:
    return number_sql(col)


REGISTER_CTE = f"""
enterprise AS (
  SELECT {_num('c_custkey')} AS EnterpriseNumber,
         CASE WHEN c_acctbal >= 0 THEN 'AC' ELSE CAST(c_nationkey AS VARCHAR) END AS Status,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '1' ELSE '2' END AS TypeOfEnterprise,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS JuridicalForm,
         strftime(fo.first_date, '%d-%m-%Y') AS StartDate, c_custkey AS _seq
  FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_date FROM orders GROUP BY o_custkey) fo
       ON fo.o_custkey = c_custkey),
activity AS (
  SELECT {_num('o_custkey')} AS EntityNumber, (['2003', '2008', '2025', '1999'])[1 + o_orderkey % 4] AS NaceVersion,
         o_orderpriority AS NaceCode, o_orderstatus AS Classification, o_orderkey AS _seq FROM orders),
address AS (
  SELECT {_num('o_custkey')} AS EntityNumber,
         CASE WHEN o_orderstatus = 'F' THEN 'REGO' ELSE 'BAET' END AS TypeOfAddress,
         strftime(o_orderdate, '%m%d') AS Zipcode,
         CASE WHEN o_orderpriority <> '1-URGENT' THEN lower(substr(o_orderpriority, 3, 20)) END AS MunicipalityFR,
         upper(o_orderpriority) AS MunicipalityNL,
         CASE WHEN o_orderpriority <> '2-HIGH' THEN 'Rue ' || CAST(o_orderkey AS VARCHAR) END AS StreetFR,
         'Straat ' || CAST(o_orderkey AS VARCHAR) AS StreetNL,
         CAST(day(o_orderdate) AS VARCHAR) AS HouseNumber, o_orderkey AS _seq FROM orders),
denomination AS (
  SELECT {_num('o_custkey')} AS EntityNumber,
         CASE o_orderpriority WHEN '1-URGENT' THEN '001' WHEN '2-HIGH' THEN '002' ELSE '003' END AS TypeOfDenomination,
         'Name ' || CAST(o_orderkey AS VARCHAR) AS Denomination, o_orderkey AS _seq FROM orders),
branch AS (
  SELECT {_num('o_custkey')} AS EnterpriseNumber, strftime(o_orderdate, '%Y-%m-%d') AS StartDate, o_orderkey AS _seq
  FROM orders WHERE o_orderstatus = 'O'),
establishment AS (
  SELECT {_num('o_custkey')} AS EnterpriseNumber, strftime(o_orderdate, '%d-%m-%Y') AS StartDate, o_orderkey AS _seq
  FROM orders WHERE o_orderstatus = 'P'),
contact AS (
  SELECT {_num('o_custkey')} AS EntityNumber, 'EMAIL' AS ContactType,
         'c' || CAST(o_orderkey AS VARCHAR) || '@example.org' AS Value, o_orderkey AS _seq
  FROM orders WHERE o_orderpriority = '5-LOW'),
code AS (
  SELECT 'Status' AS Category, CAST(n_nationkey AS VARCHAR) AS Code,
         CASE WHEN n_regionkey = 4 THEN 'NL' ELSE 'FR' END AS Language, n_name AS Description,
         CAST(n_nationkey AS BIGINT) AS _seq FROM nation
  UNION ALL
  SELECT 'Status', CAST(n_nationkey AS VARCHAR), 'FR', lower(n_name), CAST(n_nationkey + 1000 AS BIGINT)
  FROM nation WHERE n_regionkey = 0
  UNION ALL
  SELECT DISTINCT 'JuridicalForm', c_mktsegment, 'FR', lower(c_mktsegment), CAST(2000 AS BIGINT)
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
  UNION ALL
  SELECT DISTINCT 'Nace2008', o_orderpriority, 'FR', lower(o_orderpriority), CAST(3000 AS BIGINT)
  FROM orders WHERE substr(o_orderpriority, 1, 1) IN ('1', '3', '5')
  UNION ALL
  SELECT DISTINCT 'Nace2003', o_orderpriority, 'FR', upper(o_orderpriority), CAST(3000 AS BIGINT)
  FROM orders WHERE substr(o_orderpriority, 1, 1) IN ('1', '2')
  UNION ALL
  SELECT DISTINCT 'Nace2025', o_orderpriority, 'FR', 'n25 ' || o_orderpriority, CAST(3000 AS BIGINT)
  FROM orders WHERE substr(o_orderpriority, 1, 1) IN ('2', '4')),
dict AS (
  SELECT Category AS category, coalesce(trim(Code), 'None') AS code, arg_max(Description, _seq) AS label
  FROM code WHERE Language = 'FR' AND Category IS NOT NULL AND Category <> '' AND coalesce(trim(Code), 'None') <> ''
  GROUP BY ALL),
nace AS (
  SELECT code, max(label) FILTER (WHERE category = 'Nace2003') AS n2003,
         max(label) FILTER (WHERE category = 'Nace2008') AS n2008,
         max(label) FILTER (WHERE category = 'Nace2025') AS n2025
  FROM dict WHERE category IN ('Nace2003', 'Nace2008', 'Nace2025') GROUP BY code),
activity_l AS (
  SELECT a.*, coalesce(nullif(CASE a.NaceVersion WHEN '2003' THEN n.n2003 WHEN '2025' THEN n.n2025 ELSE n.n2008 END, ''),
                       nullif(n.n2008, ''), nullif(n.n2025, ''), nullif(n.n2003, ''), '') AS NaceLabel
  FROM activity a LEFT JOIN nace n ON n.code = coalesce(trim(a.NaceCode), 'None')),
activity_d AS (
  SELECT * FROM activity_l
  QUALIFY row_number() OVER (PARTITION BY EntityNumber, coalesce(trim(NaceCode), 'None'),
                                          coalesce(trim(Classification), 'None') ORDER BY _seq) = 1),
enterprise_l AS (
  SELECT e.*,
    CASE WHEN coalesce(trim(e.JuridicalForm), 'None') <> '' THEN coalesce(jf.label, '') END AS JuridicalFormLabel,
    CASE WHEN coalesce(trim(e.Status), 'None') <> '' THEN coalesce(st.label, '') END AS StatusLabel
  FROM enterprise e
  LEFT JOIN dict jf ON jf.category = 'JuridicalForm' AND jf.code = coalesce(trim(e.JuridicalForm), 'None')
  LEFT JOIN dict st ON st.category = 'Status' AND st.code = coalesce(trim(e.Status), 'None'))"""


def flip_sql(c: str) -> str:
    return (f"CASE WHEN {c} IS NOT NULL AND len(string_split({c}, '-')) = 3 "
            f"THEN split_part({c}, '-', 3) || '-' || split_part({c}, '-', 2) || '-' || split_part({c}, '-', 1) "
            f"ELSE {c} END")
