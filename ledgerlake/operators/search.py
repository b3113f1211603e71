"""Batch search of companies by name or number.

A batch of queries is a DataFrame (query_id, q); all queries are answered in
one job.  Semantics per query:

* the raw query must have at least 2 characters; it is then trimmed;
* at least 5 digits -> number query (J13): the company number must contain
  the normalised number as a regex (9/10 digits -> 'dddd.ddd.ddd' where the
  dots match any character; otherwise the digit run itself);
* otherwise name query (J11): names sharing a token with the query (tokens
  = lower case, accents stripped, split on non-alphanumerics; OR), or all of its
  "phrases"; companies with an excluded -word do not count (``name_index``);
* a name query without any hit falls back to a case-insensitive regex on the
  names (J12);
* only companies with an activity in the sector codes (F10); at most
  ``limit`` per query, ordered by company number (O4).

Queries, the postings of their tokens and their token hits are written once each (``materialise``), since
every kind of part reads them again.  All matching is done with equi-joins on generated keys (tokens, 3-grams,
number keys); a nested-loop join is used only for fallback queries whose
pattern requires no 3-gram (``required_grams``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import HOTEL_NACE_CODES
from ..functions import expr as X
from ..sources.sinks import materialise
from . import name_index as NI
from .name_index import build_name_index, company_names as _names, fold, merge_name_index, tokens, update_name_index  # noqa: F401


def has_sector(activities: Column, codes=HOTEL_NACE_CODES) -> Column:
    """any activity with a sector code, any classification."""
    return X.has_sector(activities, codes)


def search_projection(companies: DataFrame) -> DataFrame:
    """the nested fields a result list shows (nested column pruning
    keeps the scan to these leaves)."""
    return companies.select(
        "EnterpriseNumber", "StatusLabel", "JuridicalFormLabel",
        F.transform("denominations", lambda d: F.struct(d["Denomination"].alias("Denomination"))).alias("denominations"),
        F.transform("addresses", lambda a: F.struct(a["Zipcode"].alias("Zipcode"),
                                                    a["MunicipalityFR"].alias("MunicipalityFR"))).alias("addresses"),
        F.transform("activities", lambda a: F.struct(a["NaceCode"].alias("NaceCode"),
                                                     a["NaceLabel"].alias("NaceLabel"))).alias("activities"))


def classify(queries: DataFrame) -> DataFrame:
    """X30 + input checks: query_id, q, qt (trimmed), kind, digits."""
    qt = X.py_strip(F.col("q"))
    digits = F.regexp_replace(qt, r"[^0-9]", "")
    return (queries.filter(F.length("q") >= 2)
            .select("query_id", "q", qt.alias("qt"), digits.alias("digits"))
            .withColumn("kind", X.query_kind(F.col("qt"))))


def _number_keys(cands: DataFrame) -> DataFrame:
    """What number queries can match in a company number, as (wkind, key).

    ``dotted``: the ten digits of a 12-character stretch dddd.ddd.ddd (the
    dots stand for any character); a number as the register writes it has
    one.  ``run``: the stretches of five and more within a run of digits; a
    dotted number has none, so only undotted numbers give any."""
    num, n = F.col("EnterpriseNumber"), F.length("EnterpriseNumber")
    at = F.when(n >= 12, F.sequence(F.lit(1), n - 11)).otherwise(F.array().cast("array<int>"))
    dotted = (cands.select(num, F.explode(at).alias("p")).select("EnterpriseNumber", num.substr(F.col("p"), F.lit(12)).alias("w"))
              .filter(F.col("w").rlike("^[0-9]{4}.[0-9]{3}.[0-9]{3}$"))
              .select("EnterpriseNumber", F.lit("dotted").alias("wkind"),
                      F.concat(F.substring("w", 1, 4), F.substring("w", 6, 3), F.substring("w", 10, 3)).alias("key")))
    runs = cands.select(num, F.explode(F.regexp_extract_all(num, F.lit("([0-9]{5,})"))).alias("r"))
    runs = runs.select("EnterpriseNumber", "r", F.explode(F.sequence(F.lit(1), F.length("r") - 4)).alias("p"))
    runs = runs.select("EnterpriseNumber", "r", "p", F.explode(F.sequence(F.lit(5), F.length("r") - F.col("p") + 1)).alias("n"))
    return dotted.unionByName(runs.select("EnterpriseNumber", F.lit("run").alias("wkind"), F.col("r").substr(F.col("p"), F.col("n")).alias("key")))


def number_hits(cands: DataFrame, q: DataFrame) -> DataFrame:
    """J13 as an equi-join on (kind, key): one key a dotted company number."""
    nd = F.length("digits")
    qk = (q.filter(F.col("kind") == "number")
          .select("query_id", F.when(nd.isin(9, 10), F.lit("dotted")).otherwise(F.lit("run")).alias("wkind"),
                  F.when(nd == 9, F.concat(F.lit("0"), F.col("digits"))).otherwise(F.col("digits")).alias("key")))
    return (qk.join(NI.shuffled(_number_keys(cands)), ["wkind", "key"])
            .select("query_id", "EnterpriseNumber", F.lit("number").alias("source")).distinct())


def token_hits(names: DataFrame, q: DataFrame, limit: int) -> DataFrame:
    """Phrases, minus terms and the OR of plain words (``name_index``); of queries of plain
    words the first ``limit`` companies at least.  Only postings of the batch's tokens are ranked and joined."""
    return _token_hits(_asked_postings(names, NI.query_terms(q)), q, limit)


def _dealt(names: DataFrame) -> DataFrame:
    """``names`` dealt out anew: millions of them may be a scan of one task, and splitting them is the work."""
    return names.repartition("EnterpriseNumber", "name_no")


def _asked_postings(names: DataFrame, terms: DataFrame) -> DataFrame:
    return NI.placed_postings(names).join(NI.asked_tokens(terms), "tok", "left_semi")


def _token_hits(own: DataFrame, q: DataFrame, limit: int) -> DataFrame:
    return NI.text_hits(own, NI.query_terms(q), limit).withColumn("source", F.lit("token"))


def _grams(c: Column, n: int) -> Column:
    """Distinct substrings of length ``n`` (shorter strings give none)."""
    idx = F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1)))
    return F.filter(F.array_distinct(F.transform(idx, lambda i: c.substr(i, F.lit(n)))),
                    lambda g: F.length(g) == n)


_CUT = "\u0000"


def required_grams(pattern: Column) -> Column:
    """3-grams that a name (ASCII-lower-cased) must have to match ``pattern`` (case-insensitive):
    an array a branch of the pattern (a|b), each of the grams of all its literal runs.  A match
    has all grams of a branch at least.  Null where the pattern's parts can't be told (inline flags,
    special escapes, nested classes, unbalanced brackets) or some branch has no run of three characters."""
    def cut(c: Column, regex: str, by: str = _CUT) -> Column:
        return F.regexp_replace(c, F.lit(regex), F.lit(by))

    p = cut(X.ascii_lower(pattern), r"(?s)\\(?:[dwsb]|[^a-z0-9])")          # classes of one letter, escaped signs
    p = cut(p, r"\[[^\[\]]*\]")                                             # character classes
    for _ in range(4):
        p = cut(p, r"\([^()]*\)")                                           # groups, from the innermost
    p = cut(p, r"[^|](?:[?*]|\{[^{}]*\})[?+]?")                             # what may be absent or repeat
    known = ~pattern.contains("(?") & ~p.rlike(r"[\\\[\](){}?*]|[|][+]")
    p = cut(p, r"[+.^$]")
    branches = F.transform(F.split(p, r"\|"), lambda branch: F.array_distinct(F.flatten(
        F.transform(F.filter(F.split(branch, _CUT), lambda run: F.length(run) >= 3), lambda run: _grams(run, 3)))))
    return F.when(known & F.forall(branches, lambda grams: F.size(grams) > 0), branches)


def split_by_grams(q: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Name queries whose pattern Java's engine accepts, as (query_id, qt, branches) of those with
    required grams and (query_id, qt) of the others.  Patterns are compiled with the engine rlike uses,
    through ``try_reflect`` (null when compile throws), so that a wrong one gives no rows and fails no batch."""
    valid = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), F.concat(F.lit("(?i)"), F.col("qt"))).isNotNull()
    known = q.filter(valid).select("query_id", "qt", required_grams(F.col("qt")).alias("branches"))
    return known.filter(F.col("branches").isNotNull()), known.filter(F.col("branches").isNull()).select("query_id", "qt")


def regex_hits(names: DataFrame, q: DataFrame) -> DataFrame:
    """Case-insensitive regex on names for the given name queries.

    A pattern's branches are narrowed with the 3-grams each requires (``required_grams``; a
    literal text is one branch): the rarest of them, by the names that have it, proposes names in an equi-join with
    the grams of the names, so a gram that most names have moves nothing; the others and the regex
    are tested there.  Only patterns that require no gram (one or two letters,
    ``h.t.l``, inline flags) are tested against all names (nested-loop join with the query side)."""
    planned, other = split_by_grams(q)
    qg = planned.select("query_id", "qt", F.posexplode("branches").alias("branch", "gs"))
    asked = qg.select("*", F.explode("gs").alias("g"))
    # grams of every name, exploded map-side (no global distinct)
    every = names.filter("EnterpriseNumber IS NOT NULL").select("EnterpriseNumber", "name", F.explode(_grams(X.ascii_lower(F.col("name")), 3)).alias("g"))
    often = every.join(asked.select("g").distinct(), "g", "left_semi").groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    # a branch with a gram that no name has is left out here
    lead = (asked.join(NI.shuffled(often), "g", "left").groupBy("query_id", "qt", "branch", "gs")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")).alias("lead"))
            .filter(F.col("lead.n") > 0).select("query_id", "qt", "gs", F.col("lead.g").alias("g")))
    pattern = F.concat(F.lit("(?i)"), F.col("qt"))
    cand = lead.join(NI.shuffled(every), "g")
    verified = (cand.filter(F.forall("gs", lambda g: F.contains(X.ascii_lower(F.col("name")), g)))
                .filter(F.regexp_like(F.col("name"), pattern)).select("query_id", "EnterpriseNumber"))
    # each pattern is broadcast once: it is the names that are many
    fits = F.broadcast(other.select("qt").distinct()).join(names, F.regexp_like(F.col("name"), pattern)).select("qt", "EnterpriseNumber")
    theta = other.join(NI.shuffled(fits), "qt").select("query_id", "EnterpriseNumber")
    return verified.unionByName(theta).distinct().withColumn("source", F.lit("regex"))


def rank_limit(hits: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` companies per query, by company number.  The
    rank filter becomes a partial top-n before the shuffle."""
    w = Window.partitionBy("query_id").orderBy("EnterpriseNumber")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def _answer(cands: DataFrame, names: DataFrame, q: DataFrame, tok: DataFrame, limit: int) -> DataFrame:
    num, tok = number_hits(cands, q), materialise(rank_limit(tok, limit).drop("rank"))
    leftover = q.filter(F.col("kind") == "name").join(tok.select("query_id").distinct(), "query_id", "left_anti")
    rx = regex_hits(names, leftover)
    hits = rank_limit(num.unionByName(tok).unionByName(rx), limit)
    return hits.join(NI.shuffled(search_projection(cands)), "EnterpriseNumber").select(
        "query_id", "rank", "EnterpriseNumber", "source", "StatusLabel", "JuridicalFormLabel", "denominations",
        "addresses", "activities")


def search(companies: DataFrame, queries: DataFrame, *, limit: int, codes=HOTEL_NACE_CODES) -> DataFrame:
    """J11-J13 + O4 + F11: at most ``limit`` companies a query.  Output: query_id,
    rank, EnterpriseNumber, source ('number' | 'token' | 'regex') and the
    projected fields."""
    cands = companies.filter(has_sector(F.col("activities"), codes))
    q = materialise(classify(queries))
    names = _dealt(_names(cands))
    own = materialise(_asked_postings(names, NI.query_terms(q)))
    return _answer(cands, names, q, _token_hits(own, q, limit), limit)


# ------------------------------------------------------------------ persistent name index

def search_indexed(companies: DataFrame, index_path: str, queries: DataFrame, *, limit: int,
                   codes=HOTEL_NACE_CODES) -> DataFrame:
    """``search`` with the postings of names read from the stored index (``name_index``),
    among the candidate (sector) companies."""
    cands = companies.filter(has_sector(F.col("activities"), codes))
    q = materialise(classify(queries))
    own = (NI.stored_postings(companies.sparkSession, index_path, NI.asked_tokens(NI.query_terms(q)))
           .join(NI.shuffled(cands.select("EnterpriseNumber")), "EnterpriseNumber", "left_semi"))
    own = materialise(NI.with_places(own))
    return _answer(cands, _dealt(_names(cands)), q, _token_hits(own, q, limit), limit)
