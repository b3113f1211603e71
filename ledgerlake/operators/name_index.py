"""Positional postings of company names (J11): terms, phrases, minus terms, and an index of segments.

A text query has parts: ``"words in a row"`` (a phrase), ``-word`` or ``-"words"`` (excluded) and
plain words.  A company fits if it has every phrase, each within one of its names; without phrases, if
it has any plain word.  A company with an excluded word or phrase in any name does not fit.  A query of
excluded parts alone fits nothing.  A quote without its partner separates words.

A posting is (EnterpriseNumber, name_no, tok, pos).  The stored index is a set of segments: the first
holds all companies, each later one those whose names changed.  A company's postings count only in the
newest segment that lists it, so an update writes the changed companies alone.  The list of live
segments is a snapshot table (``sources.sinks``): a reader sees an update as a whole or not at all.

Tables that grow with the companies are joined by shuffles (``shuffled``): their size before a scan is that of
compressed files, of which a few MB hold millions of names that would be broadcast through the driver."""

from __future__ import annotations

import unicodedata
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import sinks


def _accent_table() -> tuple[str, str]:
    """Every letter of the basic plane that is another letter with marks, and
    that letter (a rule on the Unicode database, not a hand-written list)."""
    pairs = [(chr(cp), unicodedata.normalize("NFD", chr(cp))) for cp in range(0xC0, 0xD7FF)]
    pairs = [(c, d[0]) for c, d in pairs if len(d) > 1 and all(unicodedata.combining(m) for m in d[1:])]
    return "".join(c for c, _ in pairs), "".join(d for _, d in pairs)


_ACCENTED, _PLAIN = _accent_table()
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
QUERY_PART = r'-?"[^"]*"|[^\s"]+'

POSTING_SCHEMA = "EnterpriseNumber string, name_no int, pos int, tok string, segment string, tok_bucket int"
COMPANY_SCHEMA = "EnterpriseNumber string, names_hash string, segment string"
SEGMENT_SCHEMA = "segment string, ordinal int, buckets int, live boolean"


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is not broadcast, however small its files are."""
    return df.hint("merge")


def fold(c: Column) -> Column:
    """Lower case with accents stripped, whether they are part of a letter or
    marks of their own (search tokens)."""
    return F.regexp_replace(F.translate(F.lower(c), _ACCENTED, _PLAIN), r"\p{M}+", "")


def words(c: Column) -> Column:
    """The tokens of a text in order, repeats kept."""
    return F.filter(F.split(fold(c), TOKEN_SPLIT), lambda t: t != "")


def tokens(c: Column) -> Column:
    return F.array_distinct(words(c))


def company_names(companies: DataFrame) -> DataFrame:
    return (companies.select("EnterpriseNumber", F.posexplode("denominations").alias("name_no", "d"))
            .select("EnterpriseNumber", "name_no", F.col("d.Denomination").alias("name"))
            .filter(F.col("name").isNotNull()))


def postings(names: DataFrame) -> DataFrame:
    """Every token of every name with its place."""
    return names.select("EnterpriseNumber", "name_no", F.posexplode(words(F.col("name"))).alias("pos", "tok"))


def query_terms(q: DataFrame) -> DataFrame:
    """Name queries -> query_id, plus (tokens), phrases and minus (arrays of tokens in a row)."""
    parts = F.regexp_extract_all(F.col("qt"), F.lit(QUERY_PART), F.lit(0))

    def runs(keep) -> Column:
        return F.filter(F.transform(F.filter(parts, keep), words), lambda run: F.size(run) > 0)

    def sign(p: Column) -> Column:
        return F.substring(p, 1, 1)

    return q.filter(F.col("kind") == "name").select(
        "query_id", F.array_distinct(F.flatten(runs(lambda p: ~sign(p).isin("-", '"')))).alias("plus"),
        runs(lambda p: sign(p) == '"').alias("phrases"), runs(lambda p: sign(p) == "-").alias("minus"))


def asked_tokens(terms: DataFrame) -> DataFrame:
    """The distinct tokens of a batch of queries."""
    return terms.select(F.explode(F.flatten(F.concat(F.array("plus"), "phrases", "minus"))).alias("tok")).distinct()


def _first_of_token(index: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` companies of each token, by company number.  A
    query's answer is its first ``limit`` companies by number, and those that an OR
    of tokens finds first are among the first of each token, so nothing is
    lost, and a very common token moves only so many rows (the rank
    filter is a partial top-n before the shuffle)."""
    w = Window.partitionBy("tok").orderBy("EnterpriseNumber")
    return index.withColumn("_n", F.dense_rank().over(w)).filter(F.col("_n") <= limit).select("tok", "EnterpriseNumber")


def with_places(index: DataFrame) -> DataFrame:
    """Postings, each with all postings of its name as ``places`` ((pos, tok) structs): a phrase is told from one row."""
    names = index.groupBy("EnterpriseNumber", "name_no").agg(F.collect_list(F.struct("pos", "tok")).alias("places"))
    return names.select("EnterpriseNumber", "name_no", "places", F.explode("places").alias("_at")).select("EnterpriseNumber", "name_no", "_at.pos", "_at.tok", "places")


def placed_postings(names: DataFrame) -> DataFrame:
    """``with_places`` of the postings of ``names``, from each name itself."""
    every = names.select("EnterpriseNumber", "name_no", F.transform(words(F.col("name")), lambda t, k: F.struct(k.alias("pos"), t.alias("tok"))).alias("places"))
    return every.select("EnterpriseNumber", "name_no", "places", F.explode("places").alias("_at")).select("EnterpriseNumber", "name_no", "_at.pos", "_at.tok", "places")


def _in_a_row() -> Column:
    """Whether all of a row's ``toks`` stand in a row in its name, from place ``start``."""
    return F.forall(F.transform("toks", lambda t, k: F.struct((F.col("start") + k).alias("pos"), t.alias("tok"))), lambda at: F.array_contains("places", at))


def phrase_hits(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """``phrases`` (query_id, no, toks) -> (query_id, no, EnterpriseNumber).  The rarest token of a phrase
    proposes places, the others are looked up there."""
    toks = phrases.select("query_id", "no", "toks", F.posexplode("toks").alias("off", "tok"))
    often = index.join(toks.select("tok").distinct(), "tok", "left_semi").groupBy("tok").agg(F.count(F.lit(1)).alias("n"))
    lead = (toks.join(shuffled(often), "tok", "left").groupBy("query_id", "no", "toks")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "tok")).alias("lead"))
            .select("query_id", "no", "toks", F.col("lead.tok").alias("tok"), F.col("lead.off").alias("off")))
    found = lead.join(shuffled(index), "tok").select("query_id", "no", "toks", "EnterpriseNumber", "places", (F.col("pos") - F.col("off")).alias("start"))
    return found.filter(_in_a_row()).select("query_id", "no", "EnterpriseNumber").distinct()


def excluded(index: DataFrame, hits: DataFrame, phrases: DataFrame) -> DataFrame:
    """Of ``hits`` (query_id, EnterpriseNumber) those that have one of their query's ``phrases``; only the names of hits are looked at."""
    lead = phrases.withColumn("tok", F.col("toks")[0]).join(shuffled(hits), "query_id")
    found = lead.join(shuffled(index), ["tok", "EnterpriseNumber"]).select("query_id", "toks", "EnterpriseNumber", "places", F.col("pos").alias("start"))
    return found.filter(_in_a_row()).select("query_id", "EnterpriseNumber").distinct()


def text_hits(index: DataFrame, terms: DataFrame, limit: int) -> DataFrame:
    """(query_id, EnterpriseNumber) of the companies that fit.  Of queries of plain words alone at least
    the first ``limit`` companies by number; of others all, since excluded companies must not use up the limit.
    ``index``: postings with their names' ``places``."""
    plain = (F.size("phrases") == 0) & (F.size("minus") == 0)
    simple, other = terms.filter(plain), terms.filter(~plain)
    any_word = (simple.select("query_id", F.explode("plus").alias("tok")).join(shuffled(_first_of_token(index, limit)), "tok")
                .select("query_id", "EnterpriseNumber"))
    asked = other.filter(F.size("phrases") > 0).select("query_id", F.size("phrases").alias("n_phrases"), F.posexplode("phrases").alias("no", "toks"))
    whole = (phrase_hits(index, asked.select("query_id", "no", "toks"))
             .join(asked.select("query_id", "n_phrases").distinct(), "query_id")
             .groupBy("query_id", "n_phrases", "EnterpriseNumber").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") == F.col("n_phrases")).select("query_id", "EnterpriseNumber"))
    loose = (other.filter(F.size("phrases") == 0).select("query_id", F.explode("plus").alias("tok"))
             .join(shuffled(index), "tok").select("query_id", "EnterpriseNumber"))
    hits = whole.unionByName(loose).distinct()
    ban = other.select("query_id", F.posexplode("minus").alias("no", "toks"))
    return any_word.unionByName(hits.join(shuffled(excluded(index, hits, ban)), ["query_id", "EnterpriseNumber"], "left_anti")).distinct()


# ------------------------------------------------------------------ stored index

def token_bucket(tok: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(tok), F.lit(buckets)).cast("int")


def _segments(spark: SparkSession, out: str) -> tuple[str | None, list]:
    """The snapshot of the list of segments and its rows (a handful: a merge keeps them few)."""
    path = f"{out}/segments"
    return sinks.current_snapshot(spark, path), sorted(sinks.read_table(spark, path, SEGMENT_SCHEMA).collect(), key=lambda r: r["ordinal"])


def live_segments(spark: SparkSession, out: str) -> list:
    return [r for r in _segments(spark, out.rstrip("/"))[1] if r["live"]]


def _publish(spark: SparkSession, out: str, rows: list[tuple], expected: str | None) -> None:
    sinks.write_replace(spark.createDataFrame(rows, SEGMENT_SCHEMA).coalesce(1), f"{out}/segments", expected=expected)


def _publish_alone(spark: SparkSession, out: str, segment: str, buckets: int, old: list, expected: str | None) -> None:
    """``segment`` becomes the only live one.  Those that were live stay for readers that still use them;
    those replaced before them are removed."""
    last = max([r["ordinal"] for r in old], default=0)
    _publish(spark, out, [(segment, last + 1, buckets, True)] + [(r["segment"], r["ordinal"], r["buckets"], False) for r in old if r["live"]], expected)
    for r in old:
        if not r["live"]:
            for part in ("postings", "companies"):
                sinks.remove(spark, f"{out}/{part}/segment={r['segment']}")


def _state(companies: DataFrame) -> DataFrame:
    """Each company with a digest of its names."""
    names = F.transform("denominations", lambda d: d["Denomination"])
    return (companies.filter(F.col("EnterpriseNumber").isNotNull())
            .select("EnterpriseNumber", F.sha2(F.coalesce(F.to_json(names), F.lit("[]")), 256).alias("names_hash")))


def _write_companies(rows: DataFrame, out: str, segment: str) -> DataFrame:
    rows.withColumn("segment", F.lit(segment)).write.mode("append").partitionBy("segment").parquet(f"{out}/companies")
    return _companies(rows.sparkSession, out, [segment])


def _write_postings(index: DataFrame, out: str, segment: str, buckets: int) -> None:
    # REBALANCE: clustered by token, but a very common token is split over several write tasks by AQE
    (index.withColumns({"segment": F.lit(segment), "tok_bucket": token_bucket(F.col("tok"), buckets)}).hint("rebalance", "tok")
     .sortWithinPartitions("segment", "tok_bucket", "tok").write.mode("append").partitionBy("segment", "tok_bucket").parquet(f"{out}/postings"))


def _companies(spark: SparkSession, out: str, names: list[str]) -> DataFrame:
    return spark.read.schema(COMPANY_SCHEMA).parquet(f"{out}/companies").filter(F.col("segment").isin(names))


def _ordinal(live: list) -> Column:
    """The place of a row's segment in the order of writing."""
    return F.element_at(F.create_map(*[F.lit(x) for r in live for x in (r["segment"], r["ordinal"])]), F.col("segment"))


def _fresh_segment() -> str:
    return f"s-{uuid.uuid4().hex}"


def build_name_index(companies: DataFrame, out: str, buckets: int = 64) -> None:
    """Postings of all company names as one segment, partitioned by a hash bucket of the token and sorted by
    token, so that a batch of queries reads only its tokens' buckets.  Replaces what segments there were."""
    spark, out, segment = companies.sparkSession, out.rstrip("/"), _fresh_segment()
    snapshot, old = _segments(spark, out)
    _write_companies(_state(companies), out, segment)
    _write_postings(postings(company_names(companies)), out, segment, buckets)
    _publish_alone(spark, out, segment, buckets, old, snapshot)


def update_name_index(companies: DataFrame, out: str) -> bool:
    """A further segment of the companies whose names differ from those indexed, new and vanished companies
    included.  Only (company, digest) is compared; names of other companies are not split again.  False,
    and no segment, if nothing changed.  Raises ConflictError if another writer changed the index meanwhile."""
    spark, out, segment = companies.sparkSession, out.rstrip("/"), _fresh_segment()
    snapshot, rows = _segments(spark, out)
    live = [r for r in rows if r["live"]]
    if not live:
        raise ValueError(f"{out} holds no index: build it first")
    known = _latest(spark, out, live).withColumnRenamed("names_hash", "_known")
    changed = (_state(companies).join(known, "EnterpriseNumber", "full_outer")
               .filter(~F.col("names_hash").eqNullSafe(F.col("_known"))).select("EnterpriseNumber", "names_hash"))
    written = _write_companies(changed, out, segment)
    if written.isEmpty():
        return False
    _write_postings(postings(company_names(companies.join(shuffled(written), "EnterpriseNumber", "left_semi"))), out, segment, live[0]["buckets"])
    _publish(spark, out, [tuple(r) for r in rows] + [(segment, rows[-1]["ordinal"] + 1, live[0]["buckets"], True)], snapshot)
    return True


def merge_name_index(spark: SparkSession, out: str) -> None:
    """All live segments as one."""
    out, segment = out.rstrip("/"), _fresh_segment()
    snapshot, rows = _segments(spark, out)
    live = [r for r in rows if r["live"]]
    if len(live) < 2:
        return
    _write_companies(_latest(spark, out, live).filter(F.col("names_hash").isNotNull()), out, segment)
    _write_postings(_alive(_postings(spark, out, live), spark, out, live), out, segment, live[0]["buckets"])
    _publish_alone(spark, out, segment, live[0]["buckets"], rows, snapshot)


def _latest(spark: SparkSession, out: str, live: list) -> DataFrame:
    """Each company's newest digest (null: the company vanished)."""
    rows = _companies(spark, out, [r["segment"] for r in live]).withColumn("ordinal", _ordinal(live))
    return rows.groupBy("EnterpriseNumber").agg(F.max_by("names_hash", "ordinal").alias("names_hash"))


def _postings(spark: SparkSession, out: str, live: list) -> DataFrame:
    return spark.read.schema(POSTING_SCHEMA).parquet(f"{out}/postings").filter(F.col("segment").isin([r["segment"] for r in live]))


def _alive(index: DataFrame, spark: SparkSession, out: str, live: list) -> DataFrame:
    """Postings that no later segment replaces.  Only the later segments' companies are read."""
    if len(live) > 1:
        later = (_companies(spark, out, [r["segment"] for r in live[1:]])
                 .groupBy("EnterpriseNumber").agg(F.max(_ordinal(live)).alias("_latest")))
        index = (index.join(shuffled(later), "EnterpriseNumber", "left")
                 .filter(F.col("_latest").isNull() | (F.col("_latest") == _ordinal(live))))
    return index.select("EnterpriseNumber", "name_no", "pos", "tok")


def stored_postings(spark: SparkSession, out: str, toks: DataFrame) -> DataFrame:
    """Postings of the tokens in ``toks``; buckets without any of them are not read (dynamic partition pruning)."""
    out = out.rstrip("/")
    live = live_segments(spark, out)
    if not live:
        raise ValueError(f"{out} holds no list of segments: build the index again")
    asked = toks.withColumn("tok_bucket", token_bucket(F.col("tok"), live[0]["buckets"]))
    return _alive(_postings(spark, out, live).join(asked, ["tok_bucket", "tok"], "left_semi"), spark, out, live)
