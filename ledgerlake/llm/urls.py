"""URL filter: rules first, gradient-boosted trees for the rest (operator 8).

A rule is ``host/path`` with a verdict.  It fits a URL if the URL's host is the
rule's or a subdomain of it and its path starts with the rule's path; the
longest rule that fits wins.  URLs that a rule fits are the labelled ones.
From them Spark ML's gradient-boosted trees learn lexical features: lengths,
depth, shares of digits and symbols, character entropy, parameter counts and
suffix statistics (how often URLs with the same top-level domain, registered
domain, first path part or file extension are blocked).  URLs that no rule fits get
the model's verdict.

Suffix statistics are counted by the exact suffix, a row a kind and suffix of the
labelled URLs, and joined on it; a suffix without labelled URLs has the prior
rate and count 0.  Labelled URLs are dealt into ``FOLDS`` folds; a training row
sees the counts of the other folds only, so that labels don't leak into features.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased.  Path: then up to ``?``, ``#`` or the end.

Nulls, ties and odd input: a null URL or one without ``://`` has empty host and
path, fits no rule with a host, and is judged by the model.  Equally long rules
cannot both fit a URL unless they are equal; then ``block`` wins.  Without labelled
URLs every verdict is ``allow``; with labels of one class only, that class.
Repeated rows are judged each; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

ALLOW, BLOCK = "allow", "block"
FOLDS = 5
KINDS = ("tld", "domain", "folder", "extension")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> dict[str, Column]:
    """host and path of a URL, by plain cuts."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return {"host": host, "path": path}


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (else null) and its verdict."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0] != BLOCK, r[1]))

    def fits(rule: str) -> Column:
        h, _, p = rule.partition("/")
        return ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)

    rule = reduce(lambda out, r: out.when(fits(r[1]), F.lit(r[1])), ordered[1:], F.when(fits(ordered[0][1]), F.lit(ordered[0][1]))) if ordered else F.lit(None).cast("string")
    verdict = reduce(lambda out, r: out.when(fits(r[1]), F.lit(r[0])), ordered[1:], F.when(fits(ordered[0][1]), F.lit(ordered[0][0]))) if ordered else F.lit(None).cast("string")
    return rule, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{pattern}]", "")).cast("double")


LEXICAL = ("url_length", "host_length", "path_length", "depth", "host_labels", "digits", "host_digits", "hyphens", "symbols", "parameters", "query_length", "fragment", "secure", "port", "longest_part", "entropy")
FEATURES = (*LEXICAL, *(f"{k}_rate" for k in KINDS), *(f"{k}_seen" for k in KINDS))


def with_lexical(urls: DataFrame) -> DataFrame:
    """Adds the lexical features and the suffixes to rows of url, host, path."""
    u, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    n = F.greatest(F.length(u), F.lit(1))
    chars = F.array_distinct(F.split(u, ""))
    entropy = F.aggregate(chars, F.lit(0.0), lambda acc, c: acc - F.when(c == "", F.lit(0.0)).otherwise(
        ((n - F.length(F.replace(u, c, F.lit("")))) / n) * F.log2((n - F.length(F.replace(u, c, F.lit("")))) / n)))
    labels = F.split(host, r"\.")
    suffix = {
        "tld": F.element_at(labels, -1),
        "domain": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)),
        "folder": F.element_at(F.split(F.concat(path, F.lit("/")), "/"), 2),
        "extension": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1),
    }
    values = {
        "url_length": F.length(u), "host_length": F.length(host), "path_length": F.length(path), "depth": _count(path, "/"), "host_labels": F.size(labels),
        "digits": _count(u, "0-9") / n, "host_digits": _count(host, "0-9") / F.greatest(F.length(host), F.lit(1)), "hyphens": _count(u, r"\-_"),
        "symbols": F.length(F.regexp_replace(u, "[A-Za-z0-9]", "")) / n,
        "parameters": _count(query, "="), "query_length": F.length(query), "fragment": u.contains("#"), "secure": F.lower(u).startswith("https://"),
        "port": host.rlike(r":\d+$"), "longest_part": F.array_max(F.transform(F.split(path, "/"), F.length)), "entropy": entropy,
    }
    return urls.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in values.items()}
                            | {f"{k}_suffix": F.coalesce(v, F.lit("")) for k, v in suffix.items()})


def _with_rates(rows: DataFrame, counts: DataFrame, prior: float, fold: Column | None = None) -> DataFrame:
    """Adds the share of blocked URLs of each suffix, and how many there are;
    with ``fold`` without those of the row's own fold."""
    for k in KINDS:
        of = counts.filter(F.col("kind") == k).select(F.col("suffix").alias(f"{k}_suffix"), F.col("n").alias("n_"), F.col("blocked").alias("blocked_"))
        # no hint: small tables are broadcast, of larger ones AQE cuts the parts of hot suffixes
        rows = rows.join(of, f"{k}_suffix", "left")

        def seen(name: str) -> Column:
            whole = F.coalesce(F.aggregate(name, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0))
            return whole if fold is None else whole - F.coalesce(F.get(name, fold), F.lit(0))

        rows = rows.withColumns({f"{k}_rate": (seen("blocked_") + 2 * prior) / (seen("n_") + 2), f"{k}_seen": F.log1p(seen("n_").cast("double"))}).drop("n_", "blocked_")
    return rows


def judge(pages: DataFrame, rules: list[tuple[str, str]], iterations: int = 12, depth: int = 3, seed: int = 7) -> DataFrame:
    """page_id, host, path, rule, verdict and score (the model's probability of
    ``block``; null where it judged nothing) of each URL of ``pages`` (page_id,
    url).  ``rules``: (verdict, "host/path")."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    cut = parts(F.col("url"))
    rows = rows.withColumns({k: F.coalesce(v, F.lit("")) for k, v in cut.items()})
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict})
    rows = materialise(with_lexical(rows).drop("url"), "urls")
    known = rows.filter("ruled IS NOT NULL").withColumns({"label": (F.col("ruled") == BLOCK).cast("int"), "fold": F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(FOLDS)).cast("int")})
    by_fold = [F.col("fold") == f for f in range(FOLDS)]
    counts = materialise(
        known.select("label", "fold", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_suffix").alias("suffix")) for k in KINDS])).alias("s"))
        .groupBy("s.kind", "s.suffix").agg(F.array(*[F.sum(f.cast("long")) for f in by_fold]).alias("n"), F.array(*[F.sum(F.when(f, F.col("label")).otherwise(0)) for f in by_fold]).alias("blocked")),
        "suffixes")
    n, blocked = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    result = ("page_id", "host", "path", "rule")
    if blocked in (0, n):
        only = BLOCK if n and blocked == n else ALLOW
        return rows.select(*result, F.coalesce("ruled", F.lit(only)).alias("verdict"), F.lit(None).cast("double").alias("score"))
    vector = array_to_vector(F.array(*FEATURES)).alias("features")
    train = materialise(_with_rates(known, counts, blocked / n, F.col("fold")).select(*FEATURES, F.col("label").cast("double").alias("label")), "url-train")
    train = train.select(vector, "label")
    model = GBTClassifier(maxIter=iterations, maxDepth=depth, seed=seed, maxBins=64, stepSize=0.3, subsamplingRate=1.0).fit(train)
    judged = model.transform(_with_rates(rows, counts, blocked / n).select(*result, "ruled", vector))
    p = vector_to_array("probability")[1]
    return judged.select(*result, F.coalesce("ruled", F.when(p >= 0.5, BLOCK).otherwise(ALLOW)).alias("verdict"), F.when(F.col("ruled").isNull(), p).alias("score"))
