"""Language identification as mixture inference (operator 3).

A language is a distribution over hashed byte n-grams of lower-cased letters
(n = 4, runs of anything else read as one space), estimated with additive
smoothing from all training documents.  A document is a mixture of languages:
its n-grams are drawn from sum_l pi_l P(g | l).  Expectation-maximisation
finds the proportions pi of a language set; the set is chosen by penalised
log-likelihood ``LL(set) - penalty * (|set| - 1) * log(n)`` among the nested
sets of the largest proportions, so that a second language counts only if the
text has real stretches of it.

Most texts need no iterations: the log-likelihood is concave in pi, so from
the best single language l no mixture gains more than
``n * (max_k mean_g P(g|k) / P(g|l) - 1)``.  Where that bound is below the
penalty of a second language, the single language is the exact choice.

The model is a table of ``languages x buckets`` log-probabilities: its size
depends on the language set, not on the corpus, so it is sent to all tasks.

Nulls, ties and odd input: a null text, or one without a letter (Unicode category L;
numerals are none), is ``und``
with score 0 and no proportions.  Equal likelihoods go to the language that
sorts first.  With an empty training table every document is ``und``.
Repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

BUCKETS = 1 << 16
LETTER = regex.compile(r"\p{L}")  # numerals such as ½ and Ⅷ are none
#: Characters of a text from which on it is counted a step at a time.
STEP = 1 << 20

# Bytes of ASCII characters that aren't letters become spaces; the bytes of all others stay.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def _hashed(raw: bytes) -> np.ndarray:
    a = np.frombuffer(raw, np.uint8).astype(np.uint32)
    g = a[:-3] | a[1:-2] << 8 | a[2:-1] << 16 | a[3:] << 24
    return (g * np.uint32(2654435761) >> np.uint32(16)).astype(np.uint16)


def grams(text: str) -> np.ndarray:
    """Bucket of every 4-byte gram of a text's letters, as uint16."""
    raw = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "
    return _hashed(raw.ljust(4))


def counts(text: str) -> np.ndarray:
    """How often each bucket occurs among ``grams(text)``, a step of the text at a time."""
    if len(text) <= STEP:
        return np.bincount(grams(text), minlength=BUCKETS)
    out, kept, met = np.zeros(BUCKETS, np.int64), b" ", 1
    for lo in range(0, len(text), STEP):
        raw = text[lo:lo + STEP].lower().encode("utf-8", "replace").translate(_LETTERS)
        words = b" ".join(raw.split())
        if raw[:1] == b" " and kept[-1:] != b" ":
            words = b" " + words
        if raw[-1:] == b" " and words[-1:].strip():
            words += b" "
        met += len(words)
        kept += words
        out += np.bincount(_hashed(kept) if len(kept) > 3 else [], minlength=BUCKETS).astype(np.int64)
        kept = kept[-3:]
    if kept[-1:] != b" ":
        kept, met = kept + b" ", met + 1
        out += np.bincount(_hashed(kept) if len(kept) > 3 else [], minlength=BUCKETS).astype(np.int64)
    return out if met > 3 else np.bincount(_hashed(kept.ljust(4)), minlength=BUCKETS)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prob: np.ndarray  # (buckets, languages) float32


def train(docs: DataFrame, use: Column, smoothing: float = 0.5) -> LanguageModel:
    """The language model of the rows where ``use`` holds and text and lang
    are not null.  Each task counts its n-grams into a table of fixed size."""
    def counted(batches):
        held: dict[str, np.ndarray] = {}
        for b in slices(batches):
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                if LETTER.search(text):
                    if lang not in held:
                        held[lang] = np.zeros(BUCKETS, np.int64)
                    held[lang] += counts(text)
        for lang, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], ["lang", "bucket", "n"])

    rows = (docs.filter(use & F.col("text").isNotNull() & F.col("lang").isNotNull())
            .select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
            .mapInArrow(counted, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())  # languages x buckets rows at most
    languages = tuple(sorted(rows["lang"].unique()))
    table = np.full((BUCKETS, len(languages)), smoothing)
    for k, lang in enumerate(languages):
        part = rows[rows["lang"] == lang]
        table[part["bucket"].to_numpy(), k] += part["n"].to_numpy()
    return LanguageModel(languages, np.log(table / table.sum(0)).astype(np.float32))


def _em(p: np.ndarray, times: np.ndarray, starts: np.ndarray, sizes: np.ndarray, total: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Proportions (languages x documents), log-likelihood and a bound on how far
    it is from the best, over the languages ``allowed``.  Document d has the
    distinct n-grams from ``starts[d]`` on: likelihoods are the columns of ``p``,
    how often each occurs is ``times``, and ``total`` is their sum a document."""
    pi = allowed / allowed.sum(0)
    for left in range(rounds, -1, -1):
        joint = p * np.repeat(pi, sizes, axis=1)
        mixed = joint.sum(0)
        # mean of P(g|k) / P(g|mixture): the next proportions are pi times it, and by concavity it bounds what is still to gain
        slope = np.add.reduceat(p * (times / mixed), starts, axis=1) / total
        if not left:
            gap = total * np.maximum((slope * (allowed > 0)).max(0) - 1, 0)
            return pi, np.add.reduceat(np.log(mixed) * times, starts), gap
        pi = pi * slope
        pi /= pi.sum(0)


def mixtures(model: LanguageModel, texts: list[str], penalty: float = 3.0, rounds: int = 25) -> np.ndarray:
    """Language proportions of each text (texts x languages); texts must have a letter."""
    # a long text as its distinct buckets with how often they occur: 65,536 entries at most
    got, times_of = [], {}
    for d, t in enumerate(texts):
        if len(t) > STEP:
            n = counts(t)
            got.append(np.flatnonzero(n).astype(np.uint16))
            times_of[d] = n[got[-1]]
        else:
            got.append(grams(t))
    entries = np.array([len(g) for g in got])
    sizes = np.array([int(times_of[d].sum()) if d in times_of else len(g) for d, g in enumerate(got)])
    times = np.concatenate([times_of.get(d, np.ones(len(g))) for d, g in enumerate(got)]) if times_of else None
    starts = np.concatenate([[0], np.cumsum(entries)[:-1]])
    logs = np.ascontiguousarray(model.log_prob.T)[:, np.concatenate(got)]
    total = np.add.reduceat(logs if times is None else logs * times, starts, axis=1, dtype=np.float64).T
    best = total.argmax(1)
    pi = np.zeros(total.shape)
    pi[np.arange(len(texts)), best] = 1.0
    k = total.shape[1]
    if k == 1:
        return pi
    own = np.take_along_axis(logs, np.repeat(best, entries)[None, :], axis=0)
    more = np.exp(np.minimum(logs - own, 60))
    gain = np.add.reduceat(more if times is None else more * times, starts, axis=1, dtype=np.float64).max(0) - sizes
    cost = penalty * np.log(np.maximum(sizes, 2))
    open_ = np.flatnonzero(gain > cost)
    # a group of texts at a time: its arrays stay in the processor's cache
    groups, held = [[]], 0
    for d in open_:
        if held > 60_000:
            groups.append([])
            held = 0
        groups[-1].append(d)
        held += entries[d]
    for ds in map(np.array, groups):
        if not len(ds):
            continue
        seen = [(got[d], times_of[d]) if d in times_of else np.unique(got[d], return_counts=True) for d in ds]
        often = np.concatenate([n for _, n in seen]).astype(np.float64)
        part = model.log_prob[np.concatenate([g for g, _ in seen])].T.astype(np.float64)
        top = part.max(0)
        p = np.exp(part - top)

        def fit(at: np.ndarray, allowed: np.ndarray, rounds: int):
            """EM of the group's documents ``at``."""
            size = np.array([len(seen[x][0]) for x in at])
            inside = np.isin(of, at)
            start = np.concatenate([[0], np.cumsum(size)[:-1]])
            shares, ll, gap = _em(np.ascontiguousarray(p[:, inside]), often[inside], start, size, sizes[ds[at]].astype(np.float64), allowed, rounds)
            return shares.T, ll + np.add.reduceat(top[inside] * often[inside], start), gap

        of = np.repeat(np.arange(len(ds)), [len(g) for g, _ in seen])
        at = np.arange(len(ds))
        score, chosen = total[ds, best[ds]].copy(), pi[ds]
        _, ll, gap = fit(at, np.ones((k, len(at))), 4)
        # even all languages together cannot pay for a second one: the single language stays
        at = at[ll + gap > score + cost[ds]]
        if not len(at):
            continue
        full, *_ = fit(at, np.ones((k, len(at))), rounds)
        order = np.argsort(-full, axis=1, kind="stable")
        for m in range(2, k + 1):
            allowed = np.zeros((len(at), k))
            np.put_along_axis(allowed, order[:, :m], 1.0, axis=1)
            shares, ll, _ = fit(at, allowed.T, rounds)
            now = ll - cost[ds[at]] * (m - 1)
            better = now > score[at]
            score[at[better]], chosen[at[better]] = now[better], shares[better]
        pi[ds] = chosen
    return pi


def identify(docs: DataFrame, model: LanguageModel, penalty: float = 3.0, names: tuple[str, str, str] = ("lang_pred", "score", "proportions")) -> DataFrame:
    """``docs`` (any columns, text among them) with lang_pred (the language of
    the largest proportion), score (that proportion) and proportions (of the
    chosen language set), under other names if given; columns of docs that
    have these names are replaced.  Only ``text`` goes into a prediction."""
    keep = docs.select([c for c in docs.columns if c not in names])
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def predicted(batches):
        m = shared.value
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            found: list[tuple] = [("und", 0.0, [])] * len(texts)
            step, held = [], 0
            for i, t in enumerate([*texts, None]):
                if t and m.languages and LETTER.search(t):
                    step.append(i)
                    held += len(t)
                if step and (held > 1_000_000 or i == len(texts)):
                    for j, pi in zip(step, mixtures(m, [texts[j] for j in step], penalty)):
                        top = int(pi.argmax())
                        found[j] = (m.languages[top], min(1.0, float(pi[top])), [(m.languages[k], float(pi[k])) for k in np.flatnonzero(pi > 1e-6)])
                    step, held = [], 0
            lang, score, parts = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(parts, pa.map_(pa.string(), pa.float64()))],
                                             [*b.schema.names, *names])

    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in keep.schema), T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()),
                           T.StructField(names[2], T.MapType(T.StringType(), T.DoubleType()))])
    return keep.mapInArrow(predicted, schema)
