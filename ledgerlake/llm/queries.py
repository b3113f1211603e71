"""The registered queries ``opN_<name>`` and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, decontaminate, langid, lattice, negatives, packing, piecewise, quality, simhash, spelling, urls, wavelet
from .common import id_remainder, shared_path, table, tokenizer_path


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item, exact or edited."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents as wavelet-matrix files, read back."""
    path = shared_path(spark, "token-files")
    wavelet.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return wavelet.digests(spark, path)


def op4_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted; digests are read back from the formatted text and mask."""
    rows = chat.with_control_case(spark, table(spark, sf_dir, "conversations"), "</s>[INST] ok [/INST]")
    out = chat.format_chat(rows.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts")))
    turns, loss = chat.read_turns(F.col("formatted")), chat.loss_text(F.col("formatted"), F.col("mask"))
    out = out.withColumns({"turns": turns, "loss": loss})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op5_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; learnt where crc32(doc_id) mod 4 is not 2."""
    out = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), id_remainder("doc_id", 4) != 2)
    return out.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids."""
    out = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0, window=1024)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learnt where crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, id_remainder("doc_id", 3) != 1)
    out = langid.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "proportions")


def op7_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op8_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: the rules', else the trees'."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op9_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document; learnt where crc32(doc_id) mod 7 is not 2."""
    return lattice.score(table(spark, sf_dir, "documents"), id_remainder("doc_id", 7) == 2, tokenizer_path("piece_bpe_32k.model"))


def op10_simhash_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector, three for each of its five positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op12_trie_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of all words of seven letters or more; every 31st run (by its hash) has lost a letter."""
    return spelling.variants(table(spark, sf_dir, "documents"), min_chars=7, min_count=2, ratio=10, damage=31)


def op13_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piecewise hashes of every document, of its edited text, and their likeness."""
    out = piecewise.fingerprints(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate, op2_wavelet_tokens, op3_language_mixture, op4_chat_parts, op5_rule_ensemble, op6_packing, op7_projection_forest, op8_url_trees,
        op9_subword_lattice, op10_simhash_bytes, op11_threshold_negatives, op12_trie_spelling, op13_piecewise_hash,
    )
}

ORACLE: dict[str, str] = {
    "op4_chat_parts": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        marked AS (
            SELECT *, length(replace(replace(replace(role, '~', '~0'), '<', '~1'), chr(10), '~2')) + length(replace(replace(text, '~', '~0'), '<', '~1'))
                + length('<|turn|>') + 1 + length('<|end|>') + 1 AS chars
            FROM rows)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM marked GROUP BY conv_id""",
    "op11_threshold_negatives": """
        WITH rows AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        near AS (
            SELECT a.vec_id AS anchor_id, a.label, a.v, r.vec_id AS positive_id, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS positive_score
            FROM rows a JOIN rows r ON r.label = a.label AND r.vec_id <> a.vec_id
            WHERE a.vec_id % 50 = 0
            QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY positive_score DESC, positive_id) <= 5),
        scored AS (
            SELECT a.vec_id AS anchor_id, r.vec_id AS negative_id, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS negative_score
            FROM rows a JOIN rows r ON r.label <> a.label AND r.vec_id <> a.vec_id
            WHERE a.vec_id % 50 = 0)
        SELECT anchor_id, positive_id,
            CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INT) AS rank,
            negative_id, positive_score, negative_score
        FROM near JOIN scored USING (anchor_id)
        WHERE 50 * positive_score <= 100 * negative_score AND 100 * negative_score <= 95 * positive_score
        QUALIFY rank <= 3""",
}
