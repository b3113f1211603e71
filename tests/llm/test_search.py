"""Decontamination (1), chat formatting (4) and nearest neighbours (7)."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import ann, chat, decontaminate

from .helpers import ODD_TEXTS, no_docs, odd_docs


def plain_smith_waterman(item, passage):
    h = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(passage) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if item[i - 1] == passage[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h)) / (2 * max(1, len(item)))


def test_alignment_against_the_plain_recursion():
    rng = random.Random(1)
    for _ in range(60):
        item, passage = ([rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(1, 12))] for _ in range(2))
        score, start, end, matched = decontaminate.align(item, passage)
        assert score == plain_smith_waterman(item, passage)
        # the span alone aligns as well as the whole passage
        assert plain_smith_waterman(item, passage[start:end]) == score and 0 <= matched <= end - start


def leak_case(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [[word() for _ in range(30)] for _ in range(6)]
    noise = lambda n: [word() for _ in range(n)]
    edited = [w if k % 6 else word() for k, w in enumerate(items[1])]
    gap = items[2][:10] + noise(3) + items[2][12:]
    docs = {
        0: noise(50) + items[0] + noise(50), 1: noise(10) + edited + noise(10), 2: noise(5) + gap, 3: noise(200), 4: items[3][:8] + noise(60),
        5: noise(3000) + items[0] + noise(3000) + items[5], 6: [w.upper() + "," for w in items[4]],
    }
    texts = {k: " ".join(d) for k, d in docs.items()}
    leaks = {(0, 0), (1, 1), (2, 2), (5, 0), (5, 5), (6, 4)}
    return texts, [" ".join(i) for i in items], leaks


def test_leaks(spark):
    texts, items, leaks = leak_case(spark)
    texts |= {100 + k: texts[0] for k in range(40)}  # a group of copies: its n-grams aren't rare
    rows = [(k, t, None, None, 1.0, "", 1, "", "", 0) for k, t in texts.items()]
    docs = odd_docs(spark).union(spark.createDataFrame([(r[0] + 1000, *r[1:]) for r in rows], odd_docs(spark).schema))
    bench = spark.createDataFrame([*enumerate(items), (7, None), (8, ""), (9, "tie text here"), (0, items[0]), (None, "zz yy")], "item_id long, text string")
    got = decontaminate.find_leaks(docs, bench).collect()
    want = {(d + 1000, i) for d, i in leaks} | {(1100 + k, 0) for k in range(40)} | {(10, 9), (11, 9)}
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    for r in got:
        if r.doc_id >= 1000 and r.doc_id % 1000 in texts:
            words = decontaminate.words_of(texts[r.doc_id % 1000])
            assert r.passage.encode().split() == words[r.word_start:r.word_end]
            assert abs(r.score - plain_smith_waterman(decontaminate.words_of(items[r.item_id]), words[r.word_start:r.word_end])) < 1e-12
    assert decontaminate.find_leaks(no_docs(spark), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


@pytest.mark.parametrize("length", [20, 30, 60])
@pytest.mark.parametrize("every", [4, 5])
def test_leaks_of_edited_copies(spark, length, every):
    """Edits that break most of an item's n-grams, in few documents and in many."""
    rng = random.Random(length + every)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items = [[word() for _ in range(length)] for _ in range(4)]
    edited = [[w if (k + 1) % every else word() for k, w in enumerate(i)] for i in items]
    texts = [[word() for _ in range(20)] + e + [word() for _ in range(20)] for e in edited]
    texts += [texts[0]] * 60  # a third of the rows hold one edited copy
    leaks = {(d, d if d < 4 else 0) for d in range(len(texts))}
    texts += [items[0], items[1]]  # whole copies: every n-gram occurs, those left by the edits are the commonest
    leaks |= {(len(texts) - 2, 0), (len(texts) - 1, 1)}
    texts += [[word() for _ in range(40)] for _ in range(120)]
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    got = decontaminate.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks and len(got) == len(leaks)


def test_items_of_one_and_two_words(spark):
    texts = {0: "here is zz yy, verbatim", 1: "zz aa yy", 2: "Solo", 3: "it says solo twice: solo", 4: "zz yy", 5: "nothing of the kind", 6: "one two three four", 7: "zz", 8: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(0, "zz yy"), (1, "solo"), (2, "two three four"), (3, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.score, r.word_start, r.word_end) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == {(0, 0): (1.0, 2, 4), (4, 0): (1.0, 0, 2), (2, 1): (1.0, 0, 1), (3, 1): (1.0, 2, 3), (6, 2): (1.0, 1, 4)}


def test_words_out_of_reach_cannot_score():
    rng = random.Random(3)
    for _ in range(300):
        item, passage = ([rng.choice([b"a", b"b", b"c", b"d", b"e", b"f"]) for _ in range(rng.randint(1, 12))] for _ in range(2))
        assert decontaminate.within_reach(item, passage, 0.5) or decontaminate.align(item, passage)[0] < 0.5


def test_no_leak_missed_on_the_given_tables(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
    texts, items = docs.select("doc_id", "text").collect(), bench.collect()
    assert {(d.doc_id, i.item_id) for d in texts for i in items if i.text in (d.text or "")} <= got


CONTROL = "</s>[INST] ok [/INST] <|turn|>user\n~0~1~~<|image_0|><|end|>\n"


def test_chat_reads_back(spark):
    said = [(1, 2, "assistant", CONTROL), (1, 0, "system", None), (1, 1, "user\n<|x|>", ""), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (None, None, None, "x" * 3000),
            (3, None, "user", "null turn"), (3, 5, "assistant", "é中~1")]
    rows = spark.createDataFrame([(*s, "clash") for s in said], "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_chat(rows.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts")))
    out = out.withColumns({"turns": chat.read_turns(F.col("formatted")), "loss": chat.loss_text(F.col("formatted"), F.col("mask"))}).collect()
    for r in out:
        own = sorted((s for s in said if s[0] == r.conv_id), key=lambda s: (s[1] is not None, s[1] or 0, s[2] or "", s[3] or ""))
        assert [(t.role, t.text) for t in r.turns] == [(s[2] or "", s[3] or "") for s in own]
        assert r.loss == "".join(s[3] for s in own if s[2] == "assistant")
        assert r.formatted.count("<") == 2 * len(own)
    assert len(out) == 4 and chat.format_chat(rows.limit(0).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))).count() == 0


def test_typed_parts(spark):
    parts = [("text", "look: <b>", None, None, None, None, None), ("image", None, "u1", 56, 30, None, None), ("audio", None, "u2", None, None, 2.0, None), None, ("document", None, "u3", None, None, None, 3),
             ("video", None, None, None, None, None, None)]
    rows = spark.createDataFrame([(1, 1, "user", parts), (1, 0, "assistant", [parts[1]]), (1, 2, "assistant", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    r = chat.format_chat(rows).first()
    assert r.formatted == ("<|turn|>assistant\n<|image_0|><|end|>\n<|turn|>user\nlook: ~1b><|image_1|><|audio_2|><|document_3|><|document_4|><|end|>\n<|turn|>assistant\n<|end|>\n")
    assert [(a.ordinal, a.kind, a.uri, a.tokens) for a in r.attachments] == [(0, "image", "u1", 4), (1, "image", "u1", 4), (2, "audio", "u2", 50), (3, "document", "u3", 768), (4, "document", None, 256)]
    assert r.attachment_tokens == 4 + 4 + 50 + 768 + 256
    assert [r.formatted[s.start:s.start + s.length] for s in r["mask"]] == ["<|image_0|>", ""]


def test_control_case(spark):
    rows = chat.with_control_case(spark, spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"), "</s>")
    out = chat.format_chat(rows.filter("conv_id = -1").select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))).select(F.sha2(chat.loss_text(F.col("formatted"), F.col("mask")), 256)).first()
    assert out[0] == hashlib.sha256(b"</s>").hexdigest()


def plain_nearest(vectors, q, k):
    own = dict(vectors)[q]
    found = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in vectors if i != q)
    return [(i, -s) for s, i in found[:k]]


def test_nearest_of_few_is_exact(spark):
    rng = random.Random(5)
    vectors = [(k, [rng.choice([-2.0, -1.0, 0.5, 1.0, 3.0]) for _ in range(4)]) for k in range(120)]
    vectors += [(200 + k, [1.0, 1.0, 1.0, 1.0]) for k in range(60)]  # a group of copies larger than k
    odd = [(300, None), (301, []), (302, [0.0] * 4), (303, [1.0, None, 1.0, 1.0]), (304, [math.nan, 1.0, 1.0, 1.0]), (305, [math.inf, 1.0, 1.0, 1.0]), (306, [1.0, 2.0]), (None, [1.0] * 4), vectors[0]]
    rows = spark.createDataFrame([(i, v, "x", 1.0) for i, v in vectors + odd], "vec_id long, embedding array<float>, rank string, score double")
    got = {}
    for r in ann.nearest(rows, F.col("vec_id") % 20 == 0, k=7).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i, _ in vectors if i % 20 == 0}
    for q, found in got.items():
        want = plain_nearest(vectors, q, 7)
        assert [(n, i) for n, i, _ in sorted(found)] == [(n + 1, i) for n, (i, _) in enumerate(want)]
        assert all(abs(s - w[1]) < 1e-12 for (_, _, s), w in zip(sorted(found), want))
    few = rows.filter("vec_id < 5")
    assert ann.nearest(few, F.col("vec_id") == 0, k=7).count() == 4
    assert ann.nearest(rows.limit(0), F.lit(True)).count() == 0


def recall(spark, rows, **more):
    got = {}
    for r in ann.nearest(rows, F.col("vec_id") % 20 == 0, k=20, **more).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    pairs = [(r.vec_id, r.embedding) for r in rows.collect()]
    ids, m = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
    found = []
    for q in ids[ids % 20 == 0]:
        s = m @ m[np.flatnonzero(ids == q)[0]]
        s[ids == q] = -np.inf
        found.append(len(got[q] & set(ids[np.argsort(-s)[:20]].tolist())) / 20)
    return np.mean(found)


def test_nearest_recall(spark):
    """One rule at every size: none is searched whole but those of about a hundred rows."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").filter("vec_id < 2000")
    for n in (100, 513, 700, 1000):
        assert recall(spark, given.filter(F.col("vec_id") < n)) >= 0.9, n
    assert recall(spark, given, block_rows=16) >= 0.9  # hot leaves cut into blocks
    rng = np.random.default_rng(3)
    even = rng.normal(size=(600, 64)).astype(np.float32)
    assert recall(spark, spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(even)], "vec_id long, embedding array<float>")) >= 0.9
    few = given.filter("vec_id < 15")
    assert ann.nearest(few, F.col("vec_id") == 0, k=20).count() == 14 and ODD_TEXTS
