"""Rows that every operator must take: nulls, empty and very long texts, ties,
repeated rows, and extra columns whose names clash with results."""

DOC_SCHEMA = "doc_id long, text string, lang string, source string, score double, value string, shard int, word string, predicted string, label int"

ODD_TEXTS = [None, "", " ", "a", "a a a", "\n\n", "12 !? 34", "Ünï cödé 中文 текст", "x" * 5000, "long words here and there " * 4000, "tie text here", "tie text here"]


def odd_docs(spark, texts=ODD_TEXTS):
    rows = [(k, t, "en" if k % 2 else None, None, 0.5, "v", 1, "w", "p", 0) for k, t in enumerate(texts)]
    rows += [(None, "a text without an id", None, "s", None, None, None, None, None, None), rows[-1]]  # no id; a repeated row
    return spark.createDataFrame(rows, DOC_SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
