from pyspark.sql import functions as F

from ledgerlake.functions import expr as X


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_company_key_and_number(spark):
    assert one(spark, X.company_key(F.col("x")), " 0400.039 084 ") == "0400039084"
    assert one(spark, X.normalize_company_number(F.col("x")), "0836157420") == "0836.157.420"
    assert one(spark, X.normalize_company_number(F.col("x")), "836157420") == "0836.157.420"
    assert one(spark, X.normalize_company_number(F.col("x")), "BE 0836.157.420") == "0836.157.420"
    # 6 digits: returned as given
    assert one(spark, X.normalize_company_number(F.col("x")), "123456") == "123456"


def test_flip_date_not_idempotent(spark):
    assert one(spark, X.flip_date(F.col("x")), "03-02-2010") == "2010-02-03"
    assert one(spark, X.flip_date(F.col("x")), "2001-05-06") == "06-05-2001"
    assert one(spark, X.flip_date(F.col("x")), "01/01/2000") == "01/01/2000"
    assert one(spark, X.flip_date(F.col("x")), None) is None
    assert one(spark, X.flip_date(F.col("x")), "") == ""


def test_layout_type(spark):
    cases = {"m02-f": "full", "A01": "abrege", "V1": "abrege", "m04-p": "micro", "x9": "full", None: "full"}
    for model, expected in cases.items():
        assert one(spark, X.layout_type(F.col("x")), model) == expected, model


def test_cash_and_debt_fallbacks(spark):
    df = spark.createDataFrame([(30.0, 20.0, 99.0), (30.0, None, 99.0), (None, 20.0, 99.0), (None, None, 99.0),
                                (None, None, None)], "a double, b double, c double")
    got = [r[0] for r in df.select(X.cash("a", "b", "c")).collect()]
    assert got == [50.0, 30.0, 20.0, 99.0, 0.0]


def test_ratios_null_on_zero(spark):
    df = spark.createDataFrame([(100.0, 1000.0, 0.0)], "net double, ca double, eq double")
    r = df.select(X.net_margin("net", "ca").alias("m"), X.roe("net", "eq").alias("roe")).first()
    assert r["m"] == 10.0 and r["roe"] is None


def test_deed_filename_round_trip(spark):
    df = spark.createDataFrame([("0123456789", "2021-03-04", "D1"), ("0123456789", None, "D2")],
                               "k string, d string, i string")
    names = [r[0] for r in df.select(X.deed_filename("k", "d", "i")).collect()]
    assert names == ["0123456789_20210304_D1.pdf", "0123456789_unknown_D2.pdf"]
    p = spark.createDataFrame([(n,) for n in names + ["0123_only.pdf"]], "n string") \
        .select(X.parse_deed_filename("n").alias("p")).collect()
    assert (p[0]["p"]["deed_date"], p[0]["p"]["doc_id"]) == ("20210304", "D1")
    assert p[2]["p"]["doc_id"] == "unknown"


def test_collapse_spaces_and_texts(spark):
    assert one(spark, X.collapse_spaces(F.col("x")), "  Doe ,\n     Jane ") == "Doe , Jane"
    assert one(spark, X.ratio_text(F.col("x")), 12.345, "x double") == "12.3 %"
    assert one(spark, X.ratio_text(F.col("x")), 1234.56, "x double") == "1234.6 %"
    assert one(spark, X.liquidity_text(F.col("x")), 0.125, "x double") == "0.13"
    assert one(spark, X.ratio_text(F.col("x")), 0.0, "x double") == "N/C"
    assert one(spark, X.amount_text(F.col("x")), 1234.5, "x double") == "1,234.5 €"
    assert one(spark, X.amount_text(F.col("x")), 1000.0, "x double") == "1,000 €"
    assert one(spark, X.amount_text(F.col("x")), None, "x double") == "N/C"


def test_not_in_nullsafe_keeps_null(spark):
    df = spark.createDataFrame([("110",), (None,), ("014",)], "f string")
    kept = [r[0] for r in df.filter(X.not_in_nullsafe(F.col("f"), ["110"])).collect()]
    assert sorted(kept, key=str) == sorted([None, "014"], key=str)
