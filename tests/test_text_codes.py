"""Golden pairs for the note cleaner, tokeniser and code normalisation."""

import pytest
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from icdspark.functions import codes as fc
from icdspark.functions import text as ft

CLEAN_CASES = [
    ("[**Hosp 1**] Keep me [**Name**] End.", " End ", ["", "end"]),
    ("a\\b don't x\\ y", "a\\b don't x\\ y", ["a\\b", "don't", "x\\", "y"]),
    ("12 34 x 56\n78\n90 z", "12 78 z", ["12", "78", "z"]),
    ("lead: 5 mg p.o. b.i.d\nq 4 h.", "lead mg q ", ["lead", "mg", "q"]),
    ("  Hello, World!  ", " Hello World ", ["", "hello", "world"]),
    ("one\ntwo\n\nthree", "one two three", ["one", "two", "three"]),
    ("x[**a\nb**]y", "x b y", ["x", "b", "y"]),
    ("A\n1\nB\n2\nC word", "A word", ["a", "word"]),
    ("", "", [""]),
]


def test_cleaner_and_tokens(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CLEAN_CASES)], "i int, text string")
    rows = df.select("i", ft.clean_note("text").alias("c")).withColumn("t", ft.tokenize("c")).orderBy("i").collect()
    for row, (_, cleaned, tokens) in zip(rows, CLEAN_CASES):
        assert row["c"] == cleaned
        assert row["t"] == tokens


def test_tokenize_matches_ml_tokenizer(spark):
    texts = ["", " ", "  a", "a  ", "A\tB\nc ", " x y\t", "\t\t", "Ab Cd"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    ml = Tokenizer(inputCol="text", outputCol="ml").transform(df)
    for r in ml.select("ml", ft.tokenize("text").alias("ours")).collect():
        assert r["ml"] == r["ours"]


def test_tokenize_matches_ml_tokenizer_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(ft.clean_note("text").alias("text"))
    ml = Tokenizer(inputCol="text", outputCol="ml").transform(docs)
    bad = ml.filter(F.col("ml") != ft.tokenize("text")).count()
    assert bad == 0


CODE_CASES = [
    ("00845", "845", "84.5"),
    ("0389", "389", "38.9"),
    ("E8790", "E879.0", "E8.790"),
    ("E879", "E879", "E8.79"),
    ("4019", "401.9", "40.19"),
    ("486", "486", "48.6"),
    ("0000", "0", "0."),
    ("V5861", "V58.61", "V5.861"),
    ("0066", "66", "66."),
    ("01", "1", "1."),
    (" 4019", " 40.19", " 4.019"),
    ("", "", "."),
]


def test_code_dotting(spark):
    df = spark.createDataFrame([(c[0],) for c in CODE_CASES], "raw string")
    got = {r["raw"]: (r["d"], r["p"]) for r in df.select(
        "raw", fc.dot_diagnosis("raw").alias("d"), fc.dot_procedure("raw").alias("p")).collect()}
    for raw, d, p in CODE_CASES:
        assert got[raw] == (d, p), raw


@pytest.mark.parametrize("raw,is_diag,want", [
    ("4019", True, "401.9"), ("401.9", True, "401.9"), ("E8790", True, "E879.0"), ("0389", True, "038.9"),
    ("3893", False, "38.93"), ("38.93", False, "38.93"), ("1", False, "1."),
])
def test_reformat_code(spark, raw, is_diag, want):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert df.select(fc.reformat_code("raw", is_diag)).first()[0] == want


def test_text_length_and_splits(spark):
    df = spark.createDataFrame([("",), (" a b",), ("a  b ",)], "t string")
    rows = df.select(ft.text_length("t").alias("n"), ft.split_whitespace("t").alias("w")).collect()
    assert [r["n"] for r in rows] == [1, 3, 4]
    assert [r["w"] for r in rows] == [[], ["a", "b"], ["a", "b"]]


def test_join_tokens_null_safe(spark):
    df = spark.createDataFrame([(None,), (["a", "b"],)], "t array<string>")
    assert [r[0] for r in df.select(ft.join_tokens("t")).collect()] == [None, "a b"]


def test_tokenized_text_equals_joined_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(ft.clean_note("text").alias("c"))
    extra = spark.createDataFrame([("",), (" ",), (" a\tB \x0b",), ("\t",), ("x\fy  ",)], "c string")
    both = docs.unionByName(extra)
    bad = both.filter(ft.tokenized_text("c") != ft.join_tokens(ft.tokenize("c"))).count()
    assert bad == 0
