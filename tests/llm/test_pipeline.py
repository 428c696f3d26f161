import corpus_pipeline as cp
from icdspark.llm import decontaminate as dc, quality_rules as qr
from icdspark.llm.queries import queries
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_simhash_dedup import plain_components, plain_print

SF = "/root/testdata/sf0.001"


def test_run_equals_the_plain_pipeline(spark, texts):
    good = {i: t for i, t in texts.items() if qr.rejected_by(qr.Measures(t), list(qr.RULES)) is None}
    lines = plain_lines(good.items())
    rows = {r["doc_id"]: r for r in cp.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = docs
    for name, function in cp.STAGES[:2]:
        stage = function(spark, stage, SF)
        assert stage.columns == docs.columns, name
    cleaned = {r["doc_id"]: r["text"] for r in stage.collect()}
    assert {i: [x.strip() for x in t.split("\n") if x.split()] for i, t in cleaned.items()} == lines
    label = plain_components({i: plain_print(t) for i, t in cleaned.items()})
    items = [dc.normal(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = {i for i in cleaned if label[i] == i and not any(x in dc.normal(cleaned[i]) for x in items)}
    assert set(rows) == expected
    assert all(r["round_trip"] for r in rows.values())


def test_stages(spark, odd_docs, no_docs):
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "line_dedup", "simhash_dedup", "decontaminate", "sentencepiece"]
    for name, function in cp.STAGES:
        for docs in (odd_docs, no_docs):
            out = function(spark, docs, SF)
            out.count()
            if name != "sentencepiece":
                assert out.columns == docs.columns, name


def test_every_operator_has_its_query():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [n for n in names if n.startswith("op")] == list(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14)) and "pipeline" in names
