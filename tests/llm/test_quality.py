import re
from collections import Counter

import numpy as np
import pytest

from icdspark.llm import quality_classifier as qc, quality_rules as qr
from icdspark.llm.queries import op4_quality_classifier, op10_quality_rules

SF = "/root/testdata/sf0.001"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_rules_query_equals_brute_force(spark, texts):
    rows = op10_quality_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        values = plain(texts[r["doc_id"]])
        assert tuple(r[m] for m in qr.MEASURES) == values
        assert r["base_failed"] == (values[0] < 20 or 100 * values[4] > 30 * values[0])
        assert not (r["base_failed"] and r["kept"])


@pytest.mark.parametrize("text", [
    None, "", " \n ", "a b c d e f g h " * 5, "a b c d e f g h i", "x\x85y z w", "é 中\n\n é 中\né 中 ", "one two " * 4,
    " ".join("abcdefgh") + " " + " ".join("abcdefgh"), "a " * 7 + "\x0b\x0c\r b",
])
def test_measures_of_cases(text):
    m = qr.Measures(text)
    assert tuple(getattr(m, n) for n in qr.MEASURES) == plain(text)


def test_verdict_does_not_depend_on_the_order(texts):
    orders = [list(qr.RULES), list(qr.RULES)[::-1]]
    for text in texts.values():
        assert len({qr.rejected_by(qr.Measures(text), o) is None for o in orders}) == 1


def test_cascade_stops_at_the_first_rejection(monkeypatch):
    called = []
    rules = {n: (lambda m, n=n: called.append(n) or n == "b") for n in "abc"}
    monkeypatch.setattr(qr, "RULES", rules)
    assert qr.rejected_by(qr.Measures("x"), ["c", "b", "a"]) == "b" and called == ["c", "b"]


def test_order_is_by_rejections_per_cost(make):
    rows = [(i, "word " * 3000) for i in range(40)]  # only the costly window rule and stutter reject
    order = qr.rule_order(make(rows))
    assert sorted(order) == sorted(qr.RULES)
    assert order.index("stutter") < order.index("few_words")


def test_junk_goes_and_clean_documents_stay(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
    bad = {r["doc_id"] for r in labels.filter("quality = 0").collect()}
    rows = {r["doc_id"]: r for r in op10_quality_rules(spark, SF).collect()}
    assert all(rows[i]["kept"] or rows[i]["base_failed"] for i in good if i in rows)
    assert sum(not rows[i]["kept"] for i in bad if i in rows) >= 0.95 * sum(i in rows for i in bad)
    kept = {r["doc_id"] for r in qr.keep_good(docs).collect()}
    assert kept == {i for i, r in rows.items() if r["kept"]}


def test_rules_on_odd_rows(odd_docs, no_docs):
    rows = qr.quality_report(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == 0 and by[1]["base_failed"] and not by[1]["kept"]
    assert qr.keep_good(odd_docs).columns == odd_docs.columns
    assert qr.quality_report(no_docs).collect() == [] and qr.keep_good(no_docs).collect() == []


def test_classifier_learns_and_never_sees_the_held_out_fold(spark, docs):
    out = {r["doc_id"]: r for r in op4_quality_classifier(spark, "/root/testdata/sf0.01").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    from zlib import crc32

    assert all(r["held_out"] == (crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out.values())
    held = [(out[i]["score"], y) for i, y in labels.items() if i in out and out[i]["held_out"]]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.9
    docs01 = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    table = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = table.withColumn("quality", qc.F.when(qc.held_out("doc_id"), 1 - qc.F.col("quality")).otherwise(qc.F.col("quality")))
    assert np.array_equal(qc.train(docs01, table), qc.train(docs01.repartition(5), flipped))


def test_ftrl_separates_two_classes():
    good, bad = ["fine calm prose here"] * 20, ["*** ### junk"] * 20
    w = np.zeros((1 << qc.BITS) + 1)
    w = qc.fit_shard(good + bad, [1] * 20 + [0] * 20, w)
    assert qc.score(w, good[0]) > 0.9 > 0.1 > qc.score(w, bad[0])


def test_ftrl_start_is_kept_without_rows():
    w = np.zeros((1 << qc.BITS) + 1)
    w[[3, 9]] = 0.7, -1.2
    assert np.allclose(qc.fit_shard([], [], w), w)


def test_classifier_on_odd_rows(make, odd_docs, no_docs):
    labels = make([(7, 1), (9, 0), (None, 1), (4, None)], "doc_id long, quality int")
    weights = qc.train(odd_docs, labels)
    rows = qc.classify(odd_docs, weights).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] is False for r in rows if r["doc_id"] is None)
    nothing = qc.train(odd_docs, labels.limit(0))
    assert not nothing.any() and qc.classify(odd_docs, nothing).first()["score"] == 0.5
    assert qc.classify(no_docs, weights).collect() == []
