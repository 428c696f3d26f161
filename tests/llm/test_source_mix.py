import re

import duckdb
import pytest

from icdspark.llm import queries
from icdspark.llm import source_mix as sm

SF = "/root/testdata/sf0.001"


def fair(sizes, weights, max_rate=3):
    """Targets by sharing out the excess until none is above."""
    target, free, rest = {}, set(sizes), float(sum(sizes.values()))
    while free:
        total = sum(weights[s] for s in free)
        above = {s for s in free if total and weights[s] * rest / total >= max_rate * sizes[s]}
        if not above or not total:
            return target | {s: weights[s] * rest / total if total else 0.0 for s in free}
        target |= {s: float(max_rate * sizes[s]) for s in above}
        free, rest = free - above, rest - sum(max_rate * sizes[s] for s in above)
    return target


def test_query_equals_sql_and_reruns_agree(spark):
    got = sorted(tuple(r) for r in queries.op12_source_mix(spark, SF).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert got == sorted(con.execute(queries.oracle_sql()["op12_source_mix"]).fetchall())
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(7)
    assert got == sorted(tuple(r) for r in sm.report(docs).collect())


def test_sql_and_loop_agree_where_sources_stop(spark):
    rows = [(i, "w " * (1 if i % 3 else 40 + i), ["a", "b", "c", None][i % 4] if i > 8 else "tiny") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"source": object}))
    got = sorted(map(tuple, sm.report(docs).collect()))
    assert [r[:3] + (round(r[3], 6), r[4]) for r in got] == [
        r[:3] + (round(r[3], 6), r[4]) for r in sorted(con.execute(queries.oracle_sql()["op12_source_mix"]).fetchall())]


def test_targets_and_copies(spark):
    rows = [(i, "w " * (i % 50), f"s{i % 5}" if i % 7 else None) for i in range(3000)] + [(9000 + i, "w", "few") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = sm.mix(docs).collect()
    sizes, longest, taken, target = {}, {}, {}, {}
    for r in found:
        s = r["source"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        longest[s] = max(longest.get(s, 0), r["size"])
        taken[s] = taken.get(s, 0) + r["size"] * r["copies"]
        target[s] = r["target"]
        assert 0 <= r["copies"] <= 3
    order = sorted(sizes, key=lambda s: (s is None, s))
    expected = fair(sizes, {s: 1 + k % 3 for k, s in enumerate(order)})
    assert {s: r["source_size"] for r in found for s in [r["source"]]} == sizes
    assert all(abs(target[s] - expected[s]) < 1e-6 and abs(taken[s] - target[s]) <= longest[s] for s in sizes)
    assert target["few"] == 15.0 and taken["few"] == 15


def test_prefix_sums_cross_integers(spark):
    """A source's copies are the integers that the running sum of its rate crosses, in order of size."""
    docs = spark.createDataFrame([(i, "w " * (i // 3), "abc"[i % 3]) for i in range(300)], "doc_id long, text string, source string")
    for source, u in [(r[0], r[1]) for r in docs.select("source", sm.offset(docs["source"], "x")).distinct().collect()]:
        rows = sorted((r for r in sm.mix(docs, seed="x").collect() if r["source"] == source), key=lambda r: (r["size"], r["doc_id"]))
        rate = rows[0]["target"] / rows[0]["source_size"]
        assert 0 <= u < 1
        total = 0
        for k, r in enumerate(rows, 1):
            total += r["copies"]
            assert total == int(rate * k + u)


def test_emitted_documents_are_whole_rows(spark, docs):
    counts = {r["doc_id"]: r["copies"] for r in sm.mix(docs).collect()}
    out = {}
    given = {r["doc_id"]: r for r in docs.collect()}
    for r in sm.emit(docs).collect():
        assert r == given[r["doc_id"]]
        out[r["doc_id"]] = out.get(r["doc_id"], 0) + 1
    assert out == {i: n for i, n in counts.items() if n}


def test_named_weights(spark, docs):
    found = sm.mix(docs, weights={"src0": 1, "src1": 3}).collect()
    assert {r["source"] for r in found if r["target"] > 0} == {"src0", "src1"}


def test_odd_rows(spark, odd_docs):
    schema = "doc_id long, text string, source string, size string, target string, kept_ string, copies string, number long"
    rows = [(r["doc_id"], r["text"], None if k % 2 else "s", "x", "y", "z", "c", 1) for k, r in enumerate(odd_docs.collect())]
    docs = spark.createDataFrame(rows, schema)
    found = sm.report(docs).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r["doc_id"] or -1, r["size"]) for r in found) == sorted((r[0] or -1, words(r[1])) for r in rows)
    assert sm.emit(docs).columns == docs.columns and sm.emit(docs).count() > 0


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, "", None), (None, " ", None)]])
def test_nothing_to_take(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = sm.report(docs).collect()
    assert len(found) == len(rows) and all(r["taken"] == 0 and r["target"] == 0.0 and r["source_size"] == 0 for r in found)


def test_no_python_in_the_plan(spark, docs):
    plan = sm.report(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
