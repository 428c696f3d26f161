"""Bucketed running sums and the patient split against brute force."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from icdspark.operators import split as sp
from icdspark.operators.running import (
    grouped_row_number,
    previous_value,
    range_bucket,
    row_number,
    running_sum,
    score_bucket,
)


def test_running_sum_matches_cumsum(spark):
    rng = random.Random(3)
    rows = [(k % 3, k, rng.randint(0, 9)) for k in rng.sample(range(10_000), 600)]
    df = spark.createDataFrame(rows, "g int, k int, v int")
    for bucket in (range_bucket("k", 97), range_bucket("k"), F.lit(0)):
        for exclusive in (False, True):
            out = running_sum(df, ["k"], {"s": "v"}, bucket, partition_cols=["g"], exclusive=exclusive).collect()
            got = {(r["g"], r["k"]): r["s"] for r in out}
            for g in range(3):
                acc = 0
                for _, k, v in sorted(r for r in rows if r[0] == g):
                    if not exclusive:
                        acc += v
                    assert got[(g, k)] == acc
                    if exclusive:
                        acc += v


def test_global_row_number(spark):
    df = spark.range(0, 5000).withColumn("k", (F.col("id") * 7919) % 5003)
    out = row_number(df, ["k"], range_bucket("k", 450), name="rn").select("k", "rn").collect()
    ks = sorted(r["k"] for r in out)
    assert {r["k"]: r["rn"] for r in out} == {k: i + 1 for i, k in enumerate(ks)}


def test_running_sum_totals(spark):
    df = spark.createDataFrame([(g, k, k) for g in range(3) for k in range(50 * g)], "g int, k int, v int")
    out = running_sum(df, ["k"], {"s": "v"}, range_bucket("k", 9), ["g"], totals={"s": "all"})
    assert all(r["all"] == sum(range(50 * r["g"])) for r in out.collect())


def test_score_buckets_are_monotone(spark):
    rng = random.Random(1)
    scores = sorted({0.0, 1.0, 0.5, 1e-300, 1 - 2**-53, *(rng.random() ** rng.choice([1, 9, 60]) for _ in range(2000))})
    got = [r["b"] for r in spark.createDataFrame([(s,) for s in scores], "s double").select(
        "s", score_bucket("s").alias("b")).orderBy("s").collect()]
    assert got == sorted(got) and len(set(got)) > 500


def test_grouped_row_number_and_previous_value(spark):
    rng = random.Random(8)
    rows = [(rng.randint(0, 1), rng.randint(1, 4), k) for k in rng.sample(range(5000), 400)]
    df = spark.createDataFrame(rows, "p int, g int, k int")
    out = grouped_row_number(df, F.col("g"), ["k"], range_bucket("k", 700), "n", ["p"]).collect()
    for p in (0, 1):
        assert [r["n"] for r in sorted((r for r in out if r["p"] == p), key=lambda r: (r["g"], r["k"]))] == list(
            range(1, 1 + sum(r[0] == p for r in rows)))
    values = sorted(k for _, _, k in rows)
    got = {r["k"]: r["before"] for r in previous_value(df, "k", range_bucket("k", 100), "before").collect()}
    assert got == dict(zip(values, [None, *values[:-1]], strict=True))


def splits_of(spark, counts, **kw):
    rows = [(pid, pid * 10 + j) for pid, n in counts.items() for j in range(n)]
    labelled = spark.createDataFrame(rows, "subject_id long, hadm_id long")
    return {r["subject_id"]: r["split"] for r in sp.assign_splits(labelled, **kw).collect()}


def test_split_of_written_cases(spark):
    """A patient goes where its predecessors leave room; a share may be overshot by one patient."""
    assert splits_of(spark, {1: 1}) == {1: "train"}
    assert splits_of(spark, {1: 1, 2: 1}) == {1: "train", 2: "train"}
    assert splits_of(spark, {5: 9, 6: 1}) == {5: "train", 6: "val"}
    assert splits_of(spark, {1: 8, 2: 1, 3: 1, 4: 1}) == {1: "train", 2: "train", 3: "val", 4: "val"}
    assert splits_of(spark, {k: 1 for k in range(1, 11)}) == {
        **{k: "train" for k in range(1, 10)}, 10: "val"}
    assert splits_of(spark, {k: 1 for k in range(1, 21)}) == {
        **{k: "train" for k in range(1, 18)}, 18: "val", 19: "val", 20: "val"}
    assert splits_of(spark, {k: 1 for k in range(1, 41)})[40] == "test"


@settings(max_examples=5, deadline=None)
@given(st.dictionaries(st.integers(1, 10**6), st.integers(1, 6), min_size=1, max_size=300))
def test_split_properties(spark, counts):
    got = splits_of(spark, counts, bucket_width=1000)
    assert set(got) == set(counts)
    order = [got[p] for p in sorted(counts)]
    assert order == sorted(order, key=sp.SPLITS.index)  # the splits follow each other along the ids
    total = sum(counts.values())
    for name, share in (("train", 0.8), ("val", 0.1)):
        own = [counts[p] for p in sorted(counts) if got[p] == name]
        if own:
            assert sum(own[:-1]) <= share * total + 1e-9  # the last patient still found room
        if any(got[p] in sp.SPLITS[sp.SPLITS.index(name) + 1 :] for p in got):
            assert sum(own) > share * total - 1e-9  # and the next one didn't
    assert got == splits_of(spark, counts, bucket_width=7)


def test_split_disjoint_and_exhaustive(spark):
    from icdspark.plans.etl import proxy_etl

    labelled = proxy_etl(spark, "/root/testdata/sf0.01").labelled()
    adm = sp.split_admissions(labelled, sp.assign_splits(labelled))
    assert adm.count() == labelled.count()
    per = adm.groupBy("subject_id").agg(F.countDistinct("split").alias("n")).filter("n > 1").count()
    assert per == 0
    sizes = {r["split"]: r["n"] for r in adm.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert set(sizes) <= {"train", "val", "test"} and sizes["train"] >= 0.8 * sum(sizes.values())


def test_depth_buckets_are_monotone_and_even(spark):
    from icdspark.operators import running as ru

    rng = random.Random(4)
    values = [rng.choice([rng.random() * 1e-9, 5 + rng.random(), -1e6 * rng.random()]) for _ in range(30_000)] + [7.0] * 50
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for slices in (1, 8):
        got = sorted((r["v"], r[ru.BUCKET]) for r in ru.depth_bucket("v", 64, slices)(df).collect())
        assert [b for _, b in got] == sorted(b for _, b in got)
        shares = [0] * 64
        for _, b in got:
            shares[b // slices] += 1
        assert max(shares) <= 2 * len(values) / 64
    out = running_sum(spark.range(500).select(F.col("id").cast("double").alias("v")), ["v"], {"n": F.lit(1)}, ru.depth_bucket("v", 16, 4))
    assert {r["v"]: r["n"] for r in out.collect()} == {float(k): k + 1 for k in range(500)}
    assert running_sum(df.limit(0), ["v"], {"n": F.lit(1)}, ru.depth_bucket("v")).count() == 0


def test_word_buckets_spread_words_with_one_beginning(spark):
    from icdspark.operators import running as ru

    words = [f"https://{k:07d}" for k in range(40_000)] + ["", "a", "z"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = sorted((r["w"], r[ru.BUCKET]) for r in ru.word_bucket("w", 64)(df).collect())
    assert [b for _, b in got] == sorted(b for _, b in got)
    sizes = {}
    for _, b in got:
        sizes[b] = sizes.get(b, 0) + 1
    assert len(sizes) == 64 and max(sizes.values()) <= 2 * len(words) / 64
    ranked = row_number(df, ["w"], ru.word_bucket("w", 64), "n").collect()
    assert {r["w"]: r["n"] for r in ranked} == {w: k + 1 for k, w in enumerate(sorted(words))}
