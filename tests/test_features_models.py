"""Dictionary merge, indexes, encoding, Word2Vec properties, streaming."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from icdspark.operators import embeddings as em
from icdspark.operators import features as fe
from icdspark.operators import model as mo


def test_merge_code_descriptions(spark):
    diag = [(1, "4019", "d1"), (2, "401.9", "d2"), (3, "12", "d3"), (4, "E8790", "d4"), (5, "38", "d5")]
    proc = [(1, "12", "p1"), (2, "3893", "p2"), (3, "38.93", "p3"), (4, "38.93", "p4"), (5, "1", "p5"),
            (6, "1.", "p6"), (7, "45.1", "p7"), (8, "451", "p8"), (9, "45.1", "p9"), (10, "38", "p10")]
    text = [(1, "401.9", "t1 a"), (2, "999", "t2"), (3, "999", "t3"), (4, "38.93", "t4"), (5, "E879.0", "t5")]
    expected = {
        "401.9": "d2",   # both spellings of a diagnosis, the later row
        "12": "d3",      # a procedure whose raw code is a diagnosis is skipped
        "E879.0": "d4",  # a text entry only fills a gap
        "38": "d5",      # as above; p10 is skipped too
        "38.93": "p2",   # dotted later rows find their own code taken
        "1.": "p5",
        "45.1": "p8",    # p7 first, p8 by another spelling replaces it, p9 finds its code taken
        "999": "t2",     # of two text entries the first
    }
    sch = "pos long, code string, description string"
    got = fe.merge_code_descriptions(*(spark.createDataFrame(x, sch) for x in (diag, proc, text)))
    assert {r["code"]: r["description"] for r in got.collect()} == expected


def test_label_index_dense_sorted(spark):
    lab = spark.createDataFrame([(1, 1, "t", "b;a;"), (1, 2, "t", "c;b")], "subject_id long, hadm_id long, text string, labels string")
    rows = fe.label_index(lab).orderBy("idx").collect()
    assert [(r["label"], r["idx"]) for r in rows] == [("a", 0), ("b", 1), ("c", 2)]


DOC_SCHEMA = "subject_id long, hadm_id long, text string, labels string"


def test_encode_documents(spark):
    docs = spark.createDataFrame([(7, 1, "x y  z x", "a;q"), (7, 2, "y", "q"), (7, 3, "", "a")], DOC_SCHEMA)
    labels = spark.createDataFrame([("a", 0), ("b", 1)], "label string, idx long")
    words = spark.createDataFrame([("x", 5, 1), ("y", 4, 2)], "word string, count long, idx long")
    enc = {r["hadm_id"]: r for r in fe.encode_documents(docs, labels, words, 2).collect()}
    assert set(enc) == {1, 3}  # doc 2 has no known label (b08)
    assert enc[1]["word_ids"] == [1, 2, 3, 1] and enc[1]["label_ids"] == [0]
    assert enc[3]["word_ids"] == []


def test_admissions_with_the_same_id_stay_apart(spark):
    docs = spark.createDataFrame([(1, 10, "a b c", "x"), (2, 10, "c b", "y")], DOC_SCHEMA).withColumn("tlen", F.lit(2))
    labels = spark.createDataFrame([("x", 0), ("y", 1)], "label string, idx long")
    words = spark.createDataFrame([("a", 5, 1), ("b", 4, 2), ("c", 3, 3)], "word string, count long, idx long")
    enc = fe.encode_documents(docs, labels, words, 3, carry=("tlen",))
    got = {r["subject_id"]: (r["word_ids"], r["label_ids"]) for r in enc.collect()}
    assert got == {1: ([1, 2, 3], [0]), 2: ([3, 2], [1])}
    batched = {r["subject_id"]: r for r in fe.batch_and_pad(enc, 2, "tlen").collect()}
    assert batched[1]["position"] == 0 and batched[2]["position"] == 1 and batched[2]["padded"] == [3, 2, 0]
    emb = spark.createDataFrame([(k, [float(k)]) for k in (1, 2, 3)], "idx long, vector array<double>")
    assert {r["subject_id"]: r["pooled"] for r in em.max_pool(enc, emb).collect()} == {1: [3.0], 2: [3.0]}


def test_batches_of_huge_ids(spark):
    """Ids beyond 2^40 and equal lengths keep their order."""
    rows = [(1, (1 << 40) + 1, 5), (1, 1, 6), (1, 2, 5), (1, 3, 5)]
    df = spark.createDataFrame(rows, "subject_id long, hadm_id long, n long")
    got = [r["hadm_id"] for r in fe.batch_ids(df, 2, "n").orderBy("position").collect()]
    assert got == [2, 3, (1 << 40) + 1, 1]


def test_word2vec_vocab_and_mean_vector(spark):
    train = spark.createDataFrame([("a b  a c",)] * 3, "text string")
    model = em.fit_word2vec(train, vector_size=5, min_count=3, seed=1)
    vecs = {r["word"]: r["vector"] for r in em.word_vectors(model).collect()}
    assert set(vecs) == {"", "a", "b", "c"}
    assert set(vecs) == {r["word"] for r in fe.vocabulary(train).collect()}
    docs = spark.createDataFrame([(5, 1, "a zzz zzz"), (5, 2, "zzz")], "subject_id long, hadm_id long, text string")
    dv = {r["hadm_id"]: r["doc_vector"] for r in em.document_vectors(model, docs).collect()}
    assert all(abs(x - y / 3) < 1e-6 for x, y in zip(dv[1], vecs["a"]))
    assert dv[2] == [0.0] * 5


def test_word2vec_trains_in_several_tasks(spark):
    train = spark.createDataFrame([(f"a b c d{i % 7} e",) for i in range(60)], "text string")
    model = em.fit_word2vec(train, vector_size=5)
    assert model.getNumPartitions() == em.NUM_PARTITIONS > 1
    again = em.fit_word2vec(train, vector_size=5, num_partitions=1)
    assert {r["word"] for r in em.word_vectors(model).collect()} == {r["word"] for r in em.word_vectors(again).collect()}


def test_word2vec_save_load(spark, tmp_dir):
    train = spark.createDataFrame([("a b a b a b",)], "text string")
    model = em.fit_word2vec(train, vector_size=3, min_count=1, seed=1)
    path = os.path.join(tmp_dir, "w2v")
    em.save_model(model, path)
    assert em.load_model(path).getVectors().count() == 2


def test_embedding_table_and_pool(spark):
    widx = spark.createDataFrame([("a", 3, 1), ("b", 3, 2)], "word string, count long, idx long")
    vecs = spark.createDataFrame([("a", [3.0, 4.0]), ("b", [0.0, 2.0])], "word string, vector array<double>")
    table = {r["idx"]: r["vector"] for r in em.embedding_table(widx, vecs, 2).collect()}
    assert set(table) == {0, 1, 2, 3} and table[0] == [0.0, 0.0]
    assert abs(table[1][0] - 3 / (5 + 1e-6)) < 1e-12
    docs = spark.createDataFrame([(5, 1, [1, 2, 1])], "subject_id long, hadm_id long, word_ids array<long>")
    emb = spark.createDataFrame([(1, [1.0, -1.0]), (2, [0.0, 5.0])], "idx long, vector array<double>")
    assert em.max_pool(docs, emb).first()["pooled"] == [1.0, 5.0]
    unknown = spark.createDataFrame([(5, 1, [1, 9])], "subject_id long, hadm_id long, word_ids array<long>")
    with pytest.raises(Exception, match="no vector for id 9"):
        em.max_pool(unknown, emb).collect()


def test_label_models_learn_all_labels_together(spark):
    rng = np.random.RandomState(3)
    x = rng.randn(300, 4)
    y = np.stack([x[:, 0] > 0, x[:, 1] + x[:, 2] > 0.5, np.zeros(300, bool)], 1)
    rows = [(1, i, x[i].tolist(), [int(j) for j in np.flatnonzero(y[i])]) for i in range(300)]
    feats = spark.createDataFrame(rows, "subject_id long, hadm_id long, pooled array<double>, label_ids array<long>")
    models = mo.fit_label_models(feats, 3, iterations=60)
    got = {r["label"]: r for r in models.collect()}
    gradient = ((0.5 - y).T @ np.column_stack([x, np.ones(300)])) / 300
    for j in range(3):
        assert abs(got[j]["first_loss"] - np.log(2)) < 1e-12
        assert abs(got[j]["first_gradient"] - np.linalg.norm(gradient[j])) < 1e-12
        assert got[j]["loss"] < got[j]["first_loss"]
    assert got[2]["skipped"] and got[2]["weights"] is None and not got[0]["skipped"]
    scores = mo.linear_scores(feats, models, block_cells=4)  # a block for each label
    right = {(r["hadm_id"], r["label"]): r["score"] > 0.5 for r in scores.collect()}
    assert len(right) == 600
    assert np.mean([right[i, j] == y[i, j] for i in range(300) for j in (0, 1)]) > 0.9
    assert mo.linear_scores(feats, models, min_score=0.5).count() == sum(right.values())


def test_streaming_notes(spark, tmp_dir):
    from icdspark.streaming import stream_tokenized_notes, write_stream

    src = os.path.join(tmp_dir, "in")
    spark.createDataFrame(
        [(1, 10, 100, "Discharge summary", "Hello, World!"), (2, 10, 100, "Nursing", "skip")],
        "row_id long, subject_id long, hadm_id long, category string, text string",
    ).write.parquet(src)
    stream = stream_tokenized_notes(spark, src, "row_id long, subject_id long, hadm_id long, category string, text string")
    q = write_stream(stream, os.path.join(tmp_dir, "out"), "notes_test")
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(tmp_dir, "out")).collect()
    assert [(r["row_id"], r["text"]) for r in out] == [(1, "hello world")]


def test_class_weights_strict_missing_label_raises(spark):
    freq = spark.createDataFrame([("a", 3), ("zz", 1)], "label string, frequency long")
    idx = spark.createDataFrame([("a", 0)], "label string, idx long")
    with pytest.raises(Exception, match="unknown label"):
        fe.class_weights(freq, idx).collect()
    ok = fe.class_weights(freq.filter("label = 'a'"), idx).collect()
    assert [(r["idx"], r["weight"]) for r in ok] == [(0, 0.0)]


def _order(spark, n, seed, partitions=4):
    df = spark.createDataFrame([(i % 3, 5 * i) for i in range(n)], "subject_id long, hadm_id long").repartition(partitions)
    rows = fe.shuffled_batch_ids(df, 32, seed).collect()
    assert sorted(r["position"] for r in rows) == list(range(n)) and all(r["batch"] == r["position"] // 32 for r in rows)
    return [r["hadm_id"] for r in sorted(rows, key=lambda r: r["position"])]


def test_epochs_are_different_permutations(spark):
    n = 1500
    first, again, other, far = (_order(spark, n, 1), _order(spark, n, 1, 7), _order(spark, n, 2), _order(spark, n, 12345))
    assert first == again and first != sorted(first)
    pairs = lambda order: {frozenset(p) for p in zip(order, order[1:], strict=False)}
    for a, b in ((first, other), (first, far), (other, far), (first, sorted(first))):
        assert len(pairs(a) & pairs(b)) < 15  # two are expected by chance
        assert sum(x == y for x, y in zip(a, b, strict=True)) < 15  # one is


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 6, 97])
def test_small_epochs_are_permutations(spark, n):
    assert len(_order(spark, n, 3)) == n


def test_words_are_looked_up_once_a_document(spark):
    docs = spark.createDataFrame([(7, 1, "x y x  q x y", "a"), (7, 2, "", "a"), (8, 1, "q", "a")], DOC_SCHEMA)
    words = spark.createDataFrame([("x", 5, 1), ("y", 4, 2)], "word string, count long, idx long")
    got = {(r["subject_id"], r["hadm_id"]): r["word_ids"] for r in fe.doc_word_ids(docs, words, 2).collect()}
    assert got == {(7, 1): [1, 2, 1, 3, 1, 2], (8, 1): [3]}
    cut = fe.doc_word_ids(docs, words, 2, max_len=2).filter("subject_id = 7").first()
    assert cut["word_ids"] == [1, 2]


def test_pools_from_distinct_ids(spark):
    rng = np.random.RandomState(5)
    table = {k: rng.randn(3) for k in range(1, 6)}
    docs = {(1, d): [int(x) for x in rng.randint(1, 6, rng.randint(0, 30))] for d in range(20)}
    ids = spark.createDataFrame([(*k, v) for k, v in docs.items()], "subject_id long, hadm_id long, word_ids array<long>")
    emb = spark.createDataFrame([(k, v.tolist()) for k, v in table.items()], "idx long, vector array<double>")
    sums = {(r["subject_id"], r["hadm_id"]): (r["n_tokens"], r["sums"]) for r in em.sum_pool(ids, emb).collect()}
    most = {(r["subject_id"], r["hadm_id"]): r["pooled"] for r in em.max_pool(ids, emb).collect()}
    assert set(sums) == set(most) == {k for k, v in docs.items() if v}
    for k, (n, total) in sums.items():
        rows = np.array([table[i] for i in docs[k]])
        assert n == len(rows) and np.allclose(total, rows.sum(0)) and np.allclose(most[k], rows.max(0))
    with pytest.raises(Exception, match="no vector for id 9"):
        em.sum_pool(spark.createDataFrame([(1, 1, [9])], "subject_id long, hadm_id long, word_ids array<long>"), emb).collect()


def test_mean_vectors_equal_the_model(spark):
    train = spark.createDataFrame([("a b  a c",)] * 3, "text string")
    model = em.fit_word2vec(train, vector_size=5, min_count=3, seed=1)
    docs = spark.createDataFrame(
        [(5, 1, "a zzz zzz a"), (5, 2, "zzz"), (5, 3, " b"), (6, 1, "")], "subject_id long, hadm_id long, text string")
    own = {(r[0], r[1]): r["doc_vector"] for r in em.document_vectors(model, docs).collect()}
    got = {(r[0], r[1]): r["doc_vector"] for r in em.mean_vectors(docs, em.word_vectors(model), 5).collect()}
    assert set(own) == set(got) and all(np.allclose(own[k], got[k], atol=1e-6) for k in own)


def _brute_fit(x, y, iterations, reg=0.0):
    x = np.column_stack([x, np.ones(len(x))])
    step = 1.0 / (0.25 * (x * x).sum(1).max() + reg)
    w = ahead = np.zeros((y.shape[1], x.shape[1]))
    for k in range(iterations):
        g = (1 / (1 + np.exp(-(x @ ahead.T))) - y).T @ x / len(x)
        moved = ahead - step * (g + reg * ahead)
        ahead, w = moved + k / (k + 3.0) * (moved - w), moved
    return w


def test_label_models_equal_a_brute_force_fit(spark):
    rng = np.random.RandomState(8)
    x = rng.randn(2500, 3)
    y = np.stack([x[:, 0] > 0.3, x[:, 1] > 0, np.ones(2500, bool)], 1)
    rows = [(1, i, x[i].tolist(), [int(j) for j in np.flatnonzero(y[i])]) for i in range(2500)]
    feats = spark.createDataFrame(rows, "subject_id long, hadm_id long, pooled array<double>, label_ids array<long>").repartition(7)
    want = _brute_fit(x, y.astype(float), 12, 0.01)
    for partials in (1, 3, 64):
        got = {r["label"]: r for r in mo.fit_label_models(feats, 3, iterations=12, reg_param=0.01, partials=partials).collect()}
        for j in (0, 1):
            assert np.allclose(got[j]["weights"] + [got[j]["bias"]], want[j], atol=1e-10)
        assert got[2]["skipped"]


def test_top_k_scores_equal_the_dense_top_k(spark):
    rng = np.random.RandomState(6)
    x, w, b = rng.randn(60, 4), rng.randn(900, 4) * rng.rand(900, 1) ** 3, rng.randn(900) * 0.1
    w[7], b[7] = w[8], b[8]  # a tie, which the higher label wins
    feats = spark.createDataFrame([(1, i, v.tolist()) for i, v in enumerate(x)], "subject_id long, hadm_id long, pooled array<double>")
    models = spark.createDataFrame(
        [(j, w[j].tolist(), float(b[j]), j == 3) for j in range(900)], "label long, weights array<double>, bias double, skipped boolean")
    z = x @ w.T + b
    z[:, 3] = -np.inf
    for cells in (1_000_000, 400):
        got = mo.top_k_scores(feats, models, 5, block_cells=cells).collect()
        assert len(got) == 300
        for i in range(60):
            own = sorted((r for r in got if r["hadm_id"] == i), key=lambda r: r["rank"])
            order = sorted(range(900), key=lambda j: (-z[i, j], -j))[:5]
            assert [r["label"] for r in own] == order and np.allclose([r["logit"] for r in own], z[i, order])
    few = mo.top_k_scores(feats, models.limit(2), 5).filter("hadm_id = 0").count()
    assert few == 2 and mo.top_k_scores(feats, models.limit(0), 5).count() == 0


def _merged_row_by_row(diag, proc, text):
    """The three steps as the original takes them."""
    dot = lambda c, n: c.replace(".", "")[:n] + "." + c.replace(".", "")[n:]
    out = {}
    for _, c, t in diag:
        plain = c.replace(".", "")
        n = 4 if plain.startswith("E") else 3
        out[dot(c, n) if len(plain) > n else plain] = t
    taken = set(out)
    for _, c, t in proc:
        if c not in taken and c not in out:
            out[dot(c, 2)] = t
    for _, c, t in text:
        out.setdefault(c, t)
    return out


def test_descriptions_merge_in_one_grouping(spark):
    rng = np.random.RandomState(4)
    draw = lambda: "".join(rng.choice(list("12."), rng.randint(1, 5)))
    diag, proc, text = ([(i, draw(), f"{kind}{i}") for i in range(120)] for kind in "dpt")
    sch = "pos long, code string, description string"
    got = fe.merge_code_descriptions(*(spark.createDataFrame(x, sch).repartition(3) for x in (diag, proc, text)))
    rows = got.collect()
    assert {r["code"]: r["description"] for r in rows} == _merged_row_by_row(diag, proc, text) and len(rows) == len({r["code"] for r in rows})
    plan = got._jdf.queryExecution().executedPlan().toString()
    joins = {line.split("Join")[0].split()[-1] for line in plan.split("Initial Plan")[-1].split("\n") if "Join" in line}
    assert len([line for line in plan.split("Initial Plan")[-1].split("\n") if "Join" in line]) == 1, (joins, plan)


def test_lists_meet_vectors_over_shards_and_groups(spark):
    """Ids of many shards, several groups a shard, repeated and null keys, an id with two vectors."""
    from functools import partial

    from icdspark.operators import shards

    rng = np.random.RandomState(7)
    ids = [1, 5, 4095, 4096, 20_000, 65_536, 131_071, 131_072, 900_000]
    table = [(k, rng.randn(3).tolist()) for k in [*ids, 5]]
    docs = [(1, d, [int(x) for x in rng.choice(ids, rng.randint(0, 9))]) for d in range(40)] + [(1, 0, [5, 5]), (None, 3, [1, 900_000]), (2, 2, None)]
    lists = spark.createDataFrame(docs, "subject_id long, hadm_id long, word_ids array<long>").repartition(3)
    emb = spark.createDataFrame(table, "idx long, vector array<double>").repartition(2)
    want = {}
    for a, b, own in docs:
        for x in own or ():
            want.setdefault((a, b), []).extend(v for k, v in table if k == x)
    for reduce, brute in ((np.add, lambda r: np.sum(r, 0)), (np.maximum, lambda r: np.max(r, 0))):
        parts = shards.meet(lists, emb, fe.KEYS, "word_ids", partial(shards.pooled_lists, reduce=reduce), "n bigint, part array<double>", reduce, group_ids=7)
        got = {}
        for r in parts.collect():
            got.setdefault((r[0], r[1]), []).append((r["n"], r["part"]))
        assert set(got) == set(want)
        for k, rows in want.items():
            assert sum(n for n, _ in got[k]) == len(rows) and np.allclose(brute([v for _, v in got[k]]), brute(rows))
    tokens = sorted(((r[0] is None, r[0] or 0, r[1]), r["pos"], r["idx"], r["vector"]) for r in em.token_vectors(lists, emb).collect())
    assert tokens == sorted(((a is None, a or 0, b), pos, x, v) for a, b, own in docs for pos, x in enumerate(own or ()) for k, v in table if k == x)


def test_rare_words_are_looked_up_apart(spark, monkeypatch):
    """Frequent words by a small table, the others by a join: the same ids, whatever their share."""
    rng = np.random.RandomState(2)
    words = spark.createDataFrame([(f"w{k}", 9, k) for k in range(1, 9)], "word string, count long, idx long")
    texts = {d: [f"w{k}" for k in rng.randint(1, 12, d % 7)] for d in range(30)}
    docs = spark.createDataFrame([(1, d, "  ".join(t), "a") for d, t in texts.items()] + [(1, 6, "w1 w9", "a")], DOC_SCHEMA)
    index = {f"w{k}": k for k in range(1, 9)}
    for head in (0, 3, 100):
        monkeypatch.setattr(fe, "HEAD_WORDS", head)
        for partitions in (None, 3):
            got = {r["hadm_id"]: r["word_ids"] for r in fe.doc_word_ids(docs, words, 8, partitions=partitions).collect()}
            assert set(got) == {d for d, t in texts.items() if t}
            assert all(got[d] == [index.get(w, 9) for w in t] for d, t in texts.items() if t and d != 6)
            both = sorted([(p, index.get(w, 9)) for p, w in enumerate(texts[6])] + [(0, 1), (1, 9)])
            assert got[6] == [i for _, i in both]  # two rows of one document


def test_multi_hot_in_runs(spark):
    from icdspark.functions.arrays import multi_hot

    rows = [([],), ([0],), ([4],), ([0, 4],), ([3, 1, 1],), ([7, -1, 2],), (None,)]
    df = spark.createDataFrame(rows, "ids array<long>")
    got = df.select(multi_hot("ids", 5).alias("v"), multi_hot("ids", 5, text=True).alias("t")).collect()
    for (ids,), r in zip(rows[:-1], got, strict=False):
        assert r["v"] == [int(i in ids) for i in range(5)] and r["t"] == "".join(map(str, r["v"]))
    wide = df.limit(2).select(multi_hot("ids", 2_000_000, text=True).alias("t")).collect()
    assert [r["t"].count("1") for r in wide] == [0, 1] and all(len(r["t"]) == 2_000_000 for r in wide)
