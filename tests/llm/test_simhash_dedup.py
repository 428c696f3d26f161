import random
import re

import numpy as np
import xxhash

from icdspark.llm import simhash_dedup as sh
from icdspark.llm.common import work_folder
from icdspark.llm.components import connected
from icdspark.llm.queries import op1_simhash_dedup

SF = "/root/testdata/sf0.001"


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(prints, bits=3):
    """Smallest id reachable, by comparing all pairs."""
    ids = list(prints)
    label = {i: i for i in ids}
    values = np.array([prints[i] for i in ids], np.uint64)
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= bits) for v in values]
    changed = True
    while changed:
        changed = False
        for a, i in enumerate(ids):
            least = min(label[ids[b]] for b in near[a])
            if least < label[i]:
                label[i], changed = least, True
    return label


def test_query_equals_brute_force(spark, texts):
    rows = {r["doc_id"]: r for r in op1_simhash_dedup(spark, SF).collect()}
    prints = {i: plain_print(t) for i, t in texts.items()}
    assert {i: r["fingerprint"] for i, r in rows.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in rows.items()} == plain_components(prints)


def test_spark_hash_is_the_same_hash(spark):
    value = spark.sql("SELECT xxhash64('a b c') AS x").first()["x"]
    assert value % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


def near_prints(n, seed=5):
    """Fingerprints around a few centres, so that buckets are large and chains long."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(3)] + [0, (1 << 64) - 1]
    out = {0, 7, (1 << 63) | 1}
    while len(out) < n:
        value = rng.choice(centres)
        for b in rng.sample(range(64), rng.randint(0, 5)):
            value ^= 1 << b
        out.add(value)
    return sorted(out)


def links_equal_brute_force(spark, bucket_rows, bits):
    values = near_prints(600)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(s, i) for i, s in enumerate(signed)], "f long, first long")
    folder = work_folder(spark)
    pairs = sh.links(prints, folder, max_bits=bits, bucket_rows=bucket_rows)
    found = pairs.collect()
    assert all((a ^ b).bit_count() <= bits for a, b in ((r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in found))
    label = connected(pairs, prints.withColumnsRenamed({"f": "node", "first": "label"}), folder)
    got = {r["node"]: r["label"] for r in label.collect()}
    expected = plain_components(dict(enumerate(values)), bits)
    assert got == {signed[i]: c for i, c in expected.items()}


def test_links_lose_nothing(spark):
    links_equal_brute_force(spark, sh.BUCKET_ROWS, 3)


def test_links_lose_nothing_when_every_bucket_is_cut_again(spark):
    links_equal_brute_force(spark, 1, 3)


def test_links_with_fewer_bits(spark):
    links_equal_brute_force(spark, 8, 1)


def test_forest_is_linear():
    values = np.array([v - (1 << 64) if v >> 63 else v for v in near_prints(300)], np.int64)
    assert len(sh.forest(values, 64)) == len(values) - 1


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(500)], "a long, b long")
    nodes = spark.createDataFrame([(i, 1000 + i) for i in range(503)], "node long, label long")
    got = {r["node"]: r["label"] for r in connected(links, nodes, work_folder(spark)).collect()}
    assert got == {i: 1000 if i <= 500 else 1000 + i for i in range(503)}


def test_odd_rows(odd_docs):
    rows = sh.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert all(by[i][0]["f"] == 0 and by[i][0]["component_id"] == 1 for i in (1, 2, 3, 12))
    assert by[7][0]["component_id"] == by[8][0]["component_id"] == 7
    assert [r["component_id"] for r in by[9]] == [9, 9]
    assert {r["component_id"] for r in by[None]} == {None, 1}  # the null text joins the empty ones


def test_empty_table(no_docs):
    assert sh.near_duplicates(no_docs).collect() == []
    assert sh.keep_first(no_docs).columns == no_docs.columns


def test_keep_first(odd_docs):
    kept = sh.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    got = sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect())
    ids = [i for i, _ in got]
    assert ids.count(9) == 1 and ids.count(7) == 1 and 8 not in ids and 2 not in ids and 3 not in ids
    assert ids.count(-1) == 1  # the row without an id is alone in its component; the null text's isn't


def test_repeated_id_with_other_text(make):
    rows = [(1, "a b c d"), (1, "a b c d "), (2, "a b c d"), (3, "quite another text")]
    got = sh.keep_first(make(rows)).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 3]


def test_an_id_repeated_over_unrelated_texts_is_first_in_each_group(make):
    rows = [(1, "a b c d"), (1, "quite another text of its own"), (1, "quite another text of its own"),
            (2, "a b c d"), (3, "quite another text of its own"), (None, "quite another text of its own")]
    got = sh.keep_first(make(rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, "a b c d"), (1, "quite another text of its own")]
