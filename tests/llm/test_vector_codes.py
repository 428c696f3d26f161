import hashlib

import duckdb
import numpy as np
import pytest

from icdspark.llm import queries
from icdspark.llm import vector_codes as vc

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, codes string, error string, q int, sums int"


def plain(rows, entries=16, parts=8, rounds=6):
    """Lloyd with a whole scan in every round, in Python integers."""
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(r[1]) for r in kept) // parts)
    ints = [[int(np.floor(4096 * float(x))) for x in r[1]] + [0] * (parts * width - len(r[1])) for r in kept]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in ints]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def nearest():
        return [[min((sum((a - b) ** 2 for a, b in zip(v[p], e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)]
                for v in cut]

    for _ in range(rounds):
        held = nearest()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [v[p] for v, h in zip(cut, held, strict=True) if h[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found, label = nearest(), {}
    for r, h in zip(kept, found, strict=True):
        label[r[2]] = label.get(r[2], 0) + sum(d for d, _ in h)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in h), sum(d for d, _ in h), label[r[2]], digest) for r, h in zip(kept, found, strict=True)), key=repr)


def test_query_equals_sql(spark):
    got = sorted(tuple(r) for r in queries.op11_vector_codes(spark, SF).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    assert got == sorted(con.execute(queries.oracle_sql()["op11_vector_codes"]).fetchall())


def test_odd_rows_equal_the_plain_method(spark):
    rng = np.random.default_rng(3)
    rows = [(i % 37, [float(x) for x in rng.choice([-0.5, 0.0, 0.25, 1.0 / 3, 2.0], 16)], [None, 1, 2][i % 3]) for i in range(120)]
    rows += [(None, [0.1] * 16, 1), (200, None, 1), (201, [None] + [0.0] * 15, 1), (202, [float("nan")] * 16, 2),
             (203, [float("inf")] + [0.0] * 15, None), (204, [-0.3] * 9, 1), (205, [], 2)] + [(300, [0.7] * 16, None)] * 40
    rows = [(i, v and [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    df = spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA).repartition(5)
    assert sorted((tuple(r) for r in vc.report(df).collect()), key=repr) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, 2)], [(1, [float("nan")], 2)]])
def test_no_usable_rows(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA)
    assert vc.report(df).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert vc.report(df).count() == 0


def test_few_and_huge_vectors(spark):
    df = spark.createDataFrame([(1, [3e38, -3e38] * 8, 1, "", "", 1, 2), (2, [0.0] * 16, 1, "", "", 1, 2)], SCHEMA)
    coded, books = vc.compress(df)
    assert books.shape == (8, 2, 2) and {r["error"] for r in coded.collect()} == {0}


def test_active_entries_equal_whole_scans():
    rng = np.random.default_rng(1)
    q = rng.integers(-4, 5, (400, 3, 2))
    books = rng.integers(-4, 5, (3, 8, 2))
    codes, distances = vc.assign(q, books)
    for _ in range(8):
        moved = rng.random((3, 8)) < 0.3
        books = np.where(moved[:, :, None], rng.integers(-4, 5, books.shape), books)
        vc.reassign(q, books, moved, codes, distances)
        whole = vc.assign(q, books)
        assert (codes == whole[0]).all() and (distances == whole[1]).all()


def test_decompressed_vectors_have_the_error(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    coded, books = vc.compress(vectors)
    given = {r["vec_id"]: np.floor(4096 * np.array(r["embedding"], float)) for r in vectors.collect()}
    for r in vc.decompress(coded, books).collect():
        assert int(((given[r["vec_id"]] - 4096 * np.array(r["vector"])) ** 2).sum()) == r["error"]
