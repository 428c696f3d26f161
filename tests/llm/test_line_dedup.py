import random
import re

import pytest

from icdspark.llm import line_dedup as ld
from icdspark.llm.queries import op7_line_dedup

SF = "/root/testdata/sf0.001"


def plain(rows, least=50):
    """Every passage of enough words, wherever it begins and ends, looked up in all earlier places."""
    first, out = {}, {}
    for i, text in sorted(rows):
        lines = [x.split() for x in re.split("\n", text or "")]
        words = [w for line in lines for w in line]
        gone = set()
        for a in range(len(words) - least + 1):
            if first.setdefault(tuple(words[a : a + least]), (i, a)) != (i, a):
                gone.update(range(a, a + least))
        at, out[i] = 0, []
        for line in lines:
            left_ = [w for k, w in enumerate(line, at) if k not in gone]
            at += len(line)
            out[i] += [" ".join(left_)] * bool(left_)
    return out


def left(df):
    return {r["doc_id"]: [" ".join(x.split()) for x in r["text"].split("\n") if x.split()] for r in df.collect()}


def test_query_equals_brute_force(spark, texts):
    got = op7_line_dedup(spark, SF)
    assert got.count() == len(texts)
    assert left(got) == plain(texts.items())


def words(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_runs_are_found_whatever_their_lines(make):
    shared = [words("s", 30), words("t", 5), words("u", 30), words("v", 4)]
    rows = [
        (1, "\n".join([words("a", 9), *shared, words("b", 9)])),
        (2, "\n".join([words("c", 40), shared[0], words("d", 40)])),  # a part that is too short
        (3, "\n".join([words("e", 9), "", *shared, words("f", 9)])),  # the run starts and ends inside
        (4, words("z", 51)), (5, "  " + words("z", 51) + "\t\n" + words("y", 3)),
        (6, "\n".join([words("q", 60), words("r", 3), words("q", 60)])),  # repeated in itself
    ]
    got = left(ld.dedup_lines(make(rows)))
    assert got == plain(rows)
    assert got[3] == [words("e", 9), words("f", 9)] and got[5] == [words("y", 3)]
    assert got[6] == [words("q", 60), words("r", 3)] and len(got[2]) == 3


def test_first_place_with_other_neighbours_hides_nothing(make):
    """A line's first place may stand among other lines than the repeated run."""
    x, y, z = words("x", 25), words("y", 25), words("z", 25)
    rows = [(1, f"{x}\n{z}"), (2, f"{words('k', 30)}\n{x}\n{y}"), (3, f"{words('m', 30)}\n{x}\n{y}")]
    assert left(ld.dedup_lines(make(rows))) == plain(rows)
    assert left(ld.dedup_lines(make(rows)))[3] == [words("m", 30)]


def test_short_common_lines_stay(make):
    rows = [(i, f"read more\n{words(f'd{i}_', 60)}\nread more") for i in range(30)]
    assert left(ld.dedup_lines(make(rows))) == plain(rows)


def test_passages_inside_lines(make):
    """A passage that begins and ends in the middle of lines, and one in a single line."""
    shared = words("s", 30) + "\n" + words("t", 40)
    rows = [(1, f"{words('a', 20)} {shared} {words('b', 20)}"), (2, f"{words('c', 9)} {shared} {words('d', 9)}"),
            (3, f"{words('e', 5)} {words('t', 40)} {words('f', 5)}"), (4, f"{words('g', 70)} {words('b', 20)}"),
            (5, f"{words('h', 3)} {words('g', 70)} {words('i', 3)}")]
    got = left(ld.dedup_lines(make(rows)))
    assert got == plain(rows)
    assert got[2] == [words("c", 9), words("d", 9)] and got[5] == [f"{words('h', 3)} {words('i', 3)}"] and len(got[3]) == 1


@pytest.mark.parametrize("least", [1, 2, 10, 20, 33])
def test_any_length_of_passage(make, least):
    """Words of which many are equal, so that grams tie, overlap and repeat in themselves."""
    rng = random.Random(least)
    parts = [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(8)]
    rows = [(i, "\n".join(rng.choice(parts) if rng.random() < 0.7 else " ".join(rng.choice("abcd") for _ in range(30))
                          for _ in range(rng.randint(1, 5)))) for i in range(25)]
    out = ld.dedup_lines(make(rows), min_words=least, removed_col="n")
    assert left(out) == plain(rows, least)
    counts = {i: len(t.split()) for i, t in rows}
    assert all(counts[r["doc_id"]] == len(r["text"].split()) + r["n"] for r in out.collect())


def test_odd_rows(odd_docs):
    out = ld.dedup_lines(odd_docs, removed_col="gone_")
    assert out.columns == [*odd_docs.columns, "gone_"]
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["text"] is None and by[2][0]["text"] == "" and by[12][0]["text"] == "\n\n\n"
    assert len(by[9]) == 2 and by[11][0]["text"].count("\n") == 2999
    assert by[5][0]["text"] == "word"  # each passage but the first one begins inside an earlier, equal one
    assert ld.dedup_lines(odd_docs.limit(0)).collect() == []


def test_texts_without_words():
    """The first texts that a worker sees may have none."""
    import subprocess
    import sys

    code = ("from icdspark.llm import line_dedup as ld\n"
            "assert [len(r[0]) for r in ld.reaches_of([None, '', ' \\n', 'one'])] == [0, 0, 0, 0]\n"
            "assert ld.reaches_of([]) == [] and len(ld.reaches_of(['w ' * 60])[0][0]) > 0\n")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=60, cwd=__file__.rsplit("/tests/", 1)[0])


def test_same_id_and_text_is_one_document(make):
    text = words("w", 70)
    got = ld.dedup_lines(make([(2, text), (2, text), (3, text), (None, text)])).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == [(0, text), (2, ""), (2, ""), (3, "")]
