import random

from icdspark.llm import decontaminate as dc
from icdspark.llm.queries import op5_decontaminate

SF = "/root/testdata/sf0.001"


def edit_distance_inside(pattern, text):
    """Smallest number of edits from the pattern to some part of the text (full table)."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        before, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(before[j - 1] + (p != t), before[j] + 1, row[j - 1] + 1))
    return min(row)


def test_myers_equals_the_full_table():
    rng = random.Random(2)
    for _ in range(60):
        pattern = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("ab c") for _ in range(rng.randint(0, 120)))
        assert dc.Item(1, pattern, 0.1).best(text)[0] == edit_distance_inside(pattern, text)


def test_query_equals_brute_force(spark, texts):
    items = {r["item_id"]: dc.normal(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]) for r in op5_decontaminate(spark, SF).collect()}
    small = {i: dc.normal(t) for i, t in texts.items()}
    held = {(i, k) for i, t in small.items() for k, x in items.items() if x in t}
    assert held <= got
    for i, k in got - held:
        assert edit_distance_inside(items[k], small[i]) <= int(dc.ERROR_RATE * len(items[k]))


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.choice("sid")
        if kind == "s":
            chars[at] = "#"
        elif kind == "i":
            chars.insert(at, "#")
        else:
            del chars[at]
    return "".join(chars)


def test_all_edits_within_the_budget_are_found(make):
    rng = random.Random(9)
    item = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(40))
    budget = int(dc.ERROR_RATE * len(item))
    rows, expected = [], set()
    for i in range(60):
        edits = rng.randint(0, budget + 6)
        text = edited(rng, item, edits)
        rows.append((i, f"some words before {text} and after"))
        if edit_distance_inside(item, dc.normal(rows[-1][1])) <= budget:
            expected.add(i)
    bench = make([(1, item)], "item_id long, text string")
    got = dc.find_leaks(make(rows), bench).collect()
    assert {r["doc_id"] for r in got} == expected and 20 < len(expected) < 60
    text = {i: dc.normal(t) for i, t in rows}
    assert all(r["distance"] == edit_distance_inside(item, text[r["doc_id"]]) for r in got)


def test_case_and_space_don_t_hide_an_item(make):
    item = "The quick brown fox jumps over the lazy dog near the river bank"
    rows = [(1, item.upper().replace(" ", "\n  ")), (2, "The quick brown fox jumps over")]
    assert [r["doc_id"] for r in dc.find_leaks(make(rows), make([(7, item)], "item_id long, text string")).collect()] == [1]


def test_blocks_give_the_same(make):
    items = [(k, " ".join(f"w{k}x{j}" for j in range(12))) for k in range(20)]
    rows = [(i, f"before {items[i % 20][1]} after") for i in range(40)]
    bench = make(items, "item_id long, text string")
    one = dc.find_leaks(make(rows), bench).collect()
    many = dc.find_leaks(make(rows), bench, block_chars=300).collect()
    assert sorted(one) == sorted(many) and len(one) == 40


def test_short_items_match_exactly_and_as_whole_words(make):
    bench = make([(1, "Who wrote Hamlet?"), (2, "red  fox"), (3, " "), (4, "é")], "item_id long, text string")
    rows = [(1, "asked: who wrote\nhamlet? then"), (2, "who wrote hamlets?"), (3, "a hundred fox"), (4, "a redfox; red foxes, a (RED FOX)."),
            (5, "red foxes"), (6, "red fix"), (7, "café"), (8, "é")]
    got = {(r["doc_id"], r["item_id"]): r for r in dc.find_leaks(make(rows), bench).collect()}
    assert set(got) == {(1, 1), (4, 2), (8, 4)} and all(r["distance"] == 0 for r in got.values())
    assert got[4, 2]["end_at"] == len("a redfox; red foxes, a (red fox")


def test_each_row_is_judged_by_its_own_text(make):
    item = "The quick brown fox jumps over the lazy dog near the river bank"
    rows = [(None, f"it says {item}"), (None, "clean text without an id"), (None, None), (1, f"{item} again"), (1, "clean text"),
            (2, item), (2, item), (3, "another clean text")]
    got = dc.keep_clean(make(rows), make([(7, item)], "item_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got) == [
        (0, ""), (0, "clean text without an id"), (1, "clean text"), (3, "another clean text")]


def test_odd_rows(make, odd_docs, no_docs, spark):
    bench = make([(1, None), (2, ""), (3, "too short"), (None, "tied text of seven words in all but one"),
                  (4, "line 1 of many lines line 2 of many lines")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in dc.find_leaks(odd_docs, bench).collect()] == [(11, 4)]
    kept = dc.keep_clean(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 1
    assert dc.find_leaks(no_docs, bench).collect() == []
    assert dc.keep_clean(odd_docs, bench.limit(0)).count() == odd_docs.count()
