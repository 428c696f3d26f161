import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from icdspark.llm import conversation_repair as cr
from icdspark.llm import queries

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def least_edits(rows):
    """Cost and audit by trying every edit at every place, inserts too (two in a row at most: more never help)."""
    accepted = {"", "a"}

    @cache
    def rest(i, last, inserts):
        best = (0, "") if i == len(rows) and last in accepted else (10**9, "")
        def consider(letter, cost, found):
            nonlocal best
            best = min(best, (cost + found[0], letter + found[1]))
        need = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
        if inserts < 4:
            consider("I", 2, rest(i, need[0], inserts + 1))
        if i < len(rows):
            initial, gone, late = rows[i]
            consider("D", 3, rest(i + 1, last, 0))
            if not gone:
                if initial == need[0] or (last == "" and initial == "s"):
                    consider("K", late, rest(i + 1, initial, 0))
                consider("R", 2 + late, rest(i + 1, need[0], 0))
        return best

    for i in range(len(rows), 0, -1):  # from behind, or the recursion gets deep
        for last in ("", "s", "u", "a"):
            rest(i, last, 0)
    return rest(0, "", 0)


def plain(table):
    """conv_id -> report, over damaged rows in plain Python."""
    convs = {}
    for conv, turn, role, text in table:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs.setdefault(conv, []).extend([] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1))
    return {conv: judged(rows) for conv, rows in convs.items()}


def judged(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, marks, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        marks.append((role[:1], fault in (0, 1), int(fault == 2)))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit = least_edits(tuple(marks))
    out, last, at = [], "", 0
    for letter in audit:
        need = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
        if letter == "I":
            out.append(f"{need}:")
            last = need[0]
            continue
        _, role, text = rows[at]
        at += 1
        if letter == "K":
            out.append(f"{role}:{text}")
            last = role[0]
        elif letter == "R":
            out.append(f"{need}:{text}")
            last = need[0]
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def reports(df):
    found = df.collect()
    out = {r["conv_id"]: tuple(r)[1:] for r in found}
    assert len(out) == len(found)
    return out


def test_query_equals_brute_force(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert reports(queries.op13_conversation_repair(spark, SF)) == plain(table)


def messy(seed, convs=40, most=30):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        kinds = rng.choice([["user", "assistant"], ["user", "assistant", "system", "tool", "", None], ["user"], ["assistant", "system"]])
        texts = rng.choice([["Yes.", "No!", "Why?", "so", "and then"], ["", " \n", None, "x"], [f"t{i}." for i in range(50)]])
        for t in range(rng.randint(1, most)):
            rows.append((c if c else None, rng.choice([t, t, t, t + 3, None]), rng.choice(kinds), rng.choice(texts) if rng.random() < 0.9 else f"own {c} {t}."))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, sizes", [(1, {}), (2, {"chunk_rows": 3, "held_rows": 2}), (3, {"chunk_rows": 1, "held_rows": 0})])
def test_messy_conversations_in_chunks_of_any_size(spark, seed, sizes):
    """Conversations of one chunk, and such as are cut after every few rows."""
    rows = messy(seed)
    extra = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA + ", open string, task int, symbol string").repartition(6)
    assert reports(cr.repair(cr.damage(extra), **sizes)[0]) == plain(rows)


def test_one_long_conversation_over_many_tasks(spark):
    """Most rows are one conversation's, many of them alike; it is stitched of chunks that ran at once."""
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "user"]), rng.choice(["Same.", f"own {t}.", f"own {t}", ""])) for t in range(700)]
    rows += [(7, None, "user", "Same.")] * 300 + [(c, 0, "user", "Hi.") for c in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = plain(rows)
    assert reports(cr.repair(cr.damage(df), chunk_rows=16, held_rows=8)[0]) == expected
    assert reports(cr.report(df)) == expected


def test_repaired_rows_are_what_the_digest_says(spark):
    df = spark.createDataFrame(messy(5), SCHEMA)
    for sizes in ({}, {"chunk_rows": 2, "held_rows": 1}):
        out, rows = cr.repair(cr.damage(df), with_rows=True, **sizes)
        lines = {}
        for r in sorted(rows.collect(), key=lambda r: tuple(r["at"])):
            lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        for r in out.collect():
            assert hashlib.sha256("\n".join(lines.get(r["conv_id"], [])).encode()).hexdigest() == r["repaired_sha256"]


def test_vectors_converge_and_refreshing_stops_there():
    rng = random.Random(4)
    for _ in range(200):
        symbols = [rng.randint(0, 8) for _ in range(rng.randint(0, 12))]
        old, new = cr.END, cr.backward([rng.randint(0, 8) for _ in range(3)])[0]
        assert cr.refreshed(symbols, new, old, cr.backward(symbols, old)[0]) == cr.backward(symbols, new)[0]


def test_empty_table_and_lost_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.report(empty).columns == ["conv_id", *cr.DONE] and cr.report(empty).count() == 0
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = reports(cr.report(spark.createDataFrame([(lost, 0, "user", "Hi.")], SCHEMA)))
    assert got == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_long_texts_and_wide_turns(spark):
    rows = [(1, -(1 << 63), "user", "a b. " * 200_000), (1, (1 << 63) - 1, "assistant", "x" * 1_000_000), (2, 1, "user", "é .\x0b")]
    got = reports(cr.repair(spark.createDataFrame(rows, SCHEMA), held_chars=10)[0])
    assert got[1][0] == (1 << 63) - 1 and got[1][5] == 1 and got[2][6] == "KI"
