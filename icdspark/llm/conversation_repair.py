"""Conversation structure repair: rank-convergence Viterbi over chunks, least audits by stitched backward costs.

A conversation is repaired by the cheapest edits (Keep, Rerole, Delete, Insert)
that make its role initials ``(s?(ua)+)?``.  The backward cost vector at a row
holds, for each of the four states of that pattern, the least cost of the rest.
Two vectors that differ by a constant lead to the same choices, so vectors are
kept with their minimum at zero; few such vectors exist, and a step from one to
the next is looked up once it is known.

Rows are dealt by a range shuffle on (conversation, turn, ...), so a task holds
whole conversations, but for its first and last one and for very long ones.
Whole ones are one chunk each and are repaired as they pass.  The rows of the
others are cut into chunks of bounded size which all run at once:

1. every chunk but a conversation's last starts from a speculative vector;
2. fix-up passes hand each chunk its successor's vector and rerun those for
   which it differs by more than a constant, until none does;
3. chunks are traced from all four states, and their exits stitched from the
   conversation's start; each chunk then writes its part of the least audit.

Chunks of rows that must go pass any vector on and are skipped by both chains, so
long runs of repeats cost no passes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icdspark.llm.common import need_columns, stored, work_folder

SPACE = r"\x20\x09-\x0D"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What inserting or reroling leads to, and the role that it gives.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE_OF = ("user", "user", "assistant", "user")
#: A row's symbol: 0 must go; else its role initial's place in this string, 4 more if its text is truncated.
INITIALS = "sua"
MUST_GO, OTHER = 0, 4
LEGAL = ("su", "ua", "au")
#: Backward costs at the end of a conversation, which is also what a chunk starts from before it knows better.
END = (0, 2 * INSERT, INSERT, 0)
#: Rows of a chunk, and the rows and characters of a conversation that a task holds before it hands them on.
CHUNK_ROWS, HELD_ROWS, HELD_CHARS = 1 << 12, 1 << 12, 1 << 24
#: Leading characters of a text that decide a row's place among rows of one turn and role (then a hash does).
PREFIX = 32
SLICE_ROWS = 512
LONG_MAX = (1 << 63) - 1
EMPTY = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- the cost vectors


def _keeps(symbol: int) -> tuple[int | None, int | None, int | None, int | None]:
    """Where keeping the row leads from each state (None: not allowed)."""
    initial = (symbol - 1) % 4 + 1
    if initial == 1:
        return (SYSTEM, None, None, None)
    if initial == 2:
        return (USER, USER, None, USER)
    return (None, None, ASSISTANT, None) if initial == 3 else (None,) * 4


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of what may be done to a row, in ASCII order."""
    out = [("D", DELETE, state)]
    if symbol != MUST_GO:
        late = TRUNCATED if symbol > OTHER else 0
        if (kept := _keeps(symbol)[state]) is not None:
            out.append(("K", KEEP + late, kept))
        out.append(("R", REROLE + late, NEXT[state]))
    return out


@lru_cache(maxsize=1 << 16)
def back(after: tuple[int, ...], symbol: int) -> tuple[tuple[int, ...], int]:
    """The vector before a row from the one after it, its minimum at zero, and that minimum."""
    row = [min(cost + after[to] for _, cost, to in _edits(symbol, state)) for state in range(4)]
    row[USER], row[ASSISTANT] = min(row[USER], INSERT + row[ASSISTANT]), min(row[ASSISTANT], INSERT + row[USER])
    row[START], row[SYSTEM] = min(row[START], INSERT + row[USER]), min(row[SYSTEM], INSERT + row[USER])
    least = min(row)
    return tuple(x - least for x in row), least


@lru_cache(maxsize=1 << 16)
def step(after: tuple[int, ...], symbol: int, state: int) -> tuple[str, int, int]:
    """Letters (inserts before the row, then the row's own), their cost and the next state, the ASCII-least of the cheapest."""
    before, least = back(after, symbol)
    letters, cost = "", 0
    while True:
        rest = before[state] + least
        edits = [*_edits(symbol, state)[:1], ("I", INSERT, NEXT[state]), *_edits(symbol, state)[1:]]
        for letter, price, to in edits:
            if price + (before[to] + least if letter == "I" else after[to]) == rest:
                break
        letters, cost, state = letters + letter, cost + price, to
        if letter != "I":
            return letters, cost, state


def backward(symbols: Sequence[int], end: tuple[int, ...] = END) -> list[tuple[int, ...]]:
    """The vectors before each row, and ``end`` behind the last."""
    out = [end]
    for symbol in reversed(symbols):
        out.append(back(out[-1], symbol)[0])
    return out[::-1]


def refreshed(symbols: Sequence[int], end: tuple[int, ...], old: tuple[int, ...], start: tuple[int, ...]) -> tuple[int, ...]:
    """The vector before the chunk from ``end``, where ``old`` led to ``start``: as soon as both agree, it is ``start`` again."""
    new = end
    for symbol in reversed(symbols):
        if new == old:
            return start
        new, old = back(new, symbol)[0], back(old, symbol)[0]
    return new


def trace(symbols: Sequence[int], vectors: Sequence[tuple[int, ...]], state: int = START) -> tuple[list[str], list[int], int, int]:
    """Each row's letters and the state in front of it, the letters' cost and the state behind the chunk."""
    letters, states, total = [], [], 0
    for at, symbol in enumerate(symbols):
        states.append(state)
        found, cost, state = step(vectors[at + 1], symbol, state)
        letters.append(found)
        total += cost
    return letters, states, total, state


def closing(state: int) -> str:
    """The inserts behind a conversation's last row."""
    return "I" * {SYSTEM: 2, USER: 1}.get(state, 0)


def lines(state: int, letters: str, role: str | None, text: str | None) -> list[tuple[str, str]]:
    """The repaired rows that a row's letters make (inserts in front and, at a conversation's end, behind)."""
    out = []
    for letter in letters:
        if letter == "K":
            out.append((role, text))
            state = ("", *INITIALS).index(role[:1])
        elif letter != "D":
            out.append((ROLE_OF[state], text if letter == "R" else ""))
            state = NEXT[state]
    return out


# ------------------------------------------------------------------------ rows


def damage(conversations: DataFrame) -> DataFrame:
    """Damaged rows, by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space); dropped ones stay with ``live`` false.

    0 drops the row, 1 empties its text, 2 takes away ``[.!?]``, 3 repeats it, 4 makes it the user's.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(kind <= 1, F.lit("")).when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    rows = conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(blank("role")).alias("role"),
        text.alias("text"), (kind != 0).alias("live"), F.when(kind == 3, 2).otherwise(1).alias("copies_"))
    return rows.withColumn("copy_", F.explode(F.sequence(F.lit(1), "copies_"))).drop("copies_", "copy_")


def _symbol() -> Column:
    """The row's symbol, as long as it isn't a repeat."""
    whole = F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    known = F.when((F.col("role") == "") | (initial == 0), F.lit(OTHER)).otherwise(initial)
    shown = F.col("text").rlike(rf"[^{SPACE}]")
    return F.when(~shown, F.lit(MUST_GO)).otherwise(known + F.when(whole, 0).otherwise(OTHER)).cast("int")


def _counts(symbols: Sequence[int], repeats: Sequence[bool]) -> tuple[int, int, int]:
    """Blank rows, repeats, and truncated rows among the others."""
    return (
        sum(s == MUST_GO and not r for s, r in zip(symbols, repeats, strict=True)), sum(repeats),
        sum(s > OTHER and not r for s, r in zip(symbols, repeats, strict=True)))


def _illegal(roles: Sequence[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False))


DONE = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_DONE = pa.struct([(n, pa.int64()) for n in DONE[:6]] + [(n, pa.string()) for n in DONE[6:]])
_OPEN = pa.struct([("task", pa.int32()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                   ("live", pa.bool_()), ("symbol", pa.int32()), ("digest", pa.binary())])
_LINES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _solve(rows: list[dict], with_rows: bool) -> tuple[tuple, list | None]:
    """The report of a whole conversation (live rows in order), and its repaired rows if asked for."""
    seen, symbols, repeats = set(), [], []
    for r in rows:
        repeat = r["symbol"] != MUST_GO and r["digest"] in seen
        seen.add(r["digest"])
        repeats.append(repeat)
        symbols.append(r["symbol"])
    used = [MUST_GO if repeat else s for s, repeat in zip(symbols, repeats, strict=True)]
    letters, states, cost, state = trace(used, backward(used))
    end = closing(state)
    made = [line for r, own, at in zip(rows, letters, states, strict=True) for line in lines(at, own, r["role"], r["text"])]
    made += lines(state, end, None, None)
    turns = {r["turn"] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in made).encode()).hexdigest()
    report = (min(gaps, LONG_MAX), *_counts(symbols, repeats), _illegal([r["role"] for r in rows]),
              cost + INSERT * len(end), "".join(letters) + end, digest)
    return report, made if with_rows else None


def _sweep(with_rows: bool, held_rows: int, held_chars: int):
    """A task's sorted rows: reports of the conversations it surely has whole, the rows of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, key, held, chars, is_open, place = None, None, [], 0, True, 0
        out: list[tuple] = []  # conversation, report, repaired rows, open row

        def flush() -> None:
            nonlocal held, chars
            if is_open:
                out.extend((key, None, None, row) for row in held)
            elif held:
                report, made = _solve([r for r in held if r["live"]], with_rows)
                out.append((key, dict(zip(DONE, report, strict=True)), made and [{"role": a, "text": b} for a, b in made], None))
            held, chars = [], 0

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(columns, (kind, _DONE, _LINES, _OPEN), strict=True)], names=["conv_id", "done", "lines", "open"])

        started = False
        for whole in batches:
            kind = whole.schema.field(0).type
            for start in range(0, whole.num_rows, SLICE_ROWS):
                for row in whole.slice(start, SLICE_ROWS).to_pylist():
                    own = row.pop("conv_id")
                    if started and own != key:
                        flush()
                        is_open = False
                    started, key = True, own
                    row["place"], place = place, place + 1
                    held.append(row)
                    chars += len(row["text"])
                    if is_open or len(held) > held_rows or chars > held_chars:
                        is_open = True
                        flush()
                if out:
                    yield batch()
        is_open = True
        flush()
        if out:
            yield batch()

    return run


# ---------------------------------------------------------------- chunks of the open conversations

_VECTOR = "array<int>"
_CHUNK = ["conv_id", "task", "block"]


def _per_chunk(df: DataFrame, inputs: Sequence[str], schema: str, types: Sequence[pa.DataType], make) -> DataFrame:
    """``df`` with further columns (``schema``): ``make`` of the ``inputs`` of each row, a chunk."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                given = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in inputs]
                made = zip(*(make(*row) for row in zip(*given, strict=True)), strict=True)
                kept = [i for i, n in enumerate(batch.schema.names) if n not in names]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in kept), *(pa.array(v, t) for v, t in zip(made, types, strict=True))],
                    names=[*(batch.schema.names[i] for i in kept), *names])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in names)
    return df.mapInArrow(run, f"{kept}, {schema}")


def _chunks(rows: DataFrame, repeats: DataFrame, chunk_rows: int) -> DataFrame:
    """Chunks of at most ``chunk_rows`` rows: symbols (repeats must go) and counts, without texts."""
    flagged = rows.select(
        "conv_id", "task", "place", "live", "symbol", F.substring("role", 1, 1).alias("initial")).join(
        repeats.withColumn("again", F.lit(True)), ["task", "place"], "left").withColumn("again", F.coalesce("again", F.lit(False)))
    grouped = flagged.groupBy("conv_id", "task", F.floor(F.col("place") / chunk_rows).alias("block")).agg(
        F.array_sort(F.collect_list(F.when(F.col("live"), F.struct("place", "symbol", "again", "initial")))).alias("rows"))
    used = F.transform("rows", lambda r: F.when(r["again"], F.lit(MUST_GO)).otherwise(r["symbol"]))
    count = lambda test: F.size(F.filter("rows", test)).cast("bigint")
    pairs = F.zip_with(F.col("rows"), F.slice("rows", 2, F.size("rows")), lambda a, b: F.concat(a["initial"], b["initial"]))
    illegal = F.filter(pairs, lambda p: p.isNotNull() & ~p.isin(*LEGAL))
    return grouped.select(
        *_CHUNK, F.transform("rows", lambda r: r["place"]).alias("places"), used.alias("symbols"),
        count(lambda r: (r["symbol"] == MUST_GO) & ~r["again"]).alias("blank"), count(lambda r: r["again"]).alias("duplicate"),
        count(lambda r: (r["symbol"] > OTHER) & ~r["again"]).alias("truncated"), F.size(illegal).cast("bigint").alias("illegal"),
        F.get("rows", F.lit(0))["initial"].alias("first_initial"), F.get("rows", F.size("rows") - 1)["initial"].alias("last_initial"),
        F.exists(used, lambda s: s != MUST_GO).alias("acts"))


def _chain(table: DataFrame, value: Column, forward: bool, none: Column) -> Column:
    """Each chunk's neighbour's ``value``: that of the nearest acting chunk behind (or before) it; ``none`` at the end."""
    at = ["task", "block"]
    order = [F.col(c).asc() if forward else F.col(c).desc() for c in at]
    w = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.last(F.when(F.col("acts"), value), ignorenulls=True).over(w), none)


def _stitched(chunks: DataFrame, folder: str) -> DataFrame:
    """Chunks with the true vector behind them (``end_vector``) and the state in front (``entry``)."""
    end = F.lit(list(END)).cast(_VECTOR)
    passed = _per_chunk(
        chunks.withColumn("end_vector", end), ["symbols", "end_vector"], f"start_vector {_VECTOR}", [pa.list_(pa.int32())],
        lambda symbols, after: (list(backward(symbols, tuple(after))[0]),))
    passed, k = stored(passed, folder, "pass0"), 0
    while True:
        k += 1
        told = stored(passed.select(
            *_CHUNK, _chain(passed, F.col("start_vector"), False, end).alias("told")), folder, f"told{k}")
        both = passed.join(told.select(F.col("conv_id").alias("c_"), F.col("task").alias("t_"), F.col("block").alias("b_"), "told"),
                           F.col("conv_id").eqNullSafe(F.col("c_")) & (F.col("task") == F.col("t_")) & (F.col("block") == F.col("b_")))
        both = both.drop("c_", "t_", "b_")
        if both.filter(F.col("told") != F.col("end_vector")).isEmpty():
            break
        passed = _per_chunk(
            both, ["symbols", "told", "end_vector", "start_vector"], f"end_vector {_VECTOR}, start_vector {_VECTOR}", [pa.list_(pa.int32())] * 2,
            lambda symbols, told, old, start: (told, list(refreshed(symbols, tuple(told), tuple(old), tuple(start)))))
        passed = stored(passed.drop("told"), folder, f"pass{k}")
    exits = stored(_per_chunk(
        passed, ["symbols", "end_vector"], "exits array<int>", [pa.list_(pa.int32())],
        lambda symbols, after: ([trace(symbols, backward(symbols, tuple(after)), s)[3] for s in range(4)],)), folder, "exits")
    # the state in front of each chunk: assumed, then followed from the start until nothing changes
    entries, k = exits.withColumn("entry", F.lit(START)), 0
    while True:
        k += 1
        leaves = F.get("exits", F.col("entry"))
        entries = stored(entries.withColumn("entry_", _chain(entries, leaves, True, F.lit(START))), folder, f"entries{k}")
        same = entries.filter(F.col("entry") != F.col("entry_")).isEmpty()
        entries = entries.drop("entry").withColumnRenamed("entry_", "entry")
        if same:
            return entries


def _written(
    first: int, places: list[int], symbols: list[int], after: list[int], entry: int, last: bool
) -> tuple[str, int, list[dict]]:
    """A chunk's part of the audit, its cost, and the rows that leave a line: place, state in front, letters.

    The last chunk may have no live row (places count from ``first``) and yet close the conversation.
    """
    letters, states, cost, state = trace(symbols, backward(symbols, tuple(after)), entry)
    end = closing(state) if last else ""
    if end and letters:
        letters[-1] += end
    elif end:
        places, states, letters = [first], [state], [end]
    rows = [{"place": p, "state": s, "letters": x} for p, s, x in zip(places, states, letters, strict=True) if x != "D"]
    return "".join(letters), cost + INSERT * len(end), rows


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each conversation's lines, which come in order; a digest can't be made of parts."""
    key, digest = None, None
    for whole in batches:
        ended = []
        for start in range(0, whole.num_rows, SLICE_ROWS):
            for row in whole.slice(start, SLICE_ROWS).to_pylist():
                if digest is None or row["conv_id"] != key:
                    if digest is not None:
                        ended.append((key, digest.hexdigest()))
                    key, digest = row["conv_id"], hashlib.sha256()
                    break_ = ""
                for role, text in lines(row["state"], row["letters"], row["role"], row["text"]):
                    digest.update(f"{break_}{role}:{text}".encode())
                    break_ = "\n"
        kind = whole.schema.field(0).type
        yield _digests(ended, kind)
    if digest is not None:
        yield _digests([(key, digest.hexdigest())], kind)


def _digests(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in found], kind), pa.array([d for _, d in found], pa.string())], names=["conv_id", "digest"])


def _lined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(start, SLICE_ROWS)
            made = [[{"role": a, "text": b} for a, b in lines(r["state"], r["letters"], r["role"], r["text"])] for r in batch.to_pylist()]
            names = ["conv_id", "task", "place"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(n)) for n in names), pa.array(made, _LINES)], names=[*names, "lines"])


def _same(a: DataFrame, b: DataFrame, how: str = "left") -> DataFrame:
    """Join on the conversation, null with null."""
    other = b.withColumnRenamed("conv_id", "other_")
    return a.join(other, F.col("conv_id").eqNullSafe(F.col("other_")), how).drop("other_")


def _open_reports(rows: DataFrame, kind: str, folder: str, chunk_rows: int) -> tuple[DataFrame, DataFrame]:
    """Reports of the conversations in ``rows``, by chunks, and the rows that leave lines."""
    live = rows.filter("live")
    shown = live.filter(F.col("symbol") != MUST_GO).select("conv_id", "digest", "task", "place")
    firsts = shown.groupBy("conv_id", "digest").agg(F.min(F.struct("task", "place")).alias("first")).select("first.*")
    repeats = shown.select("task", "place").join(firsts, ["task", "place"], "left_anti")
    entries = _stitched(_chunks(rows, repeats, chunk_rows), folder)
    w = Window.partitionBy("conv_id").orderBy("task", "block")
    before = F.last("last_initial", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    meets = F.concat(before, F.col("first_initial"))
    placed = entries.select(
        "*", F.lead("task").over(w).isNull().alias("last"),
        (F.col("illegal") + F.coalesce((~meets.isin(*LEGAL)).cast("bigint"), F.lit(0))).alias("illegal_"))
    one = pa.list_(pa.struct([("place", pa.int64()), ("state", pa.int32()), ("letters", pa.string())]))
    written = stored(_per_chunk(
        placed.drop("exits", "start_vector").withColumn("first", F.col("block") * chunk_rows),
        ["first", "places", "symbols", "end_vector", "entry", "last"],
        "audit string, cost bigint, kept array<struct<place:bigint,state:int,letters:string>>", [pa.string(), pa.int64(), one],
        _written), folder, "written")
    kept = written.select("conv_id", "task", F.explode("kept").alias("kept")).select(
        "conv_id", "task", F.col("kept.place").alias("place"), F.col("kept.state").alias("state"), F.col("kept.letters").alias("letters"))
    texts = kept.join(rows.select("task", "place", "role", "text"), ["task", "place"], "left").select(
        "conv_id", "task", "place", "state", "letters", "role", "text")
    hashed = texts.repartition("conv_id").sortWithinPartitions("conv_id", "task", "place").mapInArrow(
        _hashed, f"conv_id {kind}, digest string")
    turns = live.filter(F.col("turn").isNotNull()).groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        (F.max("turn").cast("decimal(38,0)") - F.min("turn").cast("decimal(38,0)") + 1 - F.count(F.lit(1))).alias("gaps"))
    parts = F.array_sort(F.collect_list(F.struct("task", "block", "audit")))
    sums = written.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")), F.sum("illegal_").alias("illegal"),
        F.sum("cost").alias("cost"), F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"))
    held = F.least(F.col("gaps"), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("bigint")
    gaps = F.when(F.col("gaps").isNull(), F.lit(0).cast("bigint")).otherwise(held)  # none has a turn
    report = _same(_same(sums, turns), hashed).select(
        "conv_id", gaps.alias("gaps"), *DONE[1:7], F.coalesce("digest", F.lit(EMPTY)).alias(DONE[7]))
    return report, texts


def repair(
    rows: DataFrame, with_rows: bool = False, chunk_rows: int = CHUNK_ROWS, held_rows: int = HELD_ROWS, held_chars: int = HELD_CHARS,
) -> tuple[DataFrame, DataFrame | None]:
    """A report of each conversation (``conv_id`` and ``DONE``), and the repaired rows if asked for.

    ``rows``: ``conv_id, turn, role, text`` and, if some conversations may have
    no row, ``live`` (false: the row only names its conversation).  A row that
    is blank or whose role and text occurred earlier is deleted; of the cheapest
    edits the ASCII-least audit counts.  Repaired rows are ``conv_id, at, role,
    text``, in order of ``at``.

    Defined results: null roles and texts are one space, so such a text is
    blank and such a role is rerolled; null turns come first; rows of one turn
    stand by role, then by the first 32 characters of the text, then by a hash of
    it; rows without a conversation are one conversation; other columns don't
    matter; an empty table gives no rows; gaps saturate at a long's largest value.
    The digest of one conversation is made by one task, as it can't be made of
    parts; that task holds a batch of rows at a time.
    """
    need_columns(rows, "conv_id", "turn", "role", "text")
    folder = work_folder(rows.sparkSession)
    live = F.col("live") if "live" in rows.columns else F.lit(True)
    blank = lambda c: F.coalesce(F.col(c), F.lit(" "))
    given = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), blank("role").alias("role"),
        F.when(live, blank("text")).otherwise("").alias("text"), live.alias("live"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, PREFIX),
             F.xxhash64("text"), F.monotonically_increasing_id()]
    dealt = given.repartitionByRange(*order).sortWithinPartitions(*order[:5])
    kind = given.schema["conv_id"].dataType.simpleString()
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    marked = dealt.select("conv_id", F.spark_partition_id().alias("task"), "turn", "role", "text", "live",
                          _symbol().alias("symbol"), digest.alias("digest"))
    done = "struct<" + ",".join(f"{n}:bigint" for n in DONE[:6]) + "," + ",".join(f"{n}:string" for n in DONE[6:]) + ">"
    some = "struct<task:int,place:bigint,turn:bigint,role:string,text:string,live:boolean,symbol:int,digest:binary>"
    found = stored(marked.mapInArrow(
        _sweep(with_rows, held_rows, held_chars),
        f"conv_id {kind}, done {done}, lines array<struct<role:string,text:string>>, open {some}"), folder, "found")
    whole = found.filter(F.col("done").isNotNull())
    report, texts = _open_reports(found.filter(F.col("open").isNotNull()).select("conv_id", "open.*"), kind, folder, chunk_rows)
    out = whole.select("conv_id", "done.*").unionByName(report)
    if not with_rows:
        return out, None
    lined = texts.mapInArrow(_lined, f"conv_id {kind}, task int, place bigint, lines array<struct<role:string,text:string>>")
    own = whole.select("conv_id", F.lit(0).alias("task"), F.lit(0).cast("bigint").alias("place"), "lines")
    return out, own.unionByName(lined).select("conv_id", "task", "place", F.posexplode("lines").alias("k", "line")).select(
        "conv_id", F.struct("task", "place", "k").alias("at"), "line.*")


def report(conversations: DataFrame) -> DataFrame:
    """The damaged conversations' reports."""
    need_columns(conversations, "conv_id", "turn", "role", "text")
    return repair(damage(conversations))[0]
