"""Line dedup: delete passages that occur earlier, found by winnowing and extended both ways.

Texts are read as lines of words; a passage may begin and end inside a line.
Of the ``MIN_WORDS - GRAM_WORDS + 1`` grams (runs of ``GRAM_WORDS`` words) in a
window of ``MIN_WORDS`` words the one with the smallest hash is its fingerprint.
Two places with an equal passage of ``MIN_WORDS`` words have an equal fingerprint
at the same distance: the guarantee of winnowing.  A fingerprint stands for all
windows that chose it, its *reach*: what it extends to on either side.

1. Fingerprints are joined by gram and the hash of their whole reach.  All but
   the first place of an equal reach go, from end to end; this settles copies.
2. The first places of the different reaches of one gram are extended: each of
   their windows is compared, and those that occur earlier go.  A window's
   first place is the first place of its reach, so none is missed.

Every step is a grouped minimum or an equality join; no pairs of places are
made, and passages that many documents share are rows of step 1 alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icdspark.llm.common import columns_of, free_name, map_rows, need_columns, stored, work_folder

MIN_WORDS = 50
GRAM_WORDS = 10
#: The bytes between words: ASCII white space.
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Base of the rolling hash modulo 2^64 (odd, so it has an inverse).
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Powers of the base that a worker keeps, and bytes of text that are hashed at a time.
_KEPT_POWERS = _BLOCK = 1 << 19


def _powers(base: int, n: int, kept: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    """The first ``n`` powers of ``base`` modulo 2^64."""
    if base in kept and n <= len(kept[base]):
        return kept[base][:n]
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    out = np.multiply.accumulate(out, dtype=np.uint64)
    if n <= _KEPT_POWERS:
        kept[base] = out
    return out


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and end."""
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = ~_SPACE[np.frombuffer(data, np.uint8)]
    edges = np.diff(solid)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of the values' polynomial modulo 2^64."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, len(values)), out=out[1:])
    return out


def _codes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word, from the bytes of some whole words at a time."""
    out, at, values = [], 0, np.frombuffer(data, np.uint8)
    while at < len(starts):
        origin = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, origin + _BLOCK, side="right")))
        sums = _sums(values[origin : ends[stop - 1]].astype(np.uint64) + np.uint64(1))
        a, b = starts[at:stop] - origin, ends[at:stop] - origin
        out.append(_stirred((sums[b] - sums[a]) * _powers(_INVERSE, len(sums))[a]))
        at = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class Words:
    """Hashes of any run of words of a text (or of several, on end)."""

    def __init__(self, data: bytes):
        self.starts, ends = _spans(data)
        self.n = len(self.starts)
        self._sums = _sums(_codes(data, self.starts, ends))
        self._back = _powers(_INVERSE, self.n + 1)

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the words from each start to its end: their polynomial, stirred so that its low bits are good too."""
        return _stirred((self._sums[ends] - self._sums[starts]) * self._back[starts])

    def all_runs(self, size: int) -> np.ndarray:
        """``runs`` of every ``size`` words on end."""
        return _stirred((self._sums[size:] - self._sums[: self.n + 1 - size]) * self._back[: self.n + 1 - size])


def _stirred(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _window_minima(values: np.ndarray, span: int) -> np.ndarray:
    """Where the smallest of every ``span`` values on end stands, the last of equals (so it never moves back)."""
    least, at, size = values, np.arange(len(values)), 1
    while size < span:
        step = min(size, span - size)  # two overlapping windows of ``size`` make one of ``size + step``
        later = least[step:] <= least[:-step]
        at = np.where(later, at[step:], at[:-step])
        least = np.where(later, least[step:], least[:-step])
        size += step
    return at


def _reaches(texts: list[bytes], min_words: int, gram_words: int) -> list[tuple]:
    """``reaches_of`` of several texts, which stand on end; windows that leave their text don't count."""
    words = Words(b"\n".join(texts))
    ends = np.searchsorted(words.starts, np.cumsum([len(t) + 1 for t in texts]))
    counts = np.diff(ends, prepend=0)
    if words.n < min_words:
        return [(np.zeros(0, np.int64),) * 4] * len(texts)
    grams = words.all_runs(gram_words)
    chosen = _window_minima(grams, min_words - gram_words + 1)
    inside = np.flatnonzero(np.arange(min_words, words.n + 1) <= np.repeat(ends, counts)[: len(chosen)])
    at = chosen[inside]
    begins = np.flatnonzero(np.diff(at, prepend=-1))  # each window that chose another gram than the one before
    first, places = inside[begins], at[begins]
    last = inside[np.append(begins[1:], len(inside)) - 1] if len(begins) else first
    whole = words.runs(first, last + min_words) ^ ((places - first).astype(np.uint64) * np.uint64(_BASE))
    cuts = np.searchsorted(first, ends[:-1])
    start = np.repeat(ends - counts, np.diff(np.concatenate([[0], cuts, [len(first)]])))
    parts = (grams[places].view(np.int64), whole.view(np.int64), first - start, last - start)
    return list(zip(*(np.split(x, cuts) for x in parts), strict=True))


def reaches_of(texts: list[str | None], min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS) -> list[tuple]:
    """(grams, hashes of their reaches, first windows, last windows) of each text."""
    out, some, n = [], [], 0
    for data in map(_bytes, texts):
        if some and n + len(data) > _BLOCK:
            out += _reaches(some, min_words, gram_words)
            some, n = [], 0
        some.append(data)
        n += len(data)
    return out + (_reaches(some, min_words, gram_words) if some else [])


def windows_of(text: str, reaches: list[tuple[int, int]], min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every window of these reaches (first and last window) of one text."""
    words = Words(_bytes(text))
    starts = np.concatenate([np.arange(a, b + 1) for a, b in reaches])
    return starts, words.runs(starts, starts + min_words).view(np.int64)


def without(text: str, runs: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the words of these runs (start, end exclusive), and how many words that were.

    A line whose words all go goes; what stays of a line on both sides of a run
    is parted by a space.
    """
    data = _bytes(text)
    lines = data.split(b"\n")
    starts, ends = _spans(data)
    fronts = np.cumsum([0, *(len(line) + 1 for line in lines)])
    places = np.searchsorted(starts, fronts).tolist()
    gone = np.zeros(len(starts) + 1, np.int64)
    for a, b in runs:
        gone[a] += 1
        gone[b] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    dropped = np.concatenate([np.zeros(1, np.int64), np.cumsum(gone)]).tolist()
    out = []
    for line, a, b in zip(lines, places, places[1:], strict=False):
        cut = dropped[b] - dropped[a]
        if not cut:
            out.append(line)
        elif cut < b - a:
            keep = a + np.flatnonzero(~gone[a:b])
            cuts = np.flatnonzero(np.diff(keep) > 1)
            pieces = zip(keep[np.r_[0, cuts + 1]], keep[np.r_[cuts, len(keep) - 1]], strict=True)
            out.append(b" ".join(data[starts[x] : ends[y]] for x, y in pieces))
    return b"\n".join(out).decode("utf-8", "surrogatepass"), int(gone.sum())


def _keyed(runs: DataFrame, docs: DataFrame, id_col: str, text_col: str, name: str) -> tuple[DataFrame, str]:
    """``docs`` with the column ``name`` of ``runs`` (by id and hash of the text), under a free name."""
    key, text_hash, found = (free_name(docs, n) for n in ("key", "text_hash", name))
    # always a merge join: the runs grow with the documents, so they aren't broadcast at any size
    side = runs.select(F.col("doc_id").alias(key), F.col("h").alias(text_hash), F.col(name).alias(found)).hint("merge")
    return docs.join(side, F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text_col) == F.col(text_hash)), "left"), found


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, h, runs``: the passages of each text (its id and ``xxhash64``) that occur earlier.

    Runs are (start, end) over the words of the text.  Texts without one have no row.
    """
    need_columns(docs, id_col, text_col)
    if min_words < 1:
        raise ValueError("a passage has a word at least")
    gram_words = min(gram_words, min_words)
    folder = work_folder(docs.sparkSession)
    places, codes = pa.list_(pa.int32()), pa.list_(pa.int64())
    units = map_rows(
        docs, {"doc_id": F.col(id_col), "h": F.xxhash64(text_col)}, [F.col(text_col)],
        {"gram": codes, "reach": codes, "first": places, "last": places},
        lambda texts: reaches_of(texts, min_words, gram_words))
    units = stored(units.filter(F.size("gram") > 0), folder, "units")
    # stored before they are joined: both sides of a join are then plain exchanges, and a hot key can be split
    repeated = units.select(F.explode("gram").alias("gram")).groupBy("gram").count().filter("count > 1").select("gram")
    repeated = stored(repeated, folder, "repeated")
    marks = units.select("doc_id", "h", F.explode(F.arrays_zip("gram", "reach", "first", "last")).alias("m")).select("doc_id", "h", "m.*")
    marks = stored(marks.join(repeated.hint("shuffle_hash"), "gram", "left_semi"), folder, "marks")
    place = F.struct("doc_id", "h", "first", "last")
    classes = marks.groupBy("gram", "reach").agg(F.min(place).alias("place"), F.max(place).alias("latest"))
    classes = stored(classes, folder, "classes")
    # 1. equal reaches: all but the first place go
    shared = stored(classes.filter(~F.col("place").eqNullSafe(F.col("latest"))).select("gram", "reach", "place"), folder, "shared")
    whole = marks.join(shared, ["gram", "reach"]).filter(~place.eqNullSafe(F.col("place"))).select(
        "doc_id", "h", F.col("first").alias("start"), (F.col("last") + min_words).alias("end"))
    # 2. grams with several reaches: their first places, window by window
    several = stored(classes.groupBy("gram").count().filter("count > 1").select("gram"), folder, "several")
    firsts = classes.join(several, "gram", "left_semi").select("place.*").groupBy("doc_id", "h").agg(
        F.array_distinct(F.collect_list(F.struct("first", "last"))).alias("reaches"))
    joined, found = _keyed(stored(firsts, folder, "firsts"), docs.select(id_col, text_col), id_col, text_col, "reaches")
    opened = map_rows(
        joined.filter(F.col(found).isNotNull()), {"doc_id": F.col(id_col), "h": F.xxhash64(text_col)},
        [joined[text_col], joined[found]], {"start": places, "window": codes},
        lambda texts, reaches: [
            windows_of(t, [(r["first"], r["last"]) for r in rs], min_words) for t, rs in zip(texts, reaches, strict=True)])
    windows = stored(opened.select("doc_id", "h", F.explode(F.arrays_zip("start", "window")).alias("w")).select(
        "doc_id", "h", "w.*"), folder, "windows")
    spot = F.struct("doc_id", "h", "start")
    first = windows.groupBy("window").agg(F.min(spot).alias("first"), F.max(spot).alias("latest"))
    first = stored(first.filter(~F.col("first").eqNullSafe(F.col("latest"))).drop("latest"), folder, "first")
    later = windows.join(first, "window").filter(~spot.eqNullSafe(F.col("first"))).select(
        "doc_id", "h", "start", (F.col("start") + min_words).alias("end"))
    return whole.unionByName(later).groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "end")).alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS,
                id_col: str = "doc_id", text_col: str = "text", removed_col: str | None = None) -> DataFrame:
    """``docs`` with later repeated passages deleted from the text; every row and column stays.

    A word goes if it lies in a passage of at least ``min_words`` words that
    occurs earlier: in a row with a smaller id (null ids are the smallest; equal
    ids by a hash of the text), or further up in the same text, where both may
    overlap.  White space between words doesn't matter, line ends included.  Rows with the same id and
    text are one document, with one result.  Null texts stay null, empty ones
    empty; lines whose words all go go with them, so a text that repeats others
    throughout becomes empty.  ``removed_col`` adds the number of words that went.
    """
    runs = stored(repeated_runs(docs, min_words, gram_words, id_col, text_col), work_folder(docs.sparkSession), "runs")

    def cleaned(texts: list[str | None], found: list[list[dict] | None]) -> list[tuple]:
        return [
            (t, 0) if r is None or t is None else without(t, [(x["start"], x["end"]) for x in r])
            for t, r in zip(texts, found, strict=True)
        ]

    text, removed = (free_name(docs, n) for n in ("cleaned", "removed"))
    joined, found = _keyed(runs, docs, id_col, text_col, "runs")
    done = map_rows(joined, columns_of(docs, text_col), [docs[f"`{text_col}`"], joined[found]],
                    {text: pa.string(), removed: pa.int64()}, cleaned)
    columns = [F.col(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return done.select(*columns, *([F.col(removed).alias(removed_col)] if removed_col else []))
