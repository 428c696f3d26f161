"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item with an error budget of k edits is cut into k + 1 pieces.  If
a document holds the item with at most k edits, at least one piece stands in it
unchanged.  An Aho-Corasick automaton finds all pieces of a block of items in
one pass over each document; hits on about the same diagonal become one
stretch of the document, and Myers' bit-parallel algorithm tells whether the
item occurs there within its budget.

Items go to the executors in blocks of bounded size; a larger benchmark means
more blocks, each matched against all documents.
"""

from __future__ import annotations

from collections import defaultdict

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icdspark.llm.common import free_name, map_rows, need_columns, stored, struct_of, work_folder

#: Edits that an item may have, as a share of its characters.
ERROR_RATE = 0.06
#: Items with fewer words are too short for edits: they match exactly and as whole words.
MIN_WORDS = 8
#: Characters of items in one block (an automaton of a few hundred MB at most).
BLOCK_CHARS = 2_000_000

_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def normal(text: str | None) -> str:
    """Lower case (A-Z) with single spaces between words; items and documents are compared in this form."""
    return " ".join((text or "").translate(_LOWER).split())


class Item:
    def __init__(self, item_id: int, text: str, error_rate: float, whole: bool = False):
        self.id, self.text, self.size, self.whole = item_id, text, len(text), whole
        self.budget = 0 if whole else int(error_rate * self.size)
        cuts = [self.size * i // (self.budget + 1) for i in range(self.budget + 2)]
        self.pieces = [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]
        self.masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def stands_alone(self, text: str, at: int) -> bool:
        """Whether no word goes on beyond either end of the item, which occurs at ``at``."""
        inner, outer = (self.text[0], self.text[-1]), (text[at - 1 : at], text[at + self.size : at + self.size + 1])
        return not any(a.isalnum() and b.isalnum() for a, b in zip(inner, outer, strict=True))

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end) of the best occurrence inside ``text``: Myers' algorithm, one column for each character."""
        full = (1 << self.size) - 1
        top = 1 << (self.size - 1)
        masks = self.masks
        plus, minus, score = full, 0, self.size
        found = (score, 0)
        for at, char in enumerate(text):
            equal = masks.get(char, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | ~(horizontal | plus) & full
            down = plus & horizontal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
                if score < found[0]:
                    found = (score, at + 1)
            up = up << 1 & full
            plus = (down << 1 | ~(vertical | up)) & full
            minus = up & vertical
        return found


class Block:
    """The automaton of some items' pieces."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float, min_words: int = MIN_WORDS):
        self.items = [Item(i, t, error_rate, len(t.split()) < min_words) for i, t in items]
        where = defaultdict(list)
        for item in self.items:
            for offset, piece in item.pieces:
                where[piece].append((item, offset + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, places)
        if self.items:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, distance, end) of each item that occurs within its budget; its best occurrence."""
        if not self.items or not text:
            return []
        diagonals = defaultdict(set)
        for end, places in self.automaton.iter(text):
            for item, offset in places:
                diagonals[item].add(end + 1 - offset)
        found = []
        for item, starts in diagonals.items():
            if item.whole:  # its one piece is all of it, so a hit is an occurrence
                at = next((s for s in sorted(starts) if item.stands_alone(text, s)), None)
                if at is not None:
                    found.append((item.id, 0, at + item.size))
                continue
            best = None
            for low, high in _merged(sorted(starts), 2 * item.budget):
                begin = max(0, low - item.budget)
                stretch = text[begin : high + item.size + item.budget]
                exact = stretch.find(item.text)
                distance, end = (0, exact + item.size) if exact >= 0 else item.best(stretch)
                if distance <= item.budget and (best is None or distance < best[0]):
                    best = (distance, begin + end)
            if best:
                found.append((item.id, *best))
        return sorted(found)


def _merged(starts: list[int], gap: int) -> list[tuple[int, int]]:
    out = [(starts[0], starts[0])]
    for s in starts[1:]:
        if s - out[-1][1] <= gap:
            out[-1] = (out[-1][0], s)
        else:
            out.append((s, s))
    return out


_blocks: dict[str, Block] = {}


def _block(name: str, items: list[tuple[int, str]], error_rate: float, min_words: int) -> Block:
    """The block's automaton, built once in each process; only the latest is kept."""
    if name not in _blocks:
        _blocks.clear()
        _blocks[name] = Block(items, error_rate, min_words)
    return _blocks[name]


def _matcher(sent: Broadcast, error_rate: float, min_words: int):
    name = f"{sent._jbroadcast.id()}"

    def matched(texts: list[str | None]) -> list[tuple]:
        block = _block(name, sent.value, error_rate, min_words)
        return [([{"item_id": i, "distance": d, "end_at": e} for i, d, e in block.matches(normal(t))],) for t in texts]

    return matched


def find_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_words: int = MIN_WORDS,
               block_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, distance, end_at``: one row for each row of ``docs`` and item that it holds.

    An item matches within ``int(error_rate * its characters)`` edits, both in
    normal form (see ``normal``); ``distance`` is the smallest found, ``end_at``
    where that occurrence ends in the normal form.  An item with fewer than
    ``min_words`` words matches without an edit only, and not inside a longer
    word.  Null and empty texts match nothing, nor do empty items or a null id.
    Items with the same id are matched one by one.  Repeated rows get rows
    each; empty tables give an empty one; other columns are ignored.
    """
    return _leaks(docs, benchmark, {"doc_id": F.col(id_col)}, error_rate, min_words, block_chars, id_col, text_col)


def _leaks(docs: DataFrame, benchmark: DataFrame, keep: dict[str, Column], error_rate: float, min_words: int,
           block_chars: int, id_col: str, text_col: str) -> DataFrame:
    """The columns ``keep`` of a row of ``docs``, and ``item_id, distance, end_at`` of each item that it holds."""
    need_columns(docs, id_col, text_col)
    need_columns(benchmark, "item_id", "text")
    spark = docs.sparkSession
    usable = benchmark.select("item_id", "text").filter(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    chars = usable.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n_blocks = 1 + chars // block_chars
    usable = usable.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    found = []
    for number in range(n_blocks):
        texts = usable.filter(F.col("block") == number).toLocalIterator()
        items = sorted((row["item_id"], item) for row in texts if (item := normal(row["text"])))
        matched = _matcher(spark.sparkContext.broadcast(items), error_rate, min_words)
        match = struct_of(item_id=pa.int64(), distance=pa.int32(), end_at=pa.int64())
        matches = map_rows(docs, keep, [F.col(text_col)], {"m": pa.list_(match)}, matched)
        found.append(
            matches.select(*keep, F.explode("m").alias("m")).select(*keep, "m.item_id", "m.distance", "m.end_at"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_words: int = MIN_WORDS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item; columns stay as they were.

    Each row is judged by its own text, whatever other rows have its id (or none).
    """
    keep = {"doc_id": F.col(id_col), "h": F.xxhash64(text_col)}
    leaks = _leaks(docs, benchmark, keep, error_rate, min_words, BLOCK_CHARS, id_col, text_col)
    key, text_hash = free_name(docs, "key"), free_name(docs, "text_hash")
    rows = leaks.select(F.col("doc_id").alias(key), F.col("h").alias(text_hash)).distinct()
    rows = stored(rows, work_folder(docs.sparkSession), "leaks")
    return docs.join(
        rows.hint("merge"), F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text_col) == F.col(text_hash)), "left_anti")
