"""Quality rules as a short-circuit cascade.

A document passes if no rule rejects it.  All rules are necessary conditions,
so their order never changes the verdict, only its price: ``rule_order`` times
every rule on a bounded sample and sorts by rejections per second, and the
cascade stops at the first rejection.  Measures that rules share (words,
lines, repeated windows) are computed once per document, when first needed.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icdspark.llm.common import columns_of, free_name, map_rows, need_columns

WINDOW = 8
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Documents that ``rule_order`` times at most (about; the sample is by row).
SAMPLE_ROWS = 2000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Measures:
    """What the rules ask about one text; each value is computed when first used.

    A null text counts as empty.  Words are runs of anything but ASCII white
    space, lines are split at ``\\n`` only.
    """

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def worded_lines(self) -> list[bytes]:
        return [line for line in self.raw.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.worded_lines) - len(set(self.worded_lines))

    @cached_property
    def n_shouted(self) -> int:
        """Words that end in ``!!``."""
        return self.text.count("!! ") + self.text.count("!!\n") + self.text.endswith("!!")

    @cached_property
    def n_stuttered(self) -> int:
        """Words that are equal to the word before."""
        return sum(map(bytes.__eq__, self.words, self.words[1:]))

    @cached_property
    def n_repeat_words(self) -> int:
        words = self.words
        starts = len(words) - WINDOW + 1
        if starts < 2:
            return 0
        # the built-in hash differs between processes, but is only compared within one text
        codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        rolled = np.zeros(starts, np.uint64)
        for k in range(WINDOW):
            rolled = rolled * _MIX + codes[k : k + starts]
        ordered = np.sort(rolled)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            return 0
        maybe = np.flatnonzero(np.isin(rolled, twice))
        counts = Counter(tuple(words[i : i + WINDOW]) for i in maybe)
        edges = np.zeros(len(words) + 1, np.int64)
        for i in maybe:
            if counts[tuple(words[i : i + WINDOW])] > 1:
                edges[i] += 1
                edges[i + WINDOW] -= 1
        return int(np.count_nonzero(np.cumsum(edges)))


#: name -> the document is rejected.  Base rules first; the order of evaluation is ``rule_order``'s.
RULES: dict[str, Callable[[Measures], bool]] = {
    "few_words": lambda m: m.n_words < 20,
    "repeated_windows": lambda m: 100 * m.n_repeat_words > 30 * m.n_words,
    "symbols": lambda m: 10 * m.n_symbols > 3 * m.n_words,
    "stutter": lambda m: 10 * m.n_stuttered > 3 * m.n_words,
    "shouting": lambda m: 10 * m.n_shouted > 3 * m.n_words,
    "repeated_lines": lambda m: len(m.worded_lines) >= 5 and 2 * m.n_dup_lines > len(m.worded_lines),
    "word_length": lambda m: not 2 * m.n_words <= m.word_chars <= 20 * m.n_words,
}
BASE_RULES = ("few_words", "repeated_windows")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def rejected_by(m: Measures, order: Sequence[str]) -> str | None:
    """The first rule of ``order`` that rejects the document; later ones don't run."""
    for name in order:
        if RULES[name](m):
            return name
    return None


def rule_order(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rules by rejections per second, timed on about ``sample_rows`` random rows.

    An empty table, or rules that reject nothing, leave the order to cost alone.
    """
    need_columns(docs, text_col)
    total = docs.count()

    def timed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seconds, rejects, seen = Counter(), Counter(), 0
        for batch in batches:
            for text in batch.iloc[:, 0]:
                seen += 1
                for name, rule in RULES.items():
                    m = Measures(text)  # anew, so that each rule pays for what it measures
                    began = time.perf_counter()
                    rejects[name] += rule(m)
                    seconds[name] += time.perf_counter() - began
        yield pd.DataFrame({
            "rule": list(RULES), "seconds": [float(seconds[r]) for r in RULES],
            "rejects": [int(rejects[r]) for r in RULES], "seen": seen,
        })

    sample = docs.select(text_col).sample(fraction=min(1.0, sample_rows / max(total, 1)), seed=17)
    found = {
        row["rule"]: (row["seconds"], row["rejects"])
        for row in sample.mapInPandas(timed, "rule string, seconds double, rejects long, seen long")
        .groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejects").alias("rejects")).collect()
    }

    def worth(name: str) -> tuple[float, float]:
        seconds, rejects = found.get(name, (0.0, 0))
        return (-rejects / (seconds + 1e-9), seconds)

    return sorted(RULES, key=worth)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   order: Sequence[str] | None = None) -> DataFrame:
    """One row per input row: its id, the measures, ``base_failed`` and ``kept``.

    Null or empty texts have no words, so they fail ``few_words``.  Repeated
    rows and null ids get a row each.  An empty table gives an empty one.
    Columns besides the two named ones are ignored.
    """
    need_columns(docs, id_col, text_col)
    order = list(order or rule_order(docs, text_col))

    def judged(texts: list[str | None]) -> list[tuple]:
        rows = []
        for text in texts:
            m = Measures(text)
            kept = rejected_by(m, order) is None  # what the cascade measured isn't measured again
            rows.append((*(getattr(m, n) for n in MEASURES), any(RULES[r](m) for r in BASE_RULES), kept))
        return rows

    fields = {n: pa.int64() for n in MEASURES} | {"base_failed": pa.bool_(), "kept": pa.bool_()}
    return map_rows(docs, {"doc_id": F.col(id_col)}, [F.col(text_col)], fields, judged)


def keep_good(docs: DataFrame, text_col: str = "text", order: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that every rule passes, with their columns as they were."""
    need_columns(docs, text_col)
    order = list(order or rule_order(docs, text_col))

    mark = free_name(docs, "kept")
    judged = map_rows(docs, columns_of(docs), [text_col], {mark: pa.bool_()},
                      lambda texts: [(rejected_by(Measures(t), order) is None,) for t in texts])
    return judged.filter(F.col(mark)).drop(mark)
