"""Token counts by a dynamic programme over prefixes.

``T[p]`` is the number of tokens of the prefix that ends at position ``p``.
At chunk ends (see ``pieces``) it is a running sum, because no token crosses a
chunk end.  Inside a chunk, the last token of a prefix is the one vocabulary
piece that ends there and that stays next to the last token of the shorter
prefix when both are encoded together; so ``T`` follows from shorter prefixes
without encoding any prefix as a whole.  Truncation ("the longest prefix of at
most B tokens") and budget questions read the table.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icdspark.llm import pieces
from icdspark.llm.common import map_rows, need_columns

LIMIT = 4096


class PrefixCounter:
    """Counts of one model; keeps tables of chunks that it has met."""

    def __init__(self, model_path: str):
        self.vocabulary = pieces.vocabulary(model_path)
        self.tokens: dict[str, int] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def learn(self, chunks: set[str]) -> None:
        """Put these chunks' token counts into the table; a full table first forgets all others."""
        if len(self.tokens) > pieces.TABLE_ENTRIES:
            self.tokens = {c: self.tokens[c] for c in chunks if c in self.tokens}
        new = [c for c in chunks if c not in self.tokens]
        self.tokens.update(zip(new, map(len, self.vocabulary.library_ids(new)), strict=True))

    def ends(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Prefix lengths at chunk ends (code points of the text) and their token counts."""
        try:
            counts = [self.tokens[c] for c in chunks]
        except KeyError:
            self.learn(set(chunks))
            counts = [self.tokens[c] for c in chunks]
        lengths = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks))) - 1  # the added space
        return lengths, np.cumsum(np.asarray(counts, np.int64))

    def adjacent(self, left: str, right: str) -> bool:
        """Whether the two pieces stay two when their text is encoded together."""
        found = self.pairs.get((left, right))
        if found is None:
            ids = self.vocabulary.library_ids([left + right])[0]
            found = [self.vocabulary.piece_of[i].replace(pieces.SPACE, " ") for i in ids] == [left, right]
            if len(self.pairs) >= pieces.TABLE_ENTRIES:
                self.pairs.clear()
            self.pairs[left, right] = found
        return found

    def inside(self, chunk: str) -> np.ndarray:
        """Token counts of the prefixes of a chunk, lengths 0 to its own."""
        id_of, longest = self.vocabulary.id_of, self.vocabulary.longest
        counts, last = [0], [""]
        for end in range(1, len(chunk) + 1):
            for start in range(max(0, end - longest), end):
                piece = chunk[start:end]
                if piece not in id_of or counts[start] < 0:
                    continue
                if start == 0:
                    if self.vocabulary.library_ids([piece])[0] != [id_of[piece]]:
                        continue
                elif last[start] and not self.adjacent(last[start], piece):
                    continue
                counts.append(counts[start] + 1)
                last.append(piece)
                break
            else:
                char = chunk[end - 1]
                counts.append(counts[-1] + len(char.encode("utf-8", "surrogatepass")) if char not in id_of else -1)
                last.append("")
        if -1 in counts or counts[-1] != len(self.vocabulary.library_ids([chunk])[0]):
            # no piece, or not the one of the library: ask it for each prefix
            return np.array([0, *map(len, self.vocabulary.library_ids([chunk[:k] for k in range(1, len(chunk) + 1)]))])
        return np.array(counts)

    def prefix_counts(self, text: str | None) -> np.ndarray:
        """``T`` for every prefix length 0 to ``len(text)``."""
        chunks = self.vocabulary.chunks(text or "")
        table, base = [np.zeros(1, np.int64)], 0
        for k, chunk in enumerate(chunks):
            inner = self.inside(chunk)
            table.append(base + inner[2 if k == 0 else 1 :])
            base += inner[-1]
        return np.concatenate(table)

    def cut(self, chunks: list[str], lengths: np.ndarray, counts: np.ndarray, budget: int) -> int:
        """Length of the longest prefix with at most ``budget`` tokens."""
        if not len(counts) or counts[-1] <= budget:
            return int(lengths[-1]) if len(lengths) else 0
        k = int(np.searchsorted(counts, budget, side="right"))  # the first chunk whose end is beyond it
        base, at = (int(counts[k - 1]), int(lengths[k - 1])) if k else (0, -1)
        inner = self.inside(chunks[k])
        return max(0, at + int(np.flatnonzero(base + inner <= budget)[-1]))


@lru_cache(maxsize=4)
def counter(model_path: str) -> PrefixCounter:
    return PrefixCounter(model_path)


def count_tokens(docs: DataFrame, model_path: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit, cut_chars``.

    ``cut_chars`` is the length of the longest prefix that has at most
    ``limit`` tokens.  A null text counts as empty: no bytes, no tokens.
    Repeated rows and null ids get a row each, an empty table gives an empty
    one, other columns are ignored.
    """
    need_columns(docs, id_col, text_col)

    def counted(texts: list[str | None]) -> list[tuple]:
        c, rows = counter(model_path), []
        texts = [t or "" for t in texts]
        parts = [c.vocabulary.chunks(t) for t in texts]
        c.learn(set().union(*parts))
        for text, chunks in zip(texts, parts, strict=True):
            lengths, counts = c.ends(chunks)
            n_tokens = int(counts[-1]) if len(counts) else 0
            rows.append((len(text.encode("utf-8", "surrogatepass")), n_tokens, n_tokens > limit,
                         c.cut(chunks, lengths, counts, limit)))
        return rows

    long = pa.int64()
    fields = {"n_bytes": long, "n_tokens": long, "over_limit": pa.bool_(), "cut_chars": long}
    return map_rows(docs, {"doc_id": F.col(id_col)}, [F.col(text_col)], fields, counted)


def truncate(docs: DataFrame, model_path: str, budget: int, text_col: str = "text") -> DataFrame:
    """``docs`` with each text cut to its longest prefix of at most ``budget`` tokens (null stays null)."""
    need_columns(docs, text_col)

    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        c, out = counter(model_path), []
        for text in texts:
            if text:
                chunks = c.vocabulary.chunks(text)
                text = text[: c.cut(chunks, *c.ends(chunks), budget)]
            out.append(text)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text_col, cut(F.col(text_col)))
