"""SentencePiece encoding and decoding with N-best segmentations.

A segmentation's score is the sum of the model's piece scores.  Forward
Viterbi over the piece lattice gives the best score of every prefix; a backward
A-star search from the end uses these scores as its heuristic.  Because they
are exact, the search leaves its queue in order of the total score, and the
first N complete paths are the N best.

The lattice of a text is a chain of independent lattices, cut where no piece
crosses (``pieces.chunks``).  Each process keeps a table of chunks; the forward
scores, the best path and the loss of the second best of new chunks are
computed with numpy for many chunks of one length at a time.  The N best of a
text combine chunk alternatives by their loss against the best, and only the
few chunks that can differ in them are searched.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icdspark.llm import pieces
from icdspark.llm.common import map_rows, need_columns

N_BEST = 4
#: A character without a piece costs this much more than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Scores from here down are the file's way of saying "none" (runs of spaces); they count as just below the worst.
NO_SCORE = -1e8


_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = np.uint64((1 << 17) - 1)
_NO_ID = np.iinfo(np.int32).max
#: Chunk characters times piece lengths of one numpy step (some MB).
_BLOCK_CELLS = 100_000
#: Chunks in a process's table (some 200 bytes each); a fuller one is cut to the current batch's.
TABLE_ENTRIES = 300_000
#: Documents that are encoded together.
_BATCH = 1024


def _hash(text: str) -> int:
    value = 0
    for c in text:
        value = (value * int(_BASE) + ord(c)) % (1 << 64)
    return value


_first_four = itemgetter(0, 1, 2, 3)


class _Places(dict):
    """Numbers chunks in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.new.append(chunk)
        return number


class Codec:
    def __init__(self, model_path: str, n_best: int = N_BEST):
        self.vocabulary = v = pieces.vocabulary(model_path)
        self.n = n_best
        usual = min([s for s in v.score_of.values() if s > NO_SCORE], default=0.0)
        self.edge_of = {x: (max(v.score_of[x], usual - 1), (i,)) for x, i in v.id_of.items()}
        self.unknown_score = usual - UNKNOWN_PENALTY
        # the table of chunks: place, best score, loss of the second best, best ids as int32 bytes
        self.forget()
        # pieces by a hash of their code points that can be had for all parts of many chunks at once:
        # a few tables by different bits of the hash, each with the pieces that found their place taken before
        hashes = np.array([_hash(x) for x in self.edge_of], np.uint64)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces have the same hash")
        self.piece_scores = np.array([*(e[0] for e in self.edge_of.values()), -np.inf])
        self.piece_ids = np.array([*(e[1][0] for e in self.edge_of.values()), -1], np.int32)
        self.tables: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        left = np.arange(len(hashes))
        while left.size:
            shift = np.uint64(47 - 8 * (len(self.tables) % 6))
            slots = (hashes[left] * _BASE >> shift) & _SLOTS
            taken, first = np.unique(slots, return_index=True)
            keys, places = np.zeros(int(_SLOTS) + 1, np.uint64), np.full(int(_SLOTS) + 1, -1, np.int32)
            keys[taken], places[taken] = hashes[left[first]], left[first]
            self.tables.append((shift, keys, places))
            left = np.delete(left, first)
        self.characters = frozenset(x for x in self.edge_of if len(x) == 1)

    def unknown(self, char: str) -> tuple[float, tuple[int, ...]]:
        """An edge for a character without a piece: its UTF-8 bytes."""
        return self.unknown_score, tuple(self.vocabulary.byte_ids[b] for b in char.encode("utf-8", "surrogatepass"))

    def lattice(self, chunk: str) -> tuple[list[float], list[list[tuple]]]:
        """Forward Viterbi: the best score of each prefix, and the edges (start, score, ids) that end there."""
        edge_of, longest = self.edge_of, self.vocabulary.longest
        best, into = [0.0], [[]]
        for end in range(1, len(chunk) + 1):
            edges = [
                (start, *edge) for start in range(end - longest if end > longest else 0, end)
                if (edge := edge_of.get(chunk[start:end]))
            ]
            if not edges or edges[-1][0] != end - 1:
                edges.append((end - 1, *self.unknown(chunk[end - 1])))
            into.append(edges)
            best.append(max([best[start] + score for start, score, _ in edges]))
        return best, into

    def search(self, chunk: str) -> list[tuple[float, tuple[int, ...]]]:
        """The N best segmentations of a chunk as (score, ids), by backward A-star search.

        The states in the queue stand for disjoint sets of paths and their keys
        are exact, so states beyond as many as are still wanted can go.  Of
        equal scores the latest branch goes first, in it the smallest id.  Paths
        share their tails, so a very long chunk costs no more than its length.
        """
        best, into = self.lattice(chunk)
        queue: list[tuple] = [(-best[-1], 0, (), len(chunk), 0.0, None)]
        done: list[tuple[float, tuple[int, ...]]] = []
        turn = 0
        while queue and len(done) < self.n:
            total, _, own, at, behind, tail = queue.pop(0)
            path = (own, tail)
            if at == 0:
                ids: list[int] = []
                while path:
                    ids += path[0]
                    path = path[1]
                done.append((-total, tuple(ids)))
                continue
            turn -= 1
            queue += [(-(best[s] + (x + behind)), turn, more, s, x + behind, path) for s, x, more in into[at]]
            queue.sort(key=_first_four)
            del queue[self.n - len(done) :]
        return done

    def entry(self, chunk: str) -> tuple:
        """(best score, best ids, loss of the second best) of a chunk."""
        (score, ids), *rest = self.search(chunk)
        return score, ids, score - rest[0][0] if rest else np.inf

    def _edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the pieces that end at each character, by length; -inf and -1 where there is none."""
        rows, size = codes.shape
        longest = min(self.vocabulary.longest, size)
        prefix = np.zeros((rows, size + 1), np.uint64)
        for j in range(size):
            prefix[:, j + 1] = prefix[:, j] * _BASE + codes[:, j]
        scores = np.full((rows, size + 1, longest + 1), -np.inf)
        ids = np.full((rows, size + 1, longest + 1), -1, np.int32)
        for n in range(1, longest + 1):
            hashes = prefix[:, n:] - prefix[:, : size + 1 - n] * np.uint64(pow(int(_BASE), n, 1 << 64))
            place = np.full(hashes.shape, -1, np.int32)  # the last entry of the piece arrays: no piece
            mixed = hashes * _BASE
            for shift, keys, places in self.tables:
                slots = (mixed >> shift) & _SLOTS
                found = keys[slots] == hashes
                place[found] = places[slots[found]]
            scores[:, n:, n] = self.piece_scores[place]
            ids[:, n:, n] = self.piece_ids[place]
        return scores, ids

    def _many(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Best scores, losses of the second best and best ids of these chunks of one length."""
        size = len(chunks[0])
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        scores, ids = self._edges(codes.reshape(len(chunks), size).astype(np.uint64))
        longest = scores.shape[2] - 1
        every = np.arange(len(chunks))
        best = np.zeros((len(chunks), size + 1))
        step = np.zeros((len(chunks), size + 1), np.int64)
        for end in range(1, size + 1):
            lengths = np.arange(1, min(end, longest) + 1)
            totals = best[:, end - lengths] + scores[:, end, lengths]
            best[:, end] = totals.max(1)
            equal = totals == best[:, end, None]  # of equal ones the piece with the smallest id, as in the search
            step[:, end] = np.where(equal, ids[:, end, lengths], _NO_ID).argmin(1) + 1
        path = np.zeros((len(chunks), size), np.int32)  # filled from the right
        begins = np.full(len(chunks), size)
        alone = scores.copy()  # edges that aren't on the best path
        at = np.full(len(chunks), size)
        while (left := every[at > 0]).size:
            ends, n = at[left], step[left, at[left]]
            begins[left] -= 1
            path[left, begins[left]] = ids[left, ends, n]
            alone[left, ends, n] = -np.inf
            at[left] = ends - n
        behind = np.full((len(chunks), size + 1), -np.inf)
        behind[:, size] = 0.0
        second = np.full(len(chunks), -np.inf)
        for end in range(size, 0, -1):
            lengths = np.arange(1, min(end, longest) + 1)
            tails = behind[:, end, None]
            second = np.maximum(second, (best[:, end - lengths] + alone[:, end, lengths] + tails).max(1))
            behind[:, end - lengths] = np.maximum(behind[:, end - lengths], scores[:, end, lengths] + tails)
        whole, width = path.tobytes(), 4 * size
        found = [whole[row * width + 4 * begin : (row + 1) * width] for row, begin in enumerate(begins.tolist())]
        return best[:, size], best[:, size] - second, found

    def forget(self, rows: int = 0) -> None:
        self.place = _Places()
        self.best, self.loss = np.zeros(max(TABLE_ENTRIES, rows)), np.zeros(max(TABLE_ENTRIES, rows))
        self.ids: list[bytes] = []

    def _learn(self, new: list[str]) -> None:
        """Fill the table's next rows, one for each of these chunks."""
        first = len(self.ids)
        end = first + len(new)
        if end > len(self.best):
            self.best, self.loss = (np.concatenate([x, np.zeros(end - len(x))]) for x in (self.best, self.loss))
        self.ids += [b""] * len(new)
        of_length = defaultdict(list)
        for n, c in enumerate(new, first):
            if len(c) > pieces.KEEP_CHARS or not self.characters.issuperset(c):
                self.best[n], ids, self.loss[n] = self.entry(c)  # long, or with characters that have no piece
                self.ids[n] = np.array(ids, np.int32).tobytes()
            else:
                of_length[len(c)].append(n)
        for size, numbers in of_length.items():
            rows = max(1, _BLOCK_CELLS // (size * min(size, self.vocabulary.longest)))
            for start in range(0, len(numbers), rows):
                part = numbers[start : start + rows]
                self.best[part], self.loss[part], ids = self._many([new[n - first] for n in part])
                for n, own in zip(part, ids, strict=True):
                    self.ids[n] = own

    def places(self, parts: list[list[str]]) -> list[np.ndarray]:
        """Where the chunks of each list stand in the table; unknown ones are put into it.

        A table with more than ``TABLE_ENTRIES`` rows first forgets the others.
        """
        if len(self.place) > TABLE_ENTRIES:
            kept = [c for c in set().union(*parts) if c in self.place]
            at = [self.place[c] for c in kept]
            best, loss, ids = self.best[at], self.loss[at], [self.ids[i] for i in at]
            self.forget(len(kept))
            self.place.update(zip(kept, range(len(kept)), strict=True))
            self.best[: len(kept)], self.loss[: len(kept)], self.ids = best, loss, ids
        sizes = [len(p) for p in parts]
        try:
            at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(parts)), np.int64, sum(sizes))
            self._learn(self.place.new)
            self.place.new = []
        except BaseException:
            self.forget()  # a half-filled table must not be used by the next task
            raise
        return np.split(at, np.cumsum(sizes)[:-1]) if parts else []

    def best_ids(self, places: np.ndarray) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.ids.__getitem__, places.tolist())), np.int32)

    def combined(self, chunks: list[str], places: np.ndarray) -> list[tuple[float, dict[int, tuple[int, ...]]]]:
        """The N smallest total losses, each with the chunks that differ from the best.

        Only the N - 1 chunks with the smallest losses can differ: replacing any
        other difference by an unused one of these never makes the loss larger.
        So only these are searched for more than their best.
        """
        losses = self.loss[places]
        combos: list[tuple[float, dict]] = [(0.0, {})]
        for k in map(int, _smallest(losses, min(self.n - 1, len(losses)))):
            if losses[k] == np.inf:
                break
            (score, _), *others = self.search(chunks[k])
            more = [(loss + (score - x), {**other, k: ids}) for loss, other in combos for x, ids in others]
            combos = sorted(combos + more, key=lambda c: (c[0], sorted(c[1].items())))[: self.n]
        return combos

    def nbest(self, text: str | None) -> list[tuple[float, list[int]]]:
        """The N best segmentations of a text as (score, ids); one empty one for an empty text."""
        chunks = self.vocabulary.chunks(text or "")
        places = self.places([chunks])[0]
        best, ids = float(self.best[places].sum()), [np.frombuffer(self.ids[p], np.int32).tolist() for p in places]
        return [
            (best - loss, list(chain.from_iterable(other.get(k, own) for k, own in enumerate(ids))))
            for loss, other in self.combined(chunks, places)
        ]


def _smallest(values: np.ndarray, n: int) -> np.ndarray:
    """Indices of the ``n`` smallest values, by value, then index."""
    if n <= 0:
        return np.empty(0, np.int64)
    limit = np.partition(values, n - 1)[n - 1]
    at = np.flatnonzero(values <= limit)
    return at[np.argsort(values[at], kind="stable")][:n]


@lru_cache(maxsize=4)
def codec(model_path: str, n_best: int = N_BEST) -> Codec:
    return Codec(model_path, n_best)


def encode(docs: DataFrame, model_path: str, n_best: int = N_BEST, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, ids, n_pieces, scores, round_trip``.

    ``ids`` is the best segmentation, ``scores`` has those of the N best (fewer
    if the lattice has fewer paths), best first.  ``round_trip`` tells whether
    decoding gives the text back, U+2581 read as a space.  A null text counts
    as empty: no ids, one score of 0.  Repeated rows and null ids get a row
    each; an empty table gives an empty one; other columns are ignored.
    """
    need_columns(docs, id_col, text_col)

    def encoded(texts: list[str | None]) -> list[tuple]:
        c, rows = codec(model_path, n_best), []
        texts = [t or "" for t in texts]
        parts = [c.vocabulary.chunks(t) for t in texts]
        for text, chunks, places in zip(texts, parts, c.places(parts), strict=True):
            best, ids = float(c.best[places].sum()), c.best_ids(places)
            scores = [best - loss for loss, _ in c.combined(chunks, places)]
            same = c.vocabulary.decode(ids.tolist()) == text.replace(pieces.SPACE, " ")
            rows.append((ids, len(ids), scores, same))
        return rows

    fields = {"ids": pa.list_(pa.int32()), "n_pieces": pa.int64(), "scores": pa.list_(pa.float64()), "round_trip": pa.bool_()}
    # workers live on and do other stages' work: the table goes with the task
    return map_rows(docs, {"doc_id": F.col(id_col)}, [F.col(text_col)], fields, encoded, _BATCH,
                    done=lambda: codec(model_path, n_best).forget())


def encode_nbest(docs: DataFrame, model_path: str, n_best: int = N_BEST, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, rank, score, ids`` for each of the N best segmentations (rank from 0)."""
    need_columns(docs, id_col, text_col)

    @F.pandas_udf("array<struct<score:double,ids:array<int>>>")
    def encoded(texts: pd.Series) -> pd.Series:
        c = codec(model_path, n_best)
        return pd.Series([[{"score": s, "ids": ids} for s, ids in c.nbest(t)] for t in texts], dtype=object)

    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(encoded(F.col(text_col))).alias("rank", "e")).select(
        "doc_id", "rank", F.col("e.score").alias("score"), F.col("e.ids").alias("ids"))


def decode(tokens: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text``: the text of each sequence of ids (null ids give a null text)."""
    need_columns(tokens, id_col, ids_col)

    @F.pandas_udf("string")
    def decoded(series: pd.Series) -> pd.Series:
        v = pieces.vocabulary(model_path)
        return pd.Series([None if x is None else v.decode([int(i) for i in x]) for x in series], dtype=object)

    return tokens.select(F.col(id_col).alias("doc_id"), decoded(F.col(ids_col)).alias("text"))
