"""Licence scan with a positional rare-token index.

Templates are short licence notices as word sequences, each with a mandatory key
phrase.  The index posts every word of every notice with its offset, weighted by
its rarity in the corpus (IDF).  A file's licence words are looked up from the
rarest on.  A word proposes, for each template that has it in its key phrase,
the starts at which it would stand in place; they are intersected, by relative
position, with those of the template's next rarest key words in the file, and
what is left is verified word by word against the key phrase.  All words of a
phrase stand in place where it occurs, so no place is lost.  The notice's other
words, by their postings at the same start, give the score.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icdspark.llm.common import map_rows, need_columns

# Phrases and labels that the base scan reports.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: (label, key phrase, notice that holds the key phrase once)
NOTICES = (
    ("gpl", "gnu general public license",
     "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license",
     "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "gnu affero general public license",
     "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge",
     "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("cc-by", "cc by", "licensed under cc by 4 0"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc-by", "creative commons attribution", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "cc0 1 0", "released under cc0 1 0 universal public domain dedication"),
    ("bsd", "bsd license", "released under the bsd license"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "mozilla public license", "this file is subject to the terms of the mozilla public license v 2 0"),
)

#: A-Z to a-z; ASCII letters, digits and all bytes of other characters stay; the rest becomes a space.
_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def _split(phrase: str) -> list[bytes]:
    return phrase.encode().split()


LICENCE_WORDS = frozenset(w for _, _, notice in NOTICES for w in _split(notice)) | frozenset(
    w for phrase in BASE_PHRASES for w in _split(phrase))


#: Key words of a template whose proposed starts are intersected before the phrase is verified.
INTERSECTED = 3


class Template:
    """One notice: its words and weights, and where its key phrase starts."""

    def __init__(self, label: str, key: str, notice: str, idf: Mapping[bytes, float]):
        self.label, self.base = label, BASE_PHRASES.get(key) == label
        self.words, self.key = _split(notice), _split(key)
        n = len(self.key)
        self.key_at = next(i for i in range(len(self.words) - n + 1) if self.words[i : i + n] == self.key)
        self.weights = [idf[w] for w in self.words]
        self.total = sum(self.weights)
        #: The key phrase's words as (word, offset in the notice), the rarest first.
        self.rarest = sorted(((w, self.key_at + i) for i, w in enumerate(self.key)), key=lambda x: (-idf[x[0]], x[1]))


class Index:
    """Postings (template, offset) of all notice words, and their rarity in the corpus."""

    def __init__(self, doc_counts: Mapping[bytes, int], n_docs: int):
        self.idf = {w: math.log((n_docs + 1) / (doc_counts.get(w, 0) + 1)) + 1.0 for w in LICENCE_WORDS}
        self.postings: dict[bytes, list[tuple[Template, int]]] = defaultdict(list)
        for label, key, notice in NOTICES:
            t = Template(label, key, notice, self.idf)
            for offset, word in enumerate(t.words):
                self.postings[word].append((t, offset))

    def _starts(self, t: Template, places: Mapping[bytes, list[int]]) -> set[int]:
        """Where the notice would start, as far as its rarest key words agree."""
        (word, offset), *others = t.rarest
        starts = {at - offset for at in places[word]}
        for word, offset in others[: INTERSECTED - 1]:
            starts.intersection_update([at - offset for at in places[word]])
        return starts

    def places(self, words: list[bytes]) -> Iterator[tuple[Template, int, float]]:
        """(template, start of its key phrase, weighted share of its words that stand in place)."""
        own: dict[bytes, list[int]] = {}
        for at, word in enumerate(words):
            if word in LICENCE_WORDS:
                own.setdefault(word, []).append(at)
        for word in sorted(own, key=lambda w: (-self.idf[w], w)):
            for t, offset in self.postings[word]:
                # a template's turn comes with its rarest key word; without the other ones its phrase can't be there
                if t.rarest[0] != (word, offset) or any(w not in own for w in t.key):
                    continue
                for first in sorted(self._starts(t, own)):
                    start = first + t.key_at
                    if start < 0 or words[start : start + len(t.key)] != t.key:
                        continue
                    there = sum(
                        weight for i, weight in enumerate(t.weights)
                        if 0 <= first + i < len(words) and words[first + i] == t.words[i]
                    )
                    yield t, start, there / t.total


def document_counts(docs: DataFrame, text_col: str = "text") -> tuple[dict[bytes, int], int]:
    """In how many rows each licence word occurs, and the number of rows.

    The result has one entry for each word of the fixed notices.
    """
    need_columns(docs, text_col)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, rows = Counter(), 0
        for batch in batches:
            for text in batch.iloc[:, 0]:
                rows += 1
                counts.update(LICENCE_WORDS.intersection(words_of(text)))
        counts[b""] = rows
        yield pd.DataFrame({"word": [w.decode() for w in counts], "n": list(counts.values())})

    found = {
        row["word"].encode(): row["n"]
        for row in docs.select(text_col).mapInPandas(counted, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).collect()
    }
    return found, found.pop(b"", 0)


def scan_text(index: Index, text: str | None) -> tuple:
    words = words_of(text)
    base, labels, score, n_base, first, last = set(), set(), 0.0, 0, None, None
    for t, start, share in index.places(words):
        labels.add(t.label)
        score = max(score, 1.0 if t.base else share)
        if t.base:
            base.add(t.label)
            n_base += 1
            first = start if first is None else min(first, start)
            last = start if last is None else max(last, start)
    return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is the best weighted share of a verified notice, 1 for a base
    phrase, 0 without any.  A null text counts as empty: no words, no places,
    null first and last word, empty labels.  Repeated rows and null ids get a
    row each; an empty table gives an empty one; other columns are ignored.
    """
    need_columns(docs, id_col, text_col)
    counts, n_docs = document_counts(docs, text_col)
    index = Index(counts, n_docs)
    long, string = pa.int64(), pa.string()
    fields = {"n_words": long, "n_base": long, "first_word": long, "last_word": long, "base_labels": string,
              "labels": string, "score": pa.float64()}
    return map_rows(docs, {"doc_id": F.col(id_col)}, [F.col(text_col)], fields,
                    lambda texts: [scan_text(index, t) for t in texts])
