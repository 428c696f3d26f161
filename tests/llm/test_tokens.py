import random

import numpy as np
import pytest

from icdspark.llm import pieces, sentencepiece_codec as codec, token_counts as counts
from icdspark.llm.queries import op2_sentencepiece, op6_token_counts, piece_model

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  a ", "\n", "x² .²", "▁▁y ▁", "a\0b", "中🎉x", "é́", "  \n\n   z", "<s> </s><unk> <0x0A>",
       "a\tb\r\nc", "x" * 300, " " * 50 + "q", "snake_case_name(_x)", "12 345,678.9", "    ﻿"]


@pytest.fixture(scope="module")
def counter():
    return counts.PrefixCounter(piece_model())


def test_query_equals_the_library(spark, texts, counter):
    library = counter.vocabulary.processor
    rows = op6_token_counts(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["n_tokens"] == len(library.encode(text)) and r["n_bytes"] == len(text.encode())
        assert r["over_limit"] == (r["n_tokens"] > 4096)


def test_chunks_equal_the_whole(counter):
    for text in ODD:
        _, tokens = counter.ends(counter.vocabulary.chunks(text))
        assert (tokens[-1] if len(tokens) else 0) == len(counter.vocabulary.processor.encode(text)), repr(text)


def test_every_prefix_is_exact(counter, texts):
    sample = [t[:300] for t in list(texts.values())[:10]] + ODD
    for text in sample:
        library = [len(x) for x in counter.vocabulary.processor.encode([text[:k] for k in range(len(text) + 1)])]
        assert list(counter.prefix_counts(text)) == library, repr(text)


def test_truncation_is_the_longest_prefix(counter, make):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdeè,") for _ in range(rng.randint(1, 12))) for _ in range(60))
    table = counter.prefix_counts(text)
    for budget in (0, 1, 2, 7, 50, 51, 10_000):
        longest = int(np.flatnonzero(table <= budget)[-1])
        got = counts.truncate(make([(1, text)]), piece_model(), budget).first()["text"]
        assert got == text[:longest]


def test_vocabulary_is_checked(monkeypatch):
    monkeypatch.setattr(pieces, "COARSE", __import__("re").compile(r"\w|\W"))
    with pytest.raises(ValueError):
        pieces.Vocabulary(piece_model())


def all_paths(c, chunk):
    out = []

    def walk(at, score, ids):
        if at == len(chunk):
            out.append((-score, ids))
            return
        if chunk[at] not in c.edge_of:
            more, own = c.unknown(chunk[at])
            walk(at + 1, score + more, ids + own)
        for end in range(at + 1, len(chunk) + 1):
            edge = c.edge_of.get(chunk[at:end])
            if edge:
                walk(end, score + edge[0], ids + edge[1])

    walk(0, 0.0, ())
    return sorted(out)


def test_n_best_equal_all_paths():
    c = codec.Codec(piece_model(), 5)
    for chunk in [" thereof", "ation", " a", "x", "  ab", "中x", "🎉é", ",.!", " été"]:
        best = all_paths(c, chunk)
        got = c.search(chunk)
        assert [s for s, _ in got] == [-s for s, _ in best[:5]]
        assert got[0][1] == best[0][1] == c.entry(chunk)[1]
        assert c.entry(chunk)[2] == (best[1][0] - best[0][0] if len(best) > 1 else np.inf)


def test_n_best_of_a_text_combine_its_chunks():
    c = codec.Codec(piece_model(), 6)
    for text in ("the red fox", "a, b", "on it"):
        best = all_paths(c, " " + text)
        got = c.nbest(text)
        assert [s for s, _ in got] == [-s for s, _ in best[:6]]
        assert len({tuple(ids) for _, ids in got}) == len(got)
        assert all(c.vocabulary.decode(ids) == text for _, ids in got)


def test_query_round_trips(spark, texts):
    rows = op2_sentencepiece(spark, SF).collect()
    assert len(rows) == len(texts)
    v = pieces.vocabulary(piece_model())
    for r in rows:
        assert r["round_trip"] and r["n_pieces"] == len(r["ids"]) and sorted(r["scores"], reverse=True) == r["scores"]
        assert v.processor.decode(list(r["ids"])) == texts[r["doc_id"]]


def test_decoding_equals_the_library():
    v = pieces.vocabulary(piece_model())
    c = codec.Codec(piece_model())
    for text in ODD:
        ids = c.nbest(text)[0][1]
        assert v.decode(ids) == text.replace("▁", " ")
        assert v.decode(v.processor.encode(text)) == v.processor.decode(v.processor.encode(text))


def test_odd_rows(odd_docs, no_docs):
    for out in (counts.count_tokens(odd_docs, piece_model()), codec.encode(odd_docs, piece_model())):
        rows = out.collect()
        assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in codec.encode(odd_docs, piece_model()).collect()}
    assert by[1]["ids"] == [] and by[1]["scores"] == [0.0] and by[2]["n_pieces"] == 0
    assert all(r["round_trip"] for r in by.values())
    assert counts.count_tokens(no_docs, piece_model()).collect() == []
    assert codec.encode(no_docs, piece_model()).collect() == []


def test_decode_operator(make, texts):
    rows = list(texts.items())[:20]
    encoded = codec.encode(make(rows), piece_model()).select("doc_id", "ids")
    assert {r["doc_id"]: r["text"] for r in codec.decode(encoded, piece_model()).collect()} == dict(rows)
    best = codec.encode_nbest(make([(1, "the fox"), (2, "")]), piece_model(), 3).collect()
    assert [(r["doc_id"], r["rank"]) for r in best] == [(1, 0), (1, 1), (1, 2), (2, 0)]


def test_a_full_table_is_cut_to_the_batch(monkeypatch, texts):
    monkeypatch.setattr(codec, "TABLE_ENTRIES", 50)
    small, large = codec.Codec(piece_model()), codec.Codec(piece_model())
    monkeypatch.setattr(codec, "TABLE_ENTRIES", 300_000)
    for some in (list(texts.values())[:8], list(texts.values())[4:12]):
        parts = [small.vocabulary.chunks(t) for t in some]
        monkeypatch.setattr(codec, "TABLE_ENTRIES", 50)
        at = small.places(parts)
        monkeypatch.setattr(codec, "TABLE_ENTRIES", 300_000)
        for chunks, places, other in zip(parts, at, large.places(parts), strict=True):
            assert (small.best[places] == large.best[other]).all() and (small.loss[places] == large.loss[other]).all()
            assert (small.best_ids(places) == large.best_ids(other)).all()
    assert len(small.place) < len(large.place)
