"""Operator 5: ids against the tokenizer, a valid and tight packing, defined cases."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lodestar.llm import packing
from tests.llm.common import edge_docs, no_docs, rows_of, sf_docs

PATH = packing.default_tokenizer()
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("which", ["sf", "edge"])
def test_pieces_and_sequences(spark, which):
    docs = sf_docs(spark) if which == "sf" else edge_docs(spark)
    rows = packing.packed(docs, PATH).collect()
    want, sequences = [], defaultdict(list)
    for d, t in rows_of(docs):
        ids = np.array(ids_of(t), "<u4")
        want += [(d, k, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes()))
                 for k, at in enumerate(range(0, len(ids), 2048))]
    got = [(r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_empty(spark):
    assert packing.packed(no_docs(spark), PATH).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abZ é ß İſΣς한é\u0085\x1c\n\t\r\v\f'st!?.,;:<|>09٣́‍字😀")), max_size=30),
                min_size=1, max_size=4))
def test_word_ids_equal_text_ids(texts):
    ids, begin = packing.token_ids(pa.array(texts, pa.large_string()), PATH)
    assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])] == [ids_of(t) for t in texts]


@pytest.mark.parametrize("text", ["<|endoftext|>.", "A<|ENDOFTEXT|>", "<|startoftext|>x it's I'LL, end.", "a.b. c!?"])
def test_special_strings(text):
    assert packing.token_ids(pa.array([text], pa.large_string()), PATH)[0].tolist() == ids_of(text)


def optimal(lengths, capacity):
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.values():
            place(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1:])
        place(i + 1, rooms + [capacity - lengths[i]])
    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bin_completion_is_valid_and_nearly_optimal(lengths):
    bins = packing.bin_completion(lengths, 20)
    assert sorted(x for b in bins for x in b) == sorted(lengths) and max(map(sum, bins)) <= 20
    assert len(bins) <= len(packing.best_fit(lengths, 20))
    assert len(bins) <= optimal(lengths, 20) + 1


def test_bin_completion_improves_on_best_fit():
    rng = np.random.default_rng(1)
    better = 0
    for _ in range(10):
        lengths = rng.integers(1, 2048, 300).tolist()
        better += len(packing.bin_completion(lengths)) < len(packing.best_fit(lengths, 2048))
    assert better


def test_slices_are_whole_and_apart():
    rows = [f"Über {i} " + "Xé" * (i % 70) for i in range(3000)] + [None, ""]
    got, at = [], 0
    for b, e, texts in packing.text_slices(pa.array(rows), 5000):
        assert b == at
        at = e
        ids, begin = packing.token_ids(texts, PATH)
        got += [ids[i:j].tolist() for i, j in zip(begin[:-1], begin[1:])]
    assert at == len(rows) and got == [ids_of(t) for t in rows]
