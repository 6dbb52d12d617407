"""Merging many pre-tokens side by side against one at a time."""

import random

import numpy as np
import pytest

from coldshelf.llm import bpe
from coldshelf.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def encoder():
    return bpe.Bpe(*bpe.load_vocabulary(vocabulary_path()))


def test_side_by_side_is_one_by_one(encoder, monkeypatch):
    random.seed(5)
    strings = ["", "a", "\0", "\0\0", "é" * 32, "x" * 64, "x" * 65, "ab" * 300]
    strings += ["".join(random.choices("aehinorst é日\0", k=random.randint(1, 80))) for _ in range(800)]
    expected = [encoder.merge(s) for s in strings]
    size = np.array([len(s.encode()) for s in strings])
    data = np.frombuffer("".join(strings).encode(), np.uint8)
    monkeypatch.setattr(bpe, "_CELLS", 256)  # several blocks of a width
    heaps, plain = [], encoder._merge
    monkeypatch.setattr(encoder, "_merge", lambda pretoken: heaps.append(len(pretoken)) or plain(pretoken))
    ids, each = encoder.merge_all(data, np.cumsum(size) - size, size)
    ends = np.cumsum(each)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, each)] == expected
    # Only long ones have a heap of their own.
    assert heaps and min(heaps) > bpe.WIDTHS[-1]


def test_pairs_of_a_vocabulary_whose_merges_go_astray():
    # A merge whose result merges with a lower rank: the queue takes what is least by then.
    letters = {sign: i for i, sign in enumerate(bpe.byte_strings())}
    vocabulary = letters | {"ab": 256, "abc": 257, "cd": 258, "bc": 259}
    merges = [("ab", "c"), ("b", "c"), ("c", "d"), ("a", "b")]
    odd = bpe.Bpe(vocabulary, merges, {})
    texts = ["abcd", "abab", "bcbc", "abc", "dcba", "aabbccdd", "cdcd"]
    size = np.array([len(t) for t in texts])
    ids, each = odd.merge_all(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum(size) - size, size)
    ends = np.cumsum(each)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, each)] == [odd.merge(t) for t in texts]
