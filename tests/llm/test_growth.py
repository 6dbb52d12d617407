"""What holds on small tables has to hold on large ones."""

import math
import zlib

import numpy as np
import pytest

from coldshelf.llm import caps, ngram_lm


@pytest.mark.parametrize("vectors, size, pairs", [(10**5, 64, 3000), (10**6, 64, 1000), (10**7, 64, 300), (10**6, 384, 300), (10**6, 16, 300)])
def test_pairs_at_the_threshold_share_a_filter_whatever_the_table(vectors, size, pairs):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(2, pairs, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    layout = caps.Caps.sized(vectors, 0.93, size)
    filters = layout.words**caps.BLOCKS * layout.rotations
    first, second = (row * filters + number for row, number in (caps.decode(u, layout) for u in (x, y)))
    assert len(np.unique(np.intersect1d(first, second) // filters)) == pairs
    each = len(first) / pairs / layout.rotations
    assert 0.8 * caps.EACH < each < 1.3 * caps.EACH  # filters of a vector do not dwindle


def test_words_seen_twice_stay_in_the_model_of_many_tokens(spark):
    learned = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10][:3]
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    texts = ["a " * 6_400_000, "seldom pair", "seldom pair", "seldom pair", "pair seldom"]
    docs = spark.createDataFrame(list(zip([*learned, *held], texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in ngram_lm.scored(docs).collect()}
    assert found[held[0]].score > found[held[1]].score + 3
    assert found[held[0]].n_known == 3 and found[learned[0]].n_tokens == 6_400_001
