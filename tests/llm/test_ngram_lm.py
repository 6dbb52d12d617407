"""The count filter, and scores against a plain probe of the same bits."""

import math
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from coldshelf.llm import ngram_lm
from coldshelf.llm.textops import Words, flat

MASK = (1 << 64) - 1


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def model(docs):
    return ngram_lm.learn(docs)


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def plain_level(bits, gram, segments):
    """The level of an n-gram, bit by bit."""
    base = mix(gram + 1 & MASK)
    key, segment = base & (1 << 40) - 1, (base >> 40) % segments
    size, start = int(bits.size[segment]), int(bits.start[segment])
    level = 0
    while size:
        own = mix(key + (level + 1) * 0x9E3779B97F4A7C15 & MASK)
        step = own >> 32 | 1
        places = [(own + step * i & MASK) % size for i in range(ngram_lm.PROBES)]
        if not all(bits.data[start + p // 8] >> p % 8 & 1 for p in places):
            break
        level += 1
    return level


def test_scores_are_probes_of_the_filter(docs, model):
    bits = model.bits()
    estimate = lambda level: 1.5 * 2.0 ** (level - 1) if level > 1 else float(level)
    found = {r.doc_id: r for r in ngram_lm.scored(docs, model).collect()}
    texts = dict(duckdb.execute("SELECT doc_id, coalesce(text, '') FROM '/root/testdata/sf0.001/documents.parquet'").fetchall())
    for doc_id in sorted(texts)[:40]:
        words = Words(*flat(pa.array([texts[doc_id]])))
        hashes = [-2 & MASK, *words.hash.tolist(), -1 & MASK]
        total = 0.0
        for before, now in zip(hashes, hashes[1:]):
            gram = mix((mix(before + 0x9E3779B97F4A7C15 & MASK) * 0xD1342543DE82EF95 + now) & MASK)
            pair, first, single = (
                estimate(plain_level(bits, g, model.segments)) for g in (gram, *(mix(h ^ 0x5851F42D4C957F2D) for h in (before, now)))
            )
            kinds = model.distinct - 1 + 2
            alone = (single + ngram_lm.ADD) / (model.tokens + ngram_lm.ADD * kinds + 1)
            own = ngram_lm.WEIGHT * min(pair, first) / (first + ngram_lm.HALF)
            total += math.log10(own + (1 - ngram_lm.WEIGHT * first / (first + ngram_lm.HALF)) * alone)
        assert math.isclose(found[doc_id].score, total, rel_tol=1e-9)


def test_a_joined_filter_gives_the_same_scores(docs, model):
    assert model.size > 0
    rows = [sorted(map(tuple, ngram_lm.scored(docs, model, size).collect())) for size in (model.size, model.size - 1)]
    assert rows[0] == rows[1]


def test_segments_do_not_change_exact_counts(spark, docs):
    texts = docs.filter(~ngram_lm.held_out())
    few, many = (ngram_lm.count_filter(ngram_lm.gathered(texts, n), n) for n in (1, 37))
    assert (few.tokens, few.distinct) == (many.tokens, many.distinct)
    assert many.table.count() == 37
    base = [{r.doc_id: (r.n_known, r.base_score) for r in ngram_lm.scored(docs, m).collect()} for m in (few, many)]
    assert base[0] == base[1]


def test_count_filter_keeps_levels(spark):
    rng = np.random.default_rng(4)
    grams = rng.choice(1 << 40, 30_000, replace=False)
    counts = rng.geometric(0.3, 30_000) * rng.integers(1, 50, 30_000)
    rows = ngram_lm._counted(grams, counts, grams[:0], counts[:0], 3)
    filtered = ngram_lm.count_filter(spark.createDataFrame(pa.Table.from_batches([rows])), 3)
    bits = filtered.bits()

    def count(some):
        return ngram_lm._estimates(bits.levels(*ngram_lm._keys(some, 3)))

    found = count(grams)
    level, stored = ngram_lm.levels(counts), ngram_lm.levels(np.maximum(found, 0.5) + 0.1)
    kept = counts >= 2
    assert (found[kept] >= np.where(level[kept] > 1, 1.5 * 2.0 ** (level[kept] - 1), 1)).all()  # never too low
    assert (stored[kept] == level[kept]).mean() > 0.98
    assert (count(rng.choice(1 << 40, 30_000) | 1 << 50) > 0).mean() < 0.02
    # Twelve bits an entry, as many as there are.
    assert abs(filtered.size * 8 - 12 * level[kept].sum()) <= 3 * 8


def test_keys_pack():
    keys = np.array([0, 1, (1 << 40) - 1, 123_456_789_012], np.uint64)
    assert len(ngram_lm._packed(keys)) == 20
    assert (ngram_lm._unpacked(ngram_lm._packed(keys)) == keys).all()


def grams_of(text):
    """The pairs and single words of a text, ends included, with its begin."""
    words = Words(*flat(pa.array([text]))).hash.view(np.int64)
    before, now = np.array([-2, *words]), np.array([*words, -1])
    return ngram_lm._bigrams(before, now), ngram_lm._singles(np.array([-2, *words, -1]))


def test_the_model_holds_what_is_seen_once(spark):
    learned = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10][:2]
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    words = [f"w{i}" for i in range(2000)]
    # Every word of the first text is seen once, and every pair; the second repeats one word.
    texts = [" ".join(words), "often " * 500, "w7 w8 w9", "w7 w9 w8"]
    docs = spark.createDataFrame(list(zip([*learned, *held], texts)), "doc_id long, text string")
    model = ngram_lm.learn(docs)
    bits = model.bits()
    for grams in grams_of(texts[0]):
        assert (bits.levels(*ngram_lm._keys(grams, model.segments)) >= 1).all()
    for size in (ngram_lm.BROADCAST_BYTES, 0):  # the bits at hand, or asked by a join
        found = {r.doc_id: r for r in ngram_lm.scored(docs, model, size).collect()}
        assert found[held[0]].n_known == found[held[1]].n_known == 4
        # The first holds two pairs that were seen once, the second none.
        assert found[held[0]].score > found[held[1]].score + 1


def test_a_model_of_words_seen_once_holds_their_counts(spark):
    learned = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10)
    docs = spark.createDataFrame([(learned, "one two three"), (None, None)], "doc_id long, text string")
    model = ngram_lm.learn(docs)
    assert model.size > 0
    for grams in grams_of("one two three"):
        level = model.bits().levels(*ngram_lm._keys(grams, model.segments))
        assert (ngram_lm._estimates(level) >= 1).all()
