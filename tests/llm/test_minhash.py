"""Comparing leftover neighbours by their sketches."""

import numpy as np
import pytest

from coldshelf.llm import minhash
from coldshelf.llm.components import components


def plain_estimate(x, y, settings):
    planes = settings.planes
    unequal = 0
    for word in range(planes):
        differ = 0
        for bit in range(minhash.BITS):
            differ |= (int(x[bit * planes + word]) ^ int(y[bit * planes + word])) & ((1 << 64) - 1)
        unequal += bin(differ).count("1")
    chance = 2.0**-minhash.BITS
    return (1 - unequal / settings.hashes - chance) / (1 - chance)


@pytest.fixture(scope="module")
def sketches():
    rng = np.random.default_rng(3)
    base = rng.integers(-(1 << 63), (1 << 63) - 1, (6, minhash.BITS * minhash.Settings().planes))
    rows = []
    for center in base:
        for flips in (0, 1, 8, 20, 120):
            row = center.copy()
            for _ in range(flips):
                i, b = rng.integers(0, len(row)), int(rng.integers(0, 63))
                row[i] ^= 1 << b
            rows.append(row)
    return np.array(rows)


def test_members_with_a_likely_partner_in_another_component(sketches):
    settings = minhash.Settings()
    component = np.arange(len(sketches)) // 2
    least = settings.percent / 100 - settings.slack
    expected = [
        i
        for i, x in enumerate(sketches)
        if any(component[i] != component[j] and plain_estimate(x, y, settings) >= least for j, y in enumerate(sketches))
    ]
    assert minhash._likely_members(sketches, component, settings).tolist() == expected
    assert 0 < len(expected) < len(sketches)


def test_strangers_have_no_likely_partner():
    rng = np.random.default_rng(1)
    strangers = rng.integers(-(1 << 63), (1 << 63) - 1, (512, minhash.BITS * minhash.Settings().planes))
    assert not len(minhash._likely_members(strangers, np.arange(512), minhash.Settings()))


def test_spark_estimates_the_same(spark, sketches):
    settings = minhash.Settings()
    rows = [(x.tolist(), y.tolist()) for x in sketches[:8] for y in sketches[8:16]]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>").select(minhash.estimate("a", "b", settings).alias("e"))
    assert [r.e for r in df.collect()] == pytest.approx([plain_estimate(x, y, settings) for x, y in rows])


def test_leftovers_are_linked_whatever_their_sketches_signs(spark):
    # A bucket whose members are linked in pairs only: all of them share a few shingles with a centre.
    words = [f"w{i}" for i in range(400)]
    texts = []
    for k in range(30):
        own = [f"x{k}_{i}" for i in range(60)]
        text = words[:40] + own
        texts += [" ".join(text), " ".join([*text, "tail"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert found == {i: i - i % 2 for i in range(len(texts))}


def test_few_edges_take_few_files(spark):
    # A path of 300 nodes over 48 shuffle partitions, which is a file for each without a count of the edges.
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "u long, v long")
        found = components(edges)
        assert {r.node: r.component for r in found.collect()} == dict.fromkeys(range(301), 0)
        assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
