"""Schedules of packing, and mixtures of few and of very many sources."""

import collections
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from coldshelf.llm import packing
from coldshelf.llm.bpe import Bpe, load_vocabulary
from coldshelf.llm.cluster import written
from coldshelf.llm.queries import vocabulary_path

ENCODERS = [kind(*load_vocabulary(vocabulary_path())) for kind in (Bpe, packing.LibraryBpe)] + [Tokenizer.from_file(vocabulary_path())]


def places(plan, queue, begin, end):
    return plan.places(queue, np.array([begin]), np.array([end]))


@pytest.mark.parametrize("weights", [None, [0.7, 0.2, 0.1], [0.0, 1.0, 0.0], [1e-9, 1.0, 0.0]])
def test_schedule_serves_every_token_once(weights):
    totals = [1000, 5000, 37]
    plan = packing.Schedule(totals, weights, 64)
    seen = np.zeros(sum(totals), int)
    for queue, total in enumerate(totals):
        at = 0
        for size in (1, 7, total - 8):
            _, start, length, place = places(plan, queue, at, at + size)
            assert start[0] == at and (start[1:] == start[:-1] + length[:-1]).all() and length.sum() == size
            for p, n in zip(place, length):
                seen[p : p + n] += 1
            at += size
    assert (seen == 1).all()
    wide = packing.Schedule([t << 34 for t in totals], weights, 64)
    assert places(wide, 1, 5 << 34, (5 << 34) + 9)[2].sum() == 9


def test_many_queues_have_few_phases():
    rng = random.Random(3)
    totals = [rng.randint(1, 10_000) for _ in range(3000)]
    plan = packing.Schedule(totals, [rng.random() for _ in totals], 2048)
    assert len(plan.base) < 64
    done = plan.served(np.arange(plan.edges[-1] + 1))
    assert (done[-1] == totals).all() and (np.diff(done, axis=0) >= 0).all()
    # Rounds serve half a window at least until the end of a phase, and never more than one.
    each = np.diff(done.sum(axis=1))
    assert each.max() <= 2048 + len(totals)


def test_weights_hold_while_queues_last():
    plan = packing.Schedule([10**6, 10**6, 10**6], [0.5, 0.3, 0.2], 1000)
    done = plan.served(np.arange(1000))
    assert np.abs(np.diff(done, axis=0) - [500, 300, 200]).max() <= 1


def packed(spark, texts, **options):
    """Pieces of (source, text) rows."""
    docs = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(texts)], "doc_id long, source string, text string").repartition(4)
    return packing.pack(docs, vocabulary_path(), **options).collect()


def check_whole(texts, pieces, window):
    bpe = Bpe(*load_vocabulary(vocabulary_path()))
    found = collections.defaultdict(list)
    for p in pieces:
        found[p.doc_id].append(p)
    for i, (source, text) in enumerate(texts):
        own = sorted(found[i], key=lambda p: p.start)
        ids = np.append(bpe.encode([text])[0], 1).astype("<u4")
        assert b"".join(p.ids for p in own) == ids.tobytes()
        assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        assert {p.doc_tokens for p in own} == {len(ids)} and {p.source for p in own} == {source}
    spots = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    at = 0
    for sequence, offset, length in spots:
        assert sequence * window + offset == at and offset + length <= window
        at += length


def test_many_sources_keep_their_proportions_over_windows(spark):
    rng = random.Random(5)
    # Fewer queues than sources: most of them share one.
    sizes = {f"s{k}": rng.choice([200, 400, 2500]) for k in range(300)} | {None: 900, "big": 40_000}
    texts = [(s, " word" * rng.randint(1, 60)) for s, n in sizes.items() for _ in range(-(-n // 30))]
    rng.shuffle(texts)
    pieces = packed(spark, texts, window=256, max_queues=8)
    check_whole(texts, pieces, 256)
    totals, half = collections.Counter(), collections.Counter()
    last = max(p.sequence_id for p in pieces)
    for p in pieces:
        totals[p.source] += p.length
        half[p.source] += p.length if p.sequence_id < (last + 1) / 2 else 0
    for source, total in totals.items():
        assert abs(half[source] - total / 2) <= packing.UNIT + 0.02 * total + 8, source


def test_three_thousand_sources(spark):
    texts = [(f"s{k}", f" text {k}" * 12) for k in range(3000) for _ in range(1 + k % 2)]
    pieces = packed(spark, texts)
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())
    spots = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    assert all(a * 2048 + b + c == d * 2048 + e for (a, b, c), (d, e, _) in zip(spots, spots[1:]))


def shares(pieces, sequence):
    found = collections.Counter()
    for p in pieces:
        if p.sequence_id == sequence:
            found[p.source] += p.length
    return {s: n / sum(found.values()) for s, n in found.items()}


def test_an_absent_source_leaves_its_share_to_all(spark):
    texts = [(s, " word" * 100) for s in "abc" for _ in range(60)]
    got = shares(packed(spark, texts, mixture={"a": 0.2, "x": 0.3}), 0)
    assert got["a"] == pytest.approx(0.2 / 0.7, abs=0.01)
    assert got["b"] + got["c"] == pytest.approx(0.5 / 0.7, abs=0.01) and got["b"] == pytest.approx(got["c"], abs=0.13)


def test_every_source_that_a_mixture_names_has_its_queue(spark):
    texts = [(f"s{k}", " word" * 200) for k in range(40) for _ in range(10)]
    mixture = {f"s{k}": (k + 1) / 820 for k in range(40)}
    got = shares(packed(spark, texts, mixture=mixture, max_queues=4), 0)
    # A round serves up to a token less a queue, and the window's rest is of the next round's first queues.
    assert all(got.get(s, 0) == pytest.approx(w, abs=40 / 2048) for s, w in mixture.items())


@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("ab'sé1,. \t\n\x0b\x1c\x85\xa0\u2003\u3000\0"))), max_size=40), max_size=5))
@settings(max_examples=400, deadline=None)
def test_texts_cut_at_blanks_have_the_ids_of_the_whole(texts):
    texts = [*texts, None, " a  b \n c", "x<|endoftext|>  <|endoftext|> y "]
    ids, bounds = ENCODERS[1].encode_column(pa.array(texts, pa.string()))
    assert bounds[0] == 0 and len(bounds) == len(texts) + 1
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == ENCODERS[2].encode(text or "", add_special_tokens=False).ids


def test_pretokens_with_zero_bytes():
    own, library, _ = ENCODERS
    texts = ["a\0b \0\0 c", "\0", "plain words, and Ā too", "", "日本 🙂\0"]
    assert own.encode(texts)[0].tolist() == library.encode(texts)[0].tolist()


def test_pretokens_reach_the_library_in_bounded_calls(monkeypatch):
    texts = ["a b\0c \0 d\0", "é" * 50 + " 日本", None, "", "hello's world  \n\n x"] * 3 + ["".join(chr(97 + i % 7) for i in range(k)) for k in range(90)]
    own, library, _ = ENCODERS
    ids, bounds = own.encode(texts)
    monkeypatch.setattr(packing, "_MERGED", 5)
    calls = []

    class Counted:
        def encode_batch_fast(self, parts, **options):
            calls.append(parts[0].count("\0"))
            return inner.encode_batch_fast(parts, **options)

    inner = library._library
    monkeypatch.setattr(library, "_library", Counted())
    found, edges = library.encode_column(pa.array(texts, pa.string()))
    assert found.tolist() == ids.tolist() and list(edges) == list(bounds)
    assert len(calls) > 10 and max(calls) < 5


ENCODES = """
import random, pyarrow as pa
from coldshelf.llm import packing
from coldshelf.llm.bpe import load_vocabulary
from coldshelf.llm.queries import vocabulary_path
def mb(key):
    return next(int(line.split()[1]) >> 10 for line in open("/proc/self/status") if line.startswith(key))
bpe, rng = packing.LibraryBpe(*load_vocabulary(vocabulary_path())), random.Random(3)
words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(60000)]
texts = pa.array([" ".join(rng.choices(words, k=500)) for _ in range(3000)])
bpe.encode(["start"])
open("/proc/self/clear_refs", "w").write("5")
base = mb("VmRSS")
for low, high in packing.pieces(texts, packing._ENCODED):
    bpe.encode_column(texts.slice(low, high - low))
print(mb("VmHWM") - base)
"""


@pytest.mark.skipif(not Path("/proc/self/clear_refs").exists(), reason="peak memory is read from Linux")
def test_a_worker_encodes_in_little_memory():
    root = str(Path(packing.__file__).parents[2])
    found = subprocess.run([sys.executable, "-c", ENCODES], cwd=root, capture_output=True, text=True, check=True)
    assert int(found.stdout) < 50


def test_a_worker_is_handed_few_rows_at_a_time(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    rows = spark.range(0, 5000, 1, 1).mapInArrow(run, "n long")
    assert sorted(r.n for r in written(rows, handed=2048).collect()) == [904, 2048, 2048]
    assert spark.conf.get(key) == before
    try:
        spark.conf.set(key, "1000")
        assert {r.n for r in written(rows, handed=2048).collect()} == {1000}
        spark.conf.set(key, "0")  # no limit
        assert max(r.n for r in written(rows, handed=2048).collect()) == 2048
        assert spark.conf.get(key) == "0"
    finally:
        spark.conf.set(key, before)


def test_packing_is_handed_bounded_batches(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(packing, "written", lambda df, **options: asked.append(options) or written(df, **options))
    docs = spark.createDataFrame([(i, "a", f"text {i}") for i in range(50)], "doc_id long, source string, text string")
    usual = sorted(map(tuple, packing.pack(docs, vocabulary_path()).collect()))
    assert asked[0] == {"handed": packing._HANDED}
    monkeypatch.setattr(packing, "_HANDED", 3)
    assert sorted(map(tuple, packing.pack(docs, vocabulary_path()).collect())) == usual
