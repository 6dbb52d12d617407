"""Token files against the library, brute force, and their own random access."""

import os
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coldshelf.llm import tokenfile
from coldshelf.llm.queries import QUERIES, WORD_END, WORD_VOCABULARY, vocabulary_path

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, n_tokens string, place string, part string"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(WORD_VOCABULARY))


@pytest.fixture(scope="module")
def words():
    with open(vocabulary_path(WORD_VOCABULARY), encoding="utf-8") as file:
        return tokenfile.WordIds(file.read())


@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, (1 << 64) - 1)), max_size=2000))
@settings(max_examples=80, deadline=None)
def test_any_run_of_an_ascending_list_is_selected(values):
    values = np.sort(np.array(values, np.uint64))
    if len(values) and int(values[-1]) > 1 << 40 and len(values) < 3:
        values = values & np.uint64((1 << 40) - 1)
        values.sort()
    found = tokenfile.Ascending(tokenfile.coded(values))
    assert len(found) == len(values)
    assert (found.part(0, len(values)) == values).all()
    for begin in range(0, len(values), 97):
        assert (found.part(begin, begin + 300) == values[begin : begin + 300]).all()
        assert found[begin] == values[begin]
        assert found.first_not_below(int(values[begin])) == np.searchsorted(values, values[begin])


def test_boundaries_take_near_minimal_space():
    rng = np.random.default_rng(1)
    bounds = np.cumsum(rng.integers(1, 900, 100_000))
    size = 8 * len(tokenfile.coded(bounds)) / len(bounds)
    assert size < 2 + np.log2(bounds[-1] / len(bounds)) + 0.3


@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("ab'sSİÉèßſıŉ×÷ªµĀ \t\n\x0b\x1c\x85\xa0́ ​1,.<|>"))), max_size=60))
@settings(max_examples=400, deadline=None)
def test_words_have_the_ids_of_the_whole_text(library, words, text):
    for whole in (text, f"x<|endoftext|>{text} <|startoftext|> 's"):
        ids, sizes = words.encode(pa.array([whole, None]))
        assert ids.tolist() == library.encode(whole, add_special_tokens=False).ids and sizes.tolist() == [len(ids), 0]


def test_query_matches_the_library(spark, library):
    rows = duckdb.execute(f"SELECT doc_id, coalesce(text, '') FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_tokenfile"](spark, SF_DIR).collect()}
    assert len(found) == len(rows)
    start = 0
    for doc_id, text in rows:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, WORD_END], "<u4")
        assert found[doc_id] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)


def test_edges(spark, library):
    long = "word " * 200_000
    rows = [(5, long), (None, "no id"), (3, None), (3, ""), (-(1 << 62), "least"), ((1 << 62) + 7, "most"), (9, "twice"), (9, "twice"), (None, None)]
    path = vocabulary_path(WORD_VOCABULARY)
    files = tokenfile.write(rows_of(spark, rows), path, WORD_END, file_tokens=3)
    found = [tuple(r) for r in tokenfile.read(files).orderBy("start").collect()]
    assert [r[0] for r in found] == [None, None, -(1 << 62), 3, 3, 5, 9, 9, (1 << 62) + 7]
    place = 0
    for _, start, size, ids in found:
        assert (start, len(ids)) == (place, 4 * size)
        place += size
    assert found[5][2] == 200_001 and found[3][2] == found[4][2] == 1
    expected = [*library.encode("most", add_special_tokens=False).ids, WORD_END]
    assert tokenfile.document(files, (1 << 62) + 7) == expected
    assert tokenfile.document(files, 4) is None and tokenfile.document(files, -(1 << 63)) is None
    nothing = tokenfile.write(rows_of(spark, []), path, WORD_END)
    assert nothing.count() == 0 and tokenfile.read(nothing).collect() == []
    assert tokenfile.document(nothing, 1) is None


def test_a_hot_doc_id_fills_several_files(spark):
    docs = spark.range(4000).repartition(4).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("some words "), "id").alias("text"))
    files = tokenfile.write(docs, vocabulary_path(WORD_VOCABULARY), WORD_END, file_tokens=1000)
    assert files.count() > 4
    found = tokenfile.read(files)
    assert found.count() == 4000
    assert found.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] == files.agg(F.sum("tokens")).first()[0]


def test_only_files_of_the_format_are_opened(tmp_path):
    (tmp_path / "x").write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        tokenfile.opened(str(tmp_path / "x"))
    with pytest.raises((pa.ArrowInvalid, OSError)):
        tokenfile.opened(str(tmp_path / "missing"))


def test_words_reach_the_merges_in_bounded_calls(words, library, monkeypatch):
    monkeypatch.setattr(tokenfile, "MERGED", 3)
    words._new, words._old = {"": b""}, {}
    texts = ["It's 12a-b, ÉTÉ straße!", "x" * 70, "<|x we'll ĿŀĦ ſo", None, " \n", "don't can't 'd's a1b2c3 ..."] * 2
    ids, size = words.encode(pa.array(texts))
    ends = np.cumsum(size)
    got = [ids[e - n : e].tolist() for e, n in zip(ends, size)]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
