"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from coldshelf.llm import bpe, caps, chat, licenses, minhash, ngram_lm, packing, quality, rules, toxicity
from coldshelf.llm.queries import vocabulary_path

LONG = "word " * 200_000
DOCS = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n", None, None),
    (4, "one", "en", None),
    (5, LONG, "en", "a"),
    (6, "the same text of some words stands here twice and it is the same", "en", "b"),
    (6, "the same text of some words stands here twice and it is the same", "en", "b"),
    (7, "the same text of some words stands here twice and it is the same", None, "b"),
    (None, "a text without an id that has a few words of its own", "en", "b"),
    (8, "ünïcödé 中文 🙂 \x00 control ퟿", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(docs):
    names = "n_words score kept ids n bucket part h row votes label base ratio queue start set bands held_out doc".split()
    return docs.select("*", *(F.lit(f"x{i}").alias(n) for i, n in enumerate(names)))


def labels_of(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def lexicon_scores(docs):
    return toxicity.scored(docs, toxicity.learn(docs, labels_of(docs.sparkSession, [(4, 1, 0), (6, 1, 1), (None, 1, 1)])))


OPERATORS = {
    "quality": quality.scored,
    "quality_stage": quality.passed,
    "packing": lambda d: packing.pack(d, vocabulary_path()),
    "licenses": licenses.scan,
    "lm": ngram_lm.scored,
    "minhash": minhash.near_duplicates,
    "minhash_stage": minhash.one_of_each,
    "encode": lambda d: bpe.encode(d, vocabulary_path()),
    "decode": lambda d: bpe.decode(bpe.encode(d, vocabulary_path()), vocabulary_path()),
    "toxicity": lexicon_scores,
    "rules": rules.judged,
    "rules_stage": rules.passed,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_gives_no_rows(empty, name):
    found = OPERATORS[name](empty)
    assert found.collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_change_nothing(docs, clashing, name):
    plain, other = OPERATORS[name](docs), OPERATORS[name](clashing)
    shared = plain.columns
    assert set(shared) <= set(other.columns)
    key = lambda rows: sorted(map(repr, (tuple(r) for r in rows)))
    assert key(plain.collect()) == key(other.select(shared).collect())


@pytest.mark.parametrize("name", ["quality", "licenses", "lm", "minhash", "encode", "decode", "toxicity", "rules"])
def test_every_row_has_its_result(docs, name):
    found = OPERATORS[name](docs).groupBy("doc_id").count().collect()
    expected = {}
    for row in DOCS:
        expected[row[0]] = expected.get(row[0], 0) + 1
    assert {r.doc_id: r["count"] for r in found} == expected


@pytest.mark.parametrize("name", ["quality_stage", "rules_stage", "minhash_stage"])
def test_stages_keep_the_columns(clashing, name):
    assert OPERATORS[name](clashing).columns == clashing.columns


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_empty_texts_have_defined_results(docs):
    encoded = by_id(bpe.encode(docs, vocabulary_path()))
    assert encoded[1].ids == encoded[2].ids == []
    scanned = by_id(licenses.scan(docs))
    for i in (1, 2, 3):
        assert scanned[i][1:] == (0, 0, None, None, "", "", 0.0)
    found = by_id(minhash.near_duplicates(docs))
    for i in (1, 2, 3):
        assert found[i][1:] == (0, i, True)
    assert found[4][1:] == (1, 4, True)
    assert found[6].component_id == found[7].component_id == 6 and not found[7].kept
    assert found[None].component_id is None and found[None].kept
    counted = by_id(rules.judged(docs))
    assert counted[1].n_bytes == 0 and counted[1].ratio is None and counted[1].base_failed
    assert counted[5].n_words == 200_000 and counted[5].n_repeat_words == 200_000
    scored = by_id(ngram_lm.scored(docs))
    assert scored[1].n_tokens == 1 and scored[1].score < 0
    assert by_id(quality.scored(docs))[1].score == by_id(quality.scored(docs))[2].score


def test_repeated_rows_of_one_document_leave_one(docs):
    kept = [r.doc_id for r in minhash.one_of_each(docs).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, 3, 4, 5, 6, 8, None], key=str)


def test_packing_covers_empty_and_null(docs):
    pieces = packing.pack(docs, vocabulary_path()).collect()
    assert {(p.doc_id, p.doc_tokens) for p in pieces if p.doc_id in (1, 2)} == {(1, 1), (2, 1)}
    assert {p.source for p in pieces if p.doc_id == 3} == {None}


def test_pipeline_on_edges(spark, docs, empty):
    for table in (docs, empty):
        rows = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, "")
            assert rows.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, rows, "").count() >= 0


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, example string, examples string"
    rows = [
        (1, 0, "user", None, "x", "x"),
        (1, 1, "assistant", "", "x", "x"),
        (1, 1, "assistant", "", "x", "x"),
        (2, None, None, "no role", "x", "x"),
        (None, 0, "assistant", "no id", "x", "x"),
        (3, 0, "a: b\\", "tail </turn>\n### x: y", "x", "x"),
        (3, 1, "assistant", "w" * 300_000, "x", "x"),
    ]
    found = {r.conv_id: r for r in chat.read_back(chat.formatted(spark.createDataFrame(rows, schema))).collect()}
    assert [tuple(t) for t in found[1].turns] == [("user", ""), ("assistant", ""), ("assistant", "")]
    assert found[1].replies == ["", ""]
    assert [tuple(t) for t in found[2].turns] == [("", "no role")] and found[2].replies is None
    assert found[None].replies == ["no id"]
    assert [tuple(t) for t in found[3].turns] == [("a: b\\", "tail </turn>\n### x: y"), ("assistant", "w" * 300_000)]
    assert chat.read_back(chat.formatted(spark.createDataFrame([], schema))).collect() == []


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    ones = [1.0] * 8
    rows = [
        (1, ones, 0),
        (2, [2.0] * 8, 0),
        (3, ones, 1),
        (4, ones, None),
        (5, None, 0),
        (6, [0.0] * 8, 0),
        (7, [nan] + ones[1:], 0),
        (8, [inf] + ones[1:], 0),
        (9, [None] + ones[1:], 0),
        (None, ones, 0),
        (10, [], 0),
        (11, [1.0, 1.0], 0),
        (12, [1.0, 1.01], 0),
        (1, ones, 0),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("links", F.lit("x"))
    found = {}
    for r in caps.near_duplicates(table).collect():
        found.setdefault(r.vec_id, []).append(tuple(r)[1:])
    assert found[1] == [(1, 1, True)] * 2 and found[2] == [(1, 1, False)]
    assert found[11] == [(1, 11, True)] and found[12] == [(1, 11, False)]
    assert found[None] == [(0, None, True)]
    for i in (3, 4, 5, 6, 7, 8, 9, 10):
        assert found[i] == [(0, i, True)]
    assert caps.near_duplicates(table.limit(0)).collect() == []
