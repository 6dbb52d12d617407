"""Every query against brute force, a round trip, or labels, over whole tables."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from coldshelf.llm import caps, minhash, ngram_lm, packing, quality, toxicity
from coldshelf.llm.bpe import Bpe, load_vocabulary
from coldshelf.llm.queries import ORACLE, QUERIES, vocabulary_path
from compare import oracle_connection, oracle_rows, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.execute(f"SELECT doc_id, coalesce(text, '') FROM '{SF_DIR}/documents.parquet'").fetchall()
    return dict(rows)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def result(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


class Groups:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x] = self.up[self.up[x]]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


@pytest.mark.parametrize("query", ORACLE)
def test_queries_match_their_sql(spark, query):
    got = spark_rows(QUERIES[query](spark, SF_DIR))
    assert got == oracle_rows(oracle_connection(SF_DIR), ORACLE[query])


def test_quality_agrees_with_labels_it_never_saw(spark):
    labels = dict(duckdb.execute("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    found = QUERIES["op1_quality"](spark, "/root/testdata/sf0.01").collect()
    tally = collections.Counter((labels[r.doc_id], r.kept) for r in found if r.doc_id in labels)
    assert tally[1, False] <= 0.01 * tally[1, True]
    assert tally[0, True] <= 0.05 * tally[0, False]


def test_label_model_finds_the_labellers_accuracies():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.8
    objects = np.array([(0.7, 0.01), (0.5, 0.02), (0.3, 0.005), (0.6, 0.03)])
    votes = np.where(rng.random((20_000, 4)) < np.where(good[:, None], objects[:, 1], objects[:, 0]), 0, 1)
    votes[rng.random(votes.shape) < 0.1] = 2
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model(patterns, counts.astype(float))
    assert abs(model.good - good.mean()) < 0.03
    assert np.abs(model.objects - objects).max() < 0.06


def test_packing_is_gapless_and_exact(spark, texts, library):
    ids = {d: np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4") for d, t in texts.items()}
    windows, ends = collections.defaultdict(list), collections.Counter()
    for r in sorted(result(spark, "op2_packing"), key=lambda r: (r.doc_id, r.start)):
        assert r.start == ends[r.doc_id] and r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        ends[r.doc_id] += r.length
        windows[r.sequence_id].append((r.offset, r.length, r.source))
    assert ends == {d: len(x) for d, x in ids.items()}
    source = collections.Counter()
    for pieces in windows.values():
        for _, length, name in pieces:
            source[name] += length
    whole = sum(source.values())
    assert sorted(windows) == list(range(len(windows)))
    for number, pieces in windows.items():
        end = 0
        for offset, length, _ in sorted(pieces):
            assert offset == end
            end += length
        if number < len(windows) - 1:
            assert end == packing.WINDOW
            shares = collections.Counter()
            for _, length, name in pieces:
                shares[name] += length
            # Each queue is served to a token a round; a window's edge may lie two queues off a round's.
            assert all(abs(shares[s] - packing.WINDOW * n / whole) <= 2 * len(source) for s, n in source.items())


def test_language_model_scores(spark, texts):
    tokens = {d: [*WORD.findall(t.translate(LOWER)), None] for d, t in texts.items()}
    counts = collections.Counter(w for d, ws in tokens.items() if crc(d) % 10 for w in ws)
    n, whole = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    for r in result(spark, "op4_ngram_lm"):
        ws = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 0.1) / whole) for w in ws)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (crc(r.doc_id) % 10 == 0, len(ws), n)
        assert r.n_known == sum(w in counts for w in ws)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0


def test_language_model_beats_single_words_on_held_out_texts(spark):
    found = [r for r in QUERIES["op4_ngram_lm"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in found) > 0.98 * sum(r.base_score for r in found)


def shingles(text, width=5):
    words = WORD.findall(text.translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def linked(sets, percent):
    groups = Groups(sets)
    holders = collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for d, s in sets.items():
        for o, k in collections.Counter(o for x in s for o in holders[x] if o < d).items():
            if 100 * k >= percent * (len(s) + len(sets[o]) - k):
                groups.join(o, d)
    return {d: groups.find(d) for d in sets}


def test_near_duplicates(spark, texts):
    sets = {d: shingles(t) for d, t in texts.items()}
    component = linked(sets, 85)
    for r in result(spark, "op5_minhash"):
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), component[r.doc_id], component[r.doc_id] == r.doc_id)


@pytest.mark.parametrize("percent", [80, 85])
def test_a_large_group_of_near_copies(spark, percent):
    """A crowd of variants of one text, some only linked by others, and chains of small changes."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for d in range(600):
        words = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 3, 4, 6))):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**9)}"
        texts[d] = " ".join(words)
    words = [f"c{i}" for i in range(100)]
    for d in range(600, 640):
        words[(d - 600) * 2] = f"y{d}"
        texts[d] = " ".join(words)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    component = linked({d: shingles(t) for d, t in texts.items()}, percent)
    found = minhash.near_duplicates(table, minhash.Settings(percent=percent)).collect()
    assert {r.doc_id: r.component_id for r in found} == component


def test_estimate_is_close_to_the_similarity():
    rng = np.random.default_rng(6)
    settings = minhash.Settings()
    for share in (0.3, 0.6, 0.9):
        pool = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
        n = int(1000 * 2 * share / (1 + share))
        a, b = np.unique(pool[:1000]), np.unique(pool[1000 - n : 2000 - n])
        _, sketch = minhash._signatures(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), settings)
        bits = np.unpackbits(sketch.view(np.uint8).reshape(2, 2, -1), axis=2)[:, :, : settings.hashes]
        equal = (bits[0] == bits[1]).all(axis=0).mean()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((equal - 0.25) / 0.75 - true) < settings.slack


def neighbours(ids, vectors, labels, cosine):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (unit @ unit.T >= cosine) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    groups = Groups(ids.tolist())
    for i, j in zip(*np.nonzero(near)):
        groups.join(int(ids[i]), int(ids[j]))
    return near.sum(axis=1), [groups.find(int(i)) for i in ids]


def test_embeddings_query(spark):
    rows = duckdb.execute(f"SELECT vec_id, embedding, label FROM '{SF_DIR}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, vectors, labels = (np.array(x) for x in zip(*rows))
    links, component = neighbours(ids, vectors.astype(float), labels, 0.93)
    found = {r.vec_id: r for r in result(spark, "op6_caps")}
    assert [(found[i].n_links, found[i].component_id) for i in ids] == list(zip(links, component))


def test_recall_of_caps(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(150, 64))
    vectors = np.repeat(centres, 8, axis=0) + rng.normal(size=(1200, 64)) * rng.uniform(0.05, 0.4, (1200, 1))
    vectors[-40:] = vectors[0]
    vectors = vectors.astype(np.float32)
    labels = rng.integers(0, 2, 1200)
    table = spark.createDataFrame(
        [(i, v.tolist(), int(x)) for i, (v, x) in enumerate(zip(vectors, labels))], "vec_id long, embedding array<float>, label int"
    )
    links, _ = neighbours(np.arange(1200), vectors.astype(float), labels, 0.93)
    found = {r.vec_id: r.n_links for r in caps.near_duplicates(table).collect()}
    got = np.array([found[i] for i in range(1200)])
    assert (got <= links).all() and got.sum() >= 0.99 * links.sum() > 1000


def test_list_decoding_finds_every_cap():
    rng = np.random.default_rng(8)
    unit = rng.normal(size=(40, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    layout = caps.Caps(words=12, height=1.5)
    row, number = caps.decode(unit, layout)
    expected = set()
    for rotation in range(caps.ROTATIONS):
        first, second = caps._codes(32, rotation, 12)
        turned = unit @ caps._rotation(32, rotation).T
        score = (turned[:, :16] @ first.T)[:, :, None] + (turned[:, 16:] @ second.T)[:, None, :]
        need = np.minimum(1.5 / math.sqrt(32), score.max(axis=(1, 2)) - 1e-9)
        for i, a, b in zip(*np.nonzero(score >= need[:, None, None])):
            expected.add((i, (rotation * 12 + a) * 12 + b))
    assert set(zip(row, number)) == expected and len(row) == len(expected)


def test_ids_and_decoded_texts(spark, texts, library):
    for r in result(spark, "op8_bpe"):
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_strings_get_the_librarys_ids(library):
    rng = random.Random(9)
    signs = "aA'srtvemld  \n\t\r1é9.,!# 　ñ中́<|>’'\x1c\x85🙂"
    odd = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    odd += ["", None, "<|endoftext|>", "a<|endoftext|>  <|endoftext|>'s", "it'sx 'll'd", "\r\n  x ", " " * 50, "'" * 9]
    bpe = Bpe(*load_vocabulary(vocabulary_path()))
    ids, bounds = bpe.encode(odd)
    for i, text in enumerate(odd):
        own = ids[bounds[i] : bounds[i + 1]].tolist()
        assert own == library.encode(text or "", add_special_tokens=False).ids, repr(text)
        assert bpe.decode(own) == (text or "")


def test_toxicity_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = dict(duckdb.execute(f"SELECT doc_id, toxic FROM '{sf_dir}/labels.parquet'").fetchall())
    found = [r for r in QUERIES["op9_toxicity"](spark, sf_dir).collect()]
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1 for r in found)
    assert all(r.predicted == (r.score >= 0.7) for r in found)
    tally = collections.Counter((labels[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in labels)
    assert tally[1, 1] >= 0.7 * (tally[1, 0] + tally[1, 1])
    assert tally[0, 1] <= 0.02 * tally[0, 0]


def edits(a, b):
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@pytest.mark.parametrize("distance", [1, 2])
def test_automaton_against_the_edit_distance(distance):
    rng = random.Random(10)
    word = lambda low, signs: "".join(rng.choice(signs) for _ in range(rng.randint(low, 6)))
    for _ in range(80):
        terms = sorted({word(1, "abc") for _ in range(5)})
        automaton = toxicity.Automaton(terms, distance)
        for _ in range(40):
            given = word(0, "abcd")
            least = min((edits(given, t), t) for t in terms)
            assert automaton.within(given) == (least[::-1] if least[0] <= distance else None)


def test_longer_terms_allow_more_edits():
    automaton = toxicity.Automaton(["scum", "stupid", "worthless", "ab"], toxicity.allowed_edits)
    assert automaton.within("scumm") == ("scum", 1) and automaton.within("scxxm") is None
    assert automaton.within("stuppid") == ("stupid", 1) and automaton.within("stuppidd") is None
    assert automaton.within("wrothles") == ("worthless", 2)
    assert automaton.within("ab") == ("ab", 0) and automaton.within("abc") is None


def test_common_words_are_no_misspellings(spark):
    lexicon = toxicity.Lexicon(dict.fromkeys(toxicity.INSULTS, 4.0), {})
    for word in "where whole lower closer crash pitch batch witch hitch crown".split():
        assert lexicon.find(word) is None, word
    # A word that clean rows share is none either.
    rows = [(i, "these fine crowds of tlown folk meet here", 0) for i in range(0, 400, 2)]
    rows += [(i, f"what a clown that person is number {i}", 1) for i in range(1, 400, 2)]
    docs = spark.createDataFrame([(i, f"{t} w{i} v{i} u{i}") for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, x) for i, _, x in rows], "doc_id long, quality int, toxic int")
    learned = toxicity.learn(docs, labels)
    assert "tlown" in learned.common and learned.find("tlown") is None and learned.find("clwon")[0] == "clown"


def misspelled(word, rng):
    i = rng.randrange(1, len(word) - 1)
    return rng.choice([word[:i] + word[i + 1] + word[i] + word[i + 2 :], word[:i] + word[i + 1 :], word[:i] + word[i] + word[i:]])


def test_misspelled_toxic_documents_need_the_automaton(spark):
    """Held-out toxic documents with every listed insult misspelled, with the automaton and without."""
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    lexicon = toxicity.learn(docs, labels)
    rng = random.Random(2)
    insults = re.compile(r"\b(" + "|".join(toxicity.INSULTS) + r")\b", re.I)
    toxic = dict(labels.select("doc_id", "toxic").collect())
    held = [r for r in docs.collect() if r.text and crc(r.doc_id) % 3 == 1 and toxic.get(r.doc_id) is not None]
    caught = {True: 0, False: 0}
    plain = clean = wrong = 0
    for r in held:
        if not toxic[r.doc_id]:
            clean += 1
            wrong += lexicon.score(r.text) >= 0.7
        elif insults.search(r.text):
            plain += 1
            text = insults.sub(lambda m: misspelled(m.group(), rng), r.text)
            for fuzzy in caught:
                lexicon.fuzzy = fuzzy
                lexicon._seen, lexicon._older = {}, {}
                caught[fuzzy] += lexicon.score(text) >= 0.7
            lexicon.fuzzy = True
            lexicon._seen, lexicon._older = {}, {}
    print(f"misspelled: {caught[True]} of {plain} with the automaton, {caught[False]} without; clean: {wrong} of {clean}")
    assert caught[True] >= 0.7 * plain and caught[False] <= 0.3 * plain and wrong <= 0.02 * clean


def test_quotation_against_abuse_in_full_texts(spark):
    sf_dir = "/root/testdata/sf0.01"
    lexicon = toxicity.learn(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    filler = " ".join(f"plain{i}" for i in range(40))
    abuse = f"{filler} you stupid worthless idiot, you pathetic loser {filler}"
    quoted = f'{filler} the term "stupid" was quoted {filler} and they said "idiot" once {filler}'
    assert lexicon.score(abuse) >= 0.7 > lexicon.score(quoted)


def test_context_tells_quotation_from_abuse():
    lexicon = toxicity.Lexicon(dict.fromkeys(toxicity.INSULTS, 4.0), {})
    plain, *_ = lexicon.measures("he is an idiot indeed")
    for milder in ('he used the word "idiot" there', "they called him an idiot", "it says idiot on it"):
        assert lexicon.measures(milder)[0] < plain
    assert lexicon.measures("you idiot")[0] > plain
    assert 0 < lexicon.measures("he is an idoit indeed")[0] < plain


def test_rules(spark, texts):
    for r in result(spark, "op10_rules"):
        text = texts[r.doc_id]
        words = WORD.findall(text)
        seen = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        again = {i + k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == failed and not (failed and r.kept)


def test_compression_bands_tell_prose_from_repetition_and_noise(spark):
    from coldshelf.llm import rules

    rng = random.Random(11)
    prose = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(3000))
    noise = "".join(chr(rng.randrange(33, 127)) for _ in range(6000))
    hidden = prose[:8192] + "ab " * 1400 + prose[8192:]
    rows = [(1, prose), (2, "same words again and " * 500), (3, noise), (4, hidden)]
    found = {r.doc_id: r for r in rules.judged(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i].in_bands for i in (1, 2, 3, 4)] == [True, False, False, False]


def test_pipeline_stages_against_brute_force(spark, texts, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        kept[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert kept["quality classifier"] == sorted(r.doc_id for r in result(spark, "op1_quality") if r.kept)
    passed = {r.doc_id for r in result(spark, "op10_rules") if r.kept}
    assert kept["quality rules"] == [d for d in kept["quality classifier"] if d in passed]
    component = linked({d: shingles(texts[d]) for d in kept["quality rules"]}, corpus_pipeline.SIMILAR)
    assert kept["near duplicates"] == [d for d in kept["quality rules"] if component[d] == d]
    packed = collections.defaultdict(dict)
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        packed[r.doc_id][r.start] = np.frombuffer(r.ids, "<u4")
    assert sorted(packed) == kept["near duplicates"]
    for d, parts in packed.items():
        ids = np.concatenate([parts[s] for s in sorted(parts)])
        assert ids.tolist() == [*library.encode(texts[d], add_special_tokens=False).ids, 1]
