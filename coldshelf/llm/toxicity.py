"""Toxicity by a lexicon: misspelled terms by Levenshtein automata on a trie, weighed by their context.

The lexicon is a fixed list of insults and the words and word stems that the labelled rows
bring out, in whatever language. A word is spelled into the Levenshtein automata of all terms
at once, which run along their common trie, and is dropped as soon as no state is left; longer
terms allow more edits. A word that is near a term, but common itself in clean rows, is no
misspelling. The words around a hit tell a quoted or reported term from one that is thrown at
somebody. A logistic curve over
the hits' weights, fitted on labelled rows, turns them into a score.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.cluster import extended, ship, written

#: Labelled rows of each label that the lexicon and the curve are fitted on, at most.
SAMPLE = 4000
#: What makes a word a term: how much more common it is in toxic rows (log of the ratio), and the
#: least rows and share of toxic rows with it. The share bounds their number by the words of a row.
TELLING, LEAST_ROWS, LEAST_SHARE = 3.0, 4, 0.01
THRESHOLD = 0.7
WINDOW = 4
#: Edits that a term of so many letters allows; shorter ones allow none.
EDITS = ((4, 1), (9, 2))
#: Clean training rows in which a word is common.
COMMON = 2
STEMS = range(4, 9)
_REMEMBERED = 400_000

# Insults, words that report speech, words that address somebody, quotation marks.
INSULTS = (
    "arsehole asshole bastard bitch clown cretin disgusting dumbass fuck idiot imbecile jerk loser maggot moron "
    "pathetic retard scum scumbag slut stupid trash vermin whore worthless"
).split()
# Common words near them.
NEIGHBOURS = frozenset(
    "apathetic batch birch blown boron brash buck butch chore clown closer crash crown digesting discussing ditch duck flown "
    "glut hitch idiom itch laser loner looser loses lover lower luck muck mutch perk pitch poser puck regard scam scud "
    "shore shut slit slot slum stupor suck thrash tuck where whole whose witch".split()
) - frozenset(INSULTS)
REPORTING = frozenset("said says called calls term word words quote quoted quotes wrote writes allegedly".split())
ADDRESSING = frozenset("you your you're youre u du dich dein tu te ton usted eres vous".split())
QUOTES = "\"'“”„‘’«»`"

_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


# --- lookup -------------------------------------------------------------------


class Automaton:
    """The Levenshtein automata of all terms, run along their trie.

    ``edits`` tells how many edits a term allows, or is their number for all. A state is the set of trie nodes that the letters so far may have led to, each with the
    edits that took: a letter left out, put in, replaced, or swapped with the next one. States
    and steps are worked out when a word first needs them; most words soon meet the state
    without nodes. Letters that no term has are one letter to it.
    """

    def __init__(self, terms, edits: int | Callable[[str], int]):
        allowed = {term: edits(term) if callable(edits) else edits for term in terms}
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.most = [0]  # edits that any term below a node allows
        for term, most in allowed.items():
            node = 0
            self.most[0] = max(self.most[0], most)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.most.append(0)
                node = self.children[node][letter]
                self.most[node] = max(self.most[node], most)
            self.term[node] = term
        self.allowed = allowed
        self.letters = {letter for node in self.children for letter in node}
        self.steps: dict[tuple[frozenset, str], frozenset] = {}
        self.start = self._closed({(0, 0, "")})

    def within(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its distance, if that is allowed; the first by name of equally near ones."""
        state = self.start
        for letter in word:
            key = state, letter if letter in self.letters else ""
            state = self.steps.get(key)
            if state is None:
                state = self.steps[key] = self._step(*key)
            if not state:
                return None
        found = [(edits, self.term[node]) for node, edits, swapped in state if not swapped and self.term[node]]
        found = [(edits, term) for edits, term in found if edits <= self.allowed[term]]
        return min(found)[::-1] if found else None

    def _step(self, state: frozenset, letter: str) -> frozenset:
        after = set()
        for node, edits, swapped in state:
            if swapped:  # the first letter of a swapped pair has to follow
                if swapped == letter:
                    after.add((node, edits, ""))
                continue
            children = self.children[node]
            if letter in children:
                after.add((children[letter], edits, ""))
            if edits < self.most[node]:
                after.add((node, edits + 1, ""))
                for other, child in children.items():
                    if edits < self.most[child]:
                        after.add((child, edits + 1, ""))
                        if other != letter and letter in self.children[child]:
                            after.add((self.children[child][letter], edits + 1, other))
        return self._closed(after)

    def _closed(self, state: set) -> frozenset:
        """With the nodes reached by leaving letters out, and of each node the fewest edits only."""
        least: dict[tuple[int, str], int] = {}
        todo = list(state)
        while todo:
            node, edits, swapped = todo.pop()
            if edits >= least.get((node, swapped), self.most[node] + 1):
                continue
            least[node, swapped] = edits
            if not swapped:
                todo += [(child, edits + 1, "") for child in self.children[node].values() if edits < self.most[child]]
        return frozenset((node, edits, swapped) for (node, swapped), edits in least.items())


def allowed_edits(term: str) -> int:
    return max((edits for length, edits in EDITS if len(term) >= length), default=0)


@dataclass
class Lexicon:
    """Weights of terms, which are also found with edits, and of stems, which begin longer words; and
    words that are near a term, but none."""

    terms: dict[str, float]
    stems: dict[str, float]
    common: frozenset[str] = NEIGHBOURS
    curve: tuple[float, ...] = (-3.0, 1.0, 1.0, 1.0)
    fuzzy: bool = True
    _seen: dict = field(default_factory=dict, repr=False)
    _older: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.automaton = Automaton(self.terms, allowed_edits)

    def find(self, token: str) -> tuple[str | None, float, str | None] | None:
        """Term, its weight here, and stem of a token, or None."""
        if token in self._seen:
            return self._seen[token]
        found = self._older[token] if token in self._older else self._find(_EDGE.sub("", token))
        if len(self._seen) >= _REMEMBERED // 2:
            self._seen, self._older = {}, self._seen
        if len(token) <= 64:
            self._seen[token] = found
        return found

    def _find(self, word: str):
        term, weight = (word, self.terms[word]) if word in self.terms else (None, 0.0)
        if term is None and self.fuzzy and word not in self.common:
            near = self.automaton.within(word)
            if near:
                term, weight = near[0], 0.6 * self.terms[near[0]]
        stem = next((word[:n] for n in reversed(STEMS) if len(word) > n and word[:n] in self.stems), None)
        return (term, weight, stem) if term or stem else None

    def measures(self, text: str) -> tuple[float, float, float]:
        """Weight of the terms in their contexts, of the strongest stem, and of hits by length."""
        tokens = text.lower().split()
        hits = [(i, hit) for i, hit in enumerate(map(self.find, tokens)) if hit]
        if not hits:
            return 0.0, 0.0, 0.0
        heaviest: dict[str, float] = {}
        stems: dict[str, set[str]] = {}
        plain = 0.0
        for i, (term, weight, stem) in hits:
            part = context(tokens, i)
            if term:
                heaviest[term] = max(heaviest.get(term, 0.0), weight * part)
                plain += part
            if stem:
                stems.setdefault(stem, set()).add(tokens[i])
        share = 100 / max(len(tokens), 1)
        strongest = max((self.stems[s] for s, w in stems.items() if len(w) > 1), default=0.0)
        return float(np.log1p(sum(heaviest.values()))), strongest, float(np.log1p(plain * share))

    def score(self, text: str) -> float:
        return curve(self.curve, np.array([self.measures(text)]))[0]


def context(tokens: list[str], i: int) -> float:
    """How much a hit counts: little if it is quoted or reported, more if somebody is addressed."""
    token, near = tokens[i], tokens[max(0, i - WINDOW) : i]
    after = tokens[i + 1 : i + 1 + WINDOW]
    opened = token[0] in QUOTES or any(t[0] in QUOTES and t[-1] not in QUOTES for t in near)
    closed = token.rstrip(".,;:!?")[-1:] in QUOTES or any(t.rstrip(".,;:!?")[-1:] in QUOTES for t in after)
    if opened and closed or not REPORTING.isdisjoint(near):
        return 0.25
    return 1.25 if not ADDRESSING.isdisjoint(near) or not ADDRESSING.isdisjoint(after) else 1.0


# --- learning -----------------------------------------------------------------


def held_out() -> Column:
    """Rows that nothing is learned from; a row without doc_id counts as one with an empty one."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def curve(weights: tuple[float, ...], measures: np.ndarray) -> np.ndarray:
    odds = weights[0] + measures @ np.array(weights[1:])
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit_curve(measures: np.ndarray, label: np.ndarray, rounds: int = 50, decay: float = 1e-2) -> tuple[float, ...]:
    """Logistic regression by Newton's steps."""
    x = np.hstack([np.ones((len(measures), 1)), measures])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - label) + decay * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + decay * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return tuple(w)


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Texts and labels to learn from: of each label the first ``sample`` rows by a hash of doc_id.

    Of texts whose three least hashed words are the same, copies mostly, one stays:
    else the words of a much copied text would pass for telling ones.
    """
    marks = labels.filter(~held_out() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [marks.filter(F.col("toxic") == k).orderBy(*order).limit(sample) for k in (0, 1)]
    ids = F.broadcast(written(chosen[0].unionByName(chosen[1])))  # two samples of ids at most
    hashes = F.transform(F.array_distinct(F.split(F.lower("text"), r"\s+")), lambda w: F.xxhash64(w))
    rows = docs.select("doc_id", "text").filter("text IS NOT NULL").join(ids, "doc_id")
    rows = written(rows.withColumn("least", F.slice(F.array_sort(hashes), 1, 3)))
    first = rows.groupBy("least").agg(F.min("doc_id").alias("doc_id"))
    return rows.join(first, ["least", "doc_id"], "left_semi").select("doc_id", "toxic", "text")


def _weights(counts: DataFrame, toxic: int, clean: int) -> DataFrame:
    """Terms more common in toxic texts, with the log of how much more: all that are telling and not rare."""
    share = F.log((F.col("bad") + 0.5) / (toxic + 1)) - F.log((F.col("good") + 0.5) / (clean + 1))
    return counts.withColumn("weight", share).filter(
        (F.col("bad") >= max(LEAST_ROWS, LEAST_SHARE * toxic)) & (F.col("weight") > TELLING)
    )


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """The lexicon and curve of the labelled rows that are not held out; without any, the fixed list alone."""
    rows = written(training_rows(docs, labels, sample))
    sizes = dict(rows.groupBy("toxic").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    start = dict.fromkeys(INSULTS, 4.0)
    if not toxic or not clean:
        return Lexicon(start, {})
    letters = F.split(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+", " "), " ")
    words = rows.select("doc_id", "toxic", F.explode(F.array_distinct(letters)).alias("term")).filter("length(term) > 3")
    split = [F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good")]
    counts = words.groupBy("term").agg(*split)
    terms = {r.term: r.weight for r in _weights(counts, toxic, clean).collect()}
    heads = words.select("doc_id", "toxic", "term", F.explode(F.array(*map(F.lit, STEMS))).alias("n"))
    heads = heads.filter(F.length("term") > F.col("n")).withColumn("term", F.substring("term", F.lit(1), F.col("n")))
    several = heads.groupBy("doc_id", "toxic", "term").count().filter("count > 1")
    stems = _weights(several.groupBy("term").agg(*split), toxic, clean).collect()
    terms = start | terms
    common = _near(counts.filter(F.col("good") >= COMMON).select("term"), terms)
    lexicon = Lexicon(terms, {r.term: r.weight for r in stems}, NEIGHBOURS | common)
    found = _measured(rows, lexicon).collect()  # three numbers for each row of the sample
    measures = np.array([[r.terms, r.stem, r.hits] for r in found])
    lexicon.curve = fit_curve(measures, np.array([r.toxic for r in found], float))
    return lexicon


def _near(words: DataFrame, terms: dict[str, float]) -> frozenset[str]:
    """Those of some words that lie within the edits of a term, and are none themselves."""
    ship(words.sparkSession)

    def run(batches):
        automaton = Automaton(terms, allowed_edits)
        for batch in batches:
            near = [w for w in batch.column("term").to_pylist() if w not in terms and automaton.within(w)]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], names=["term"])

    # No more than there are spellings within the edits of the terms, and words in the sample.
    return frozenset(r.term for r in words.mapInArrow(run, "term string").collect())


def _measured(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    ship(rows.sparkSession)
    keep = [c for c in rows.columns if c != "text"]
    schema = extended(rows.select(keep), "terms double, stem double, hits double")
    shared = rows.sparkSession.sparkContext.broadcast((lexicon.terms, lexicon.stems, lexicon.common, lexicon.curve, lexicon.fuzzy))

    def run(batches):
        local = Lexicon(*shared.value)
        for batch in batches:
            measures = [local.measures(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *(pa.array(c, pa.float64()) for c in zip(*measures))], names=schema.names
            )

    return rows.select(*keep, "text").mapInArrow(run, schema)


def scored(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """Columns doc_id, held_out, score (0 to 1, higher is more toxic) and predicted, for every row of ``docs``.

    Only the text is looked at, and all of a very long one. A null or empty text scores what the
    curve gives for no hits. Of terms that are equally near, the first by name counts. Rows are scored one by one, repeated ones too; an empty table gives no rows; other
    columns are left out.
    """
    a, *slopes = (F.lit(float(w)) for w in lexicon.curve)
    odds = a
    for name, slope in zip(("terms", "stem", "hits"), slopes):
        odds = odds + slope * F.col(name)
    found = _measured(docs.select("doc_id", "text"), lexicon).withColumn("score", 1 / (1 + F.exp(-odds)))
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return found.select("doc_id", held_out().alias("held_out"), "score", predicted, "terms", "stem", "hits")
