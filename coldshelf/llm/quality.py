"""Quality classifier without labels: heuristic labellers, expectation maximisation, a hashed linear scorer.

Each labeller votes good, bad or nothing for a document, and the labellers overlap. How
often each is right is estimated from their agreements alone, by expectation maximisation
over the counts of all vote patterns: these counts, of which there are at most 3 to the
number of labellers, hold all that the votes of the corpus can tell. The posterior of a
document's votes then is the soft label that a linear scorer over hashed features learns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.cluster import carried, extended, restored, ship, written
from coldshelf.llm.textops import Words, flat, mix, per_text, pieces, range_hashes, repeat_words

#: Documents that the scorer is fitted on, about.
SAMPLE = 8192
BITS = 15
#: Only what is clearly bad goes.
THRESHOLD = 0.3
SIGNALS = "n_words long, symbols double, capitals double, calls double, stops double, ends double, echoes double, repeats double"
_MARKS = b"#*$%&|<>"

# Frequent function words of four languages.
FUNCTION_WORDS = (
    "the of and to in is that for with this on are as was be by it at from "
    "der die das und ist nicht ein eine den von mit zu auf dem im sich des "
    "le la les de des et un une du en que qui dans pour sur au "
    "el los las del con por para una es su y se al"
).split()


@dataclass(frozen=True)
class Labeller:
    """Votes bad where ``bad`` holds, else good where ``good`` does, else not at all."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), 0).when(F.expr(self.good), 1).otherwise(2).cast("int")


LABELLERS = (
    Labeller("symbols", "symbols > 0.2", "n_words >= 5"),
    Labeller("capitals", "capitals > 0.4", "n_words >= 5"),
    Labeller("calls", "calls > 0.25", "n_words >= 10"),
    Labeller("function_words", "stops < 0.04 AND n_words >= 40", "n_words >= 20"),
    Labeller("sentences", "(ends > 0.5 OR ends < 0.01) AND n_words >= 40", "n_words >= 20"),
    Labeller("echoes", "echoes > 0.2 AND n_words >= 10", "n_words >= 10"),
    Labeller("repeats", "repeats > 0.3 AND n_words >= 20", "n_words >= 20"),
)
#: Where the estimate starts: how often a labeller objects to a bad and to a good document, and the share of good ones.
OBJECTS = (0.35, 0.002)
GOOD = 0.85


# --- measures and features of texts ------------------------------------------


def _sign_kinds() -> np.ndarray:
    """A byte's kind in word shapes: capital, small letter, digit, or the sign itself."""
    kinds = np.arange(1, 257, dtype=np.int64)
    kinds[ord("a") : ord("z") + 1] = kinds[128:] = 300
    kinds[ord("A") : ord("Z") + 1] = 301
    kinds[ord("0") : ord("9") + 1] = 302
    return kinds


_KINDS = _sign_kinds()


def _ratio(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _signals(words: Words) -> list[np.ndarray]:
    data, bounds, first = words.data, words.bounds, words.first
    n = words.counts()
    letters = ((data | 32) >= 97) & ((data | 32) <= 122)
    capital = (data >= 65) & (data <= 90)
    mark = np.zeros(256, bool)
    mark[list(_MARKS)] = True
    last = data[words.end - 1]
    same = np.zeros(len(words.hash), bool)
    same[1:] = words.hash[1:] == words.hash[:-1]
    same[first[:-1][first[:-1] < len(same)]] = False
    return [
        n,
        _ratio(per_text(mark[data], bounds), n),
        _ratio(per_text(capital, bounds), per_text(letters, bounds)),
        _ratio(per_text(last == ord("!"), first), n),
        _ratio(per_text(np.isin(words.hash, _function_words()), first), n),
        _ratio(per_text((last == ord(".")) | (last == ord("?")) | (last == ord("!")), first), n),
        _ratio(per_text(same, first), n),
        _ratio(repeat_words(words, 8), n),
    ]


_STOPS: list[np.ndarray] = []


def _function_words() -> np.ndarray:
    if not _STOPS:
        _STOPS.append(Words(*flat(pa.array(FUNCTION_WORDS))).hash)
    return _STOPS[0]


def _features(words: Words, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, bucket and weight of each hashed feature, every text's weights of length 1.

    The features are words, word shapes (runs of one kind of sign count once), pairs of
    neighbouring shapes, and whether a word repeats the one before.
    """
    text = np.repeat(np.arange(len(words.bounds) - 1), words.counts())
    if not len(text):
        return text, text, np.zeros(0)
    kind = _KINDS[words.data]
    keep = words.inside.copy()
    keep[1:] &= kind[1:] != kind[:-1]
    keep[words.start] = True
    place = np.cumsum(keep)
    start = place[words.start] - 1
    shapes = range_hashes(kind[keep], start, np.append(start[1:], place[-1]))
    joined = text[1:] == text[:-1]
    pairs = mix(shapes[1:] * np.uint64(3) + shapes[:-1])[joined]
    echo = joined & (words.hash[1:] == words.hash[:-1])
    groups = [(text, mix(words.hash + np.uint64(11))), (text, shapes), (text[1:][joined], pairs)]
    groups.append((text[1:][echo], np.full(int(echo.sum()), 7, np.uint64)))
    key = np.concatenate([(t.astype(np.int64) << bits) | (h >> np.uint64(64 - bits)).astype(np.int64) for t, h in groups])
    key, count = np.unique(key, return_counts=True)
    row, bucket = key >> bits, key & ((1 << bits) - 1)
    weight = np.log1p(count)
    length = np.sqrt(np.bincount(row, weight * weight, len(words.bounds) - 1))
    return row, bucket, weight / length[row]


def signals(docs: DataFrame, features: bool = False) -> DataFrame:
    """``doc_id`` and the measures that the labellers look at, of every whole text.

    With ``features`` also its hashed features: the arrays buckets and weights.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    schema = extended(rows.drop("text"), SIGNALS + (", buckets array<int>, weights array<float>" if features else ""))

    def run(batches):
        for batch in batches:
            for low, high in pieces(batch.column("text")):
                words = Words(*flat(batch.column("text").slice(low, high - low)))
                columns = [pa.array(c) for c in _signals(words)]
                if features:
                    row, bucket, weight = _features(words, BITS)
                    bounds = pa.array(np.searchsorted(row, np.arange(high - low + 1)), pa.int32())
                    lists = pa.array(bucket, pa.int32()), pa.array(weight, pa.float32())
                    columns += [pa.ListArray.from_arrays(bounds, x) for x in lists]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


# --- the label model ----------------------------------------------------------


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents, and each labeller's chance to object to a bad and to a good one.

    A labeller that does not vote says nothing about the document.
    """

    good: float
    objects: np.ndarray  # labeller, class (bad, good)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance that documents with these votes (rows) are good."""
        against = np.log(self.objects[:, 1]) - np.log(self.objects[:, 0])
        for_it = np.log1p(-self.objects[:, 1]) - np.log1p(-self.objects[:, 0])
        odds = np.log(self.good / (1 - self.good)) + (votes == 0) @ against + (votes == 1) @ for_it
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit_label_model(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation maximisation over vote patterns and how many documents have each.

    It starts from labellers that seldom object to good documents, which settles what good
    means, and the start counts as ten documents. With no documents the start is the result.
    """
    start = np.tile(OBJECTS, (votes.shape[1], 1))
    model = LabelModel(GOOD, start)
    if not len(votes):
        return model
    for _ in range(rounds):
        good = model.posterior(votes)
        weight = np.stack([(1 - good) * counts, good * counts], axis=1)
        against = (votes == 0).T @ weight
        objects = (against + 10 * start) / (against + (votes == 1).T @ weight + 10)
        share = float(np.clip(weight[:, 1].sum() / counts.sum(), 1e-3, 1 - 1e-3))
        done = np.abs(objects - model.objects).max() < 1e-9
        model = LabelModel(share, objects)
        if done:
            break
    return model


def voted(measures: DataFrame, labellers: tuple[Labeller, ...] = LABELLERS) -> DataFrame:
    """``measures`` with a column votes: an array of each labeller's 0 (bad), 1 (good) or 2 (none)."""
    return measures.withColumn("votes", F.array(*(x.vote() for x in labellers)))


def label_model(counted: DataFrame) -> LabelModel:
    """The label model of all documents, from the number n of documents with each pattern of votes."""
    found = counted.collect()  # 3 to the number of labellers at most
    patterns = np.array([r.votes for r in found], np.int64).reshape(-1, len(LABELLERS))
    order = np.lexsort(patterns.T)
    return fit_label_model(patterns[order], np.array([r.n for r in found], float)[order])


# --- the scorer ---------------------------------------------------------------


@dataclass(frozen=True)
class Scorer:
    weights: np.ndarray
    bias: float
    bits: int

    def score(self, words: Words) -> np.ndarray:
        row, bucket, weight = _features(words, self.bits)
        odds = self.bias + np.bincount(row, weight * self.weights[bucket], len(words.bounds) - 1)
        return 1 / (1 + np.exp(-odds))


def fit_scorer(row, bucket, weight, label: np.ndarray, bits: int = BITS, rounds: int = 60, decay: float = 1e-5) -> Scorer:
    """Logistic regression on soft labels by full gradients with momentum.

    The bias is the share of good documents, so a text without known features scores that.
    """
    w, speed, step = np.zeros(1 << bits), np.zeros(1 << bits), 12.0
    n = len(label)
    share = float(np.clip(label.mean(), 0.01, 0.99))
    bias = float(np.log(share / (1 - share)))
    for _ in range(rounds):
        odds = bias + np.bincount(row, weight * w[bucket], n)
        error = (1 / (1 + np.exp(-odds)) - label) / n
        slope = np.bincount(bucket, weight * error[row], 1 << bits) + decay * w
        speed = 0.9 * speed - step * slope
        w += speed
    return Scorer(w, bias, bits)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Fits the label model on all documents, and the scorer on about ``sample`` of them.

    The sample is every document whose hashed id and text fall below a fixed share, so it is the
    same at each run; it holds every document of a smaller table.
    """
    measures = voted(signals(docs))
    counted = measures.groupBy("votes").agg(F.count("*").alias("n"))
    model = label_model(counted := written(counted))
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    share = min(1.0, sample / max(1, total))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    chosen = docs.select("doc_id", "text").filter(place < int(np.ceil(share * (1 << 40))))
    found = voted(signals(chosen, features=True)).select("votes", "buckets", "weights")
    found = found.orderBy("votes", F.xxhash64("buckets", "weights")).toArrow().combine_chunks()
    if not found.num_rows:
        return Scorer(np.zeros(1 << BITS), float(np.log(model.good / (1 - model.good))), BITS)
    flat_lists = [found.column(c).combine_chunks().flatten().to_numpy() for c in ("votes", "buckets", "weights")]
    sizes = np.asarray(found.column("buckets").combine_chunks().value_lengths())
    label = model.posterior(flat_lists[0].reshape(found.num_rows, -1))
    return fit_scorer(np.repeat(np.arange(len(sizes)), sizes), flat_lists[1], flat_lists[2], label)


def scored(
    docs: DataFrame, scorer: Scorer | None = None, threshold: float = THRESHOLD, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Columns doc_id, n_words, score (0 to 1, higher is better) and kept, for every row of ``docs`` (doc_id, text).

    A null or empty text has no features, so its score is that of the bias alone. Rows are
    scored one by one, repeated ones too; a very long text is measured whole; an empty table gives
    no rows; there are no ties to break; of the other columns those of ``keep`` are kept.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(scorer or fit(docs))
    rows = docs.select(*dict.fromkeys((*keep, "text")))
    schema = extended(rows.select(*keep), "n_words long, score double, kept boolean")

    def run(batches):
        for batch in batches:
            for low, high in pieces(batch.column("text")):
                part = batch.slice(low, high - low)
                words = Words(*flat(part.column("text")))
                score = model.value.score(words)
                columns = [pa.array(words.counts()), pa.array(score), pa.array(score >= threshold)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


def passed(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that a scorer fitted on ``docs`` does not reject.

    Nulls, empty and very long texts, repeated rows and empty tables are as in ``scored``: each row is
    kept or not by its own text, and clashing column names are carried through.
    """
    found = scored(carried(docs), fit(docs), threshold, ("doc", "text"))
    return restored(found.filter("kept"), docs)
