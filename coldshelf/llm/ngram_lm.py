"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

A count is stored as the number of its binary digits, its level: the filter holds the n-gram
once for each level up to its own, and a count is read by probing level after level until
one is absent. Words and bigrams are told by 64 bits of hash, so there is no vocabulary to
hand out, and every n-gram that was seen is in the model's filter, whatever their number.

The filter consists of segments, whose number grows with the texts. What a segment holds is
gathered by one shuffle, from the distinct n-grams and counts of large pieces of text, and each
segment has as many bits as its n-grams need; it also holds the exact counts of its words, for
the plain score. The bits of all segments are broadcast to the workers, which probe them as they
score; a filter beyond a size that workers can hold stays a table, and every chunk of texts asks
the segments for its n-grams by a join. Both give the same scores, to the last bit. Exact counts
of words are always asked for by a join, since their table grows without bound.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StructField, StructType

from coldshelf.llm.cluster import extended, lean, ship, trimmed, written
from coldshelf.llm.textops import MASK, Words, flat, mix, pieces

FOLDS, HELD_OUT = 10, 0
ADD = 0.1
WEIGHT = 0.7  # of the bigram in the smoothed probability, after a frequent first word
HALF = 10.0  # count of the first word at which the weight is half of that
LEAST_COUNT = 2  # of the n-grams in a filter that is asked for no other; the model's has all
BITS_PER_ENTRY = 12
PROBES = 5
#: Bytes of training texts for each segment.
SEGMENT_BYTES = 1 << 22
#: Bytes of the bits that are broadcast, at most.
BROADCAST_BYTES = 128 << 20
#: Bytes of texts whose n-grams are counted together, and of a chunk that is scored: so few that 16 bits
#: tell its distinct words apart.
COUNTED, SCORED = 1 << 22, 1 << 20
MAX_LEVEL = 48
_KEY = 40  # bits that tell the n-grams of a segment apart

#: The end and the begin of a text in place of a word's hash.
END_HASH, BEGIN_HASH = -1, -2


def held_out() -> Column:
    """Rows that nothing is learned from; a row without doc_id counts as one with an empty one."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == HELD_OUT


# --- n-grams --------------------------------------------------------------------


def _chunks(batch: pa.RecordBatch, *limit: int):
    for low, high in pieces(batch.column("text"), *limit):
        yield low, high, Words(*flat(batch.column("text").slice(low, high - low)))


def _singles(words: np.ndarray) -> np.ndarray:
    """N-grams of single words, from their hashes."""
    return mix(words.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)).view(np.int64)


def _bigrams(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    """N-grams of two words, from their hashes."""
    first = mix(before.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD1342543DE82EF95)
    return mix(first + now.view(np.uint64)).view(np.int64)


def _sequence(which: np.ndarray, first: np.ndarray, end: int, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all tokens of a chunk, ends included: the word before, and the word; and where each text begins."""
    now = np.insert(which, first[1:], end)
    start = first[:-1] + np.arange(len(first) - 1)
    before = np.empty_like(now)
    before[1:] = now[:-1]
    before[start] = begin
    return before, now, start


def _keys(grams: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of each n-gram within its segment, and the segment."""
    base = mix(grams.view(np.uint64) + np.uint64(1))
    return base & np.uint64((1 << _KEY) - 1), (base >> np.uint64(_KEY)).astype(np.int64) % segments


def _packed(keys: np.ndarray) -> bytes:
    """Keys as little-endian numbers of five bytes."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : _KEY // 8].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) * 8 // _KEY, 8), np.uint8)
    out[:, : _KEY // 8] = np.frombuffer(data, np.uint8).reshape(-1, _KEY // 8)
    return out.view("<u8").ravel().astype(np.uint64)


def _by_segment(grams: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of n-grams by segment, their keys in that order, and where each segment's begin in it."""
    keys, segment = _keys(grams, segments)
    order = np.argsort(segment, kind="stable")
    return order, keys[order], np.searchsorted(segment[order], np.arange(segments + 1))


# --- counting -------------------------------------------------------------------

_COUNTED = "segment long, pairs binary, n binary, singles binary, exact binary"


def _counted(pairs: np.ndarray, n: np.ndarray, singles: np.ndarray, exact: np.ndarray, segments: int) -> pa.RecordBatch:
    """A row for each segment with the keys and counts of the pairs, and single n-grams and counts, that lie in it."""
    order, keys, bounds = _by_segment(pairs, segments)
    own_order, _, own_bounds = _by_segment(singles, segments)
    n, singles, exact = n[order].astype("<u4"), singles[own_order], exact[own_order].astype("<u4")
    some = np.flatnonzero(np.diff(bounds) + np.diff(own_bounds))
    rows = []
    for k in some:
        a, b, c, d = bounds[k], bounds[k + 1], own_bounds[k], own_bounds[k + 1]
        rows.append((_packed(keys[a:b]), n[a:b].tobytes(), singles[c:d].tobytes(), exact[c:d].tobytes()))
    columns = [pa.array(c, pa.binary()) for c in zip(*rows)] if rows else [pa.array([], pa.binary())] * 4
    return pa.RecordBatch.from_arrays([pa.array(some), *columns], names=["segment", "pairs", "n", "singles", "exact"])


def gathered(texts: DataFrame, segments: int) -> DataFrame:
    """Pairs of neighbouring tokens and single tokens of all texts, counted piece by piece, by segment.

    The end of a text is a token; its begin stands before the first, and is seen as often.
    """
    ship(texts.sparkSession)

    def run(batches):
        for batch in batches:
            for low, high, words in _chunks(batch, COUNTED):
                hashes = words.hash.view(np.int64)
                before, now, _ = _sequence(hashes, words.first, END_HASH, BEGIN_HASH)
                pairs, n = np.unique(_bigrams(before, now), return_counts=True)
                kinds, exact = np.unique(hashes, return_counts=True)
                kinds = np.concatenate((kinds, [END_HASH, BEGIN_HASH]))
                exact = np.concatenate((exact, [high - low, high - low]))
                yield _counted(pairs, n, _singles(kinds), exact, segments)

    return texts.select("text").mapInArrow(lean(run), _COUNTED)


# --- the filter ---------------------------------------------------------------


def _steps(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """First probe and step of one level of each n-gram."""
    own = mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 & MASK))
    return own, (own >> np.uint64(32)) | np.uint64(1)


def levels(counts: np.ndarray) -> np.ndarray:
    """Binary digits of the counts: 1, 2 to 3, 4 to 7, ..."""
    return np.frexp(counts.astype(float))[1]


@dataclass(frozen=True)
class Bits:
    """The bits of some segments, one after the other; where each segment's begin (in bytes), and how many it has."""

    data: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(blobs: dict[int, bytes], segments: int) -> Bits:
        """Bits by segment; a segment without any has no n-gram."""
        length = np.array([len(blobs.get(k, b"")) for k in range(segments)], np.int64)
        data = np.frombuffer(b"".join(blobs[k] for k in sorted(blobs)), np.uint8)
        return Bits(data, np.cumsum(length) - length, (length * 8).astype(np.uint64))

    def levels(self, keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Levels of n-grams: the highest that all lower ones lead to; 0 if absent."""
        level = np.zeros(len(keys), np.uint8)
        left = np.flatnonzero(self.size[segment] > 0)
        keys, segment = keys[left], segment[left]
        for k in range(1, MAX_LEVEL):
            if not len(left):
                break
            own, step = _steps(keys, k)
            for probe in range(PROBES):  # what one probe misses needs no other
                at = (own + step * np.uint64(probe)) % self.size[segment]
                byte = self.start[segment] + (at >> np.uint64(3)).astype(np.int64)
                there = ((self.data[byte] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
                left, keys, segment, own, step = (x[there] for x in (left, keys, segment, own, step))
            level[left] = k
        return level


def _bits(keys: np.ndarray, level: np.ndarray) -> bytes:
    """The bits of a segment whose n-grams have these levels: as many as there are entries for."""
    size = -(-int(level.sum()) * BITS_PER_ENTRY // 8) * 8
    bits = np.zeros(size, bool)
    for k in range(1, int(level.max(initial=0)) + 1):
        own, step = _steps(keys[level >= k], k)
        for probe in range(PROBES):
            bits[(own + step * np.uint64(probe)) % np.uint64(size)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _estimates(level: np.ndarray) -> np.ndarray:
    """Counts that levels stand for: the middle of each."""
    level = level.astype(float)
    return np.where(level > 1, 1.5 * 2.0 ** (level - 1), level)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct key in order, and the sum of its counts."""
    kept, which = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(kept), np.int64)
    np.add.at(sums, which, n)
    return kept, sums


@dataclass(frozen=True)
class CountFilter:
    """A table of segments, their number, and sums over the words it was built from.

    Its columns are segment, bits, and the single n-grams of the segment in order with their
    exact counts (singles, exact). ``size`` is that of all bits, in bytes.
    """

    table: DataFrame
    segments: int
    size: int
    tokens: int
    distinct: int

    def bits(self) -> Bits:
        """The bits of all segments, on the driver; for a filter of at most ``BROADCAST_BYTES``."""
        rows = self.table.select("segment", "bits").toLocalIterator()
        return Bits.of({row.segment: bytes(row.bits) for row in rows}, self.segments)


def count_filter(rows: DataFrame, segments: int, least: int = LEAST_COUNT) -> CountFilter:
    """The filter of all n-grams with a count of ``least`` or more, from rows of ``gathered``."""
    begin = int(_singles(np.array([BEGIN_HASH]))[0])
    schema = "segment long, bits binary, singles binary, exact binary, size long, tokens long, distinct long"

    def build(group: pa.Table) -> pa.Table:
        joined = {c: b"".join(group[c].to_pylist()) for c in ("pairs", "n", "singles", "exact")}
        keys, n = _summed(_unpacked(joined["pairs"]), np.frombuffer(joined["n"], "<u4"))
        singles, exact = _summed(np.frombuffer(joined["singles"], np.int64), np.frombuffer(joined["exact"], "<u4"))
        keys = np.concatenate((keys, _keys(singles, segments)[0]))
        n = np.concatenate((n, exact))
        keys, n = keys[n >= least], n[n >= least]
        bits = _bits(keys, levels(n))
        word = singles != begin
        sums = len(bits), int(exact[word].sum()), int(word.sum())
        row = {"segment": group["segment"][0].as_py(), "bits": bits, "singles": singles.tobytes(), "exact": exact.tobytes()}
        return trimmed(pa.Table.from_pylist([row | dict(zip(("size", "tokens", "distinct"), sums))]))

    table = written(rows.groupBy("segment").applyInArrow(build, schema), spent=True)
    whole = table.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("size", "tokens", "distinct"))).first()
    return CountFilter(table, segments, whole["size"], whole.tokens, whole.distinct)


# --- the model and scores -----------------------------------------------------


def learn(docs: DataFrame) -> CountFilter:
    """The model of the documents that are not held out, with every n-gram that is seen in them."""
    ship(docs.sparkSession)
    texts = docs.filter(~held_out()).select("text")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    segments = max(1, -(-size // SEGMENT_BYTES))
    return count_filter(gathered(texts, segments), segments, least=1)


def _logs(pair: np.ndarray, first: np.ndarray, single: np.ndarray, model_tokens: int, distinct: int) -> np.ndarray:
    """log10 of the smoothed probability of a token after another, by estimated counts.

    The bigram's share of its first word is mixed with the second word's own share, which
    counts for more the rarer the first word is.
    """
    kinds = distinct - (model_tokens > 0) + 2
    alone = (single + ADD) / (model_tokens + ADD * kinds + 1)
    return np.log10(WEIGHT * np.minimum(pair, first) / (first + HALF) + (1 - WEIGHT * first / (first + HALF)) * alone)


def _bodies(rows: DataFrame) -> DataFrame:
    """Texts in chunks: the ids and flags of a chunk's rows, the words of each, the hashes of the chunk's
    distinct words in order, and which of them each word is, in 16 bits if that will do."""
    schema = StructType(
        [
            *StructType.fromDDL("chunk long").fields,
            StructField("doc_id", ArrayType(rows.schema["doc_id"].dataType)),
            StructField("held_out", ArrayType(BooleanType())),
            *StructType.fromDDL("sizes binary, words binary, which binary").fields,
        ]
    )

    def run(batches):
        chunk = TaskContext.get().partitionId() << 40
        for batch in batches:
            for low, high, words in _chunks(batch, SCORED):
                part = batch.slice(low, high - low)
                distinct, which = np.unique(words.hash.view(np.int64), return_inverse=True)
                which = which.astype(np.uint16 if len(distinct) < 1 << 16 else np.uint32)
                lists = [pa.ListArray.from_arrays(pa.array([0, high - low], pa.int32()), pa.concat_arrays([part.column(c)])) for c in ("doc_id", "held_out")]
                blobs = [pa.array([x.tobytes()], pa.binary()) for x in (words.counts().astype(np.int64), distinct, which)]
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), *lists, *blobs], names=schema.names)
                chunk += 1

    return rows.mapInArrow(lean(run), schema)


class _Body:
    """The distinct n-grams of a chunk, and where its tokens use them."""

    def __init__(self, sizes: bytes, words: bytes, which: bytes):
        words = np.frombuffer(words, np.int64)
        which = np.frombuffer(which, np.uint16 if len(words) < 1 << 16 else np.uint32).astype(np.int64)
        self.sizes = np.frombuffer(sizes, np.int64)
        words = np.concatenate((words, [END_HASH, BEGIN_HASH]))
        first = np.concatenate(([0], np.cumsum(self.sizes)))
        before, self.now, self.begin = _sequence(which, first, len(words) - 2, len(words) - 1)
        pair, self.index = np.unique(before * len(words) + self.now, return_inverse=True)
        self.first, self.second = pair // len(words), pair % len(words)
        self.pairs, self.singles = _bigrams(words[self.first], words[self.second]), _singles(words)


def _asked(bodies: DataFrame, segments: int, pairs: bool) -> DataFrame:
    """A row for each chunk and segment: the chunk's single n-grams, and keys of its pairs, that lie in the segment."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                body = _Body(*(batch.column(c)[row].as_py() for c in ("sizes", "words", "which")))
                _, keys, bounds = _by_segment(body.pairs if pairs else body.pairs[:0], segments)
                order, _, own = _by_segment(body.singles, segments)
                singles = body.singles[order]
                some = np.flatnonzero(np.diff(bounds) + np.diff(own))
                blobs = [
                    pa.array([_packed(keys[bounds[k] : bounds[k + 1]]) for k in some], pa.binary()),
                    pa.array([singles[own[k] : own[k + 1]].tobytes() for k in some], pa.binary()),
                ]
                chunk = pa.array(np.full(len(some), batch.column("chunk")[row].as_py()))
                yield pa.RecordBatch.from_arrays([chunk, pa.array(some), *blobs], names=["chunk", "segment", "pairs", "asked"])

    asked = "chunk long, segment long, pairs binary, asked binary"
    return bodies.select("chunk", "sizes", "words", "which").mapInArrow(lean(run), asked)


def _answered(asked: DataFrame, model: CountFilter, pairs: bool) -> DataFrame:
    """Of each chunk and segment: exact counts of its words, and with ``pairs`` the levels of its pairs and words."""
    segments = model.segments
    schema = "chunk long, segment long, pairs binary, levels binary, exact binary"
    columns = ["segment", "singles", "exact", *(["bits"] if pairs else [])]

    def answer(rows: pa.Table, table: pa.Table) -> pa.Table:
        held = table.to_pylist()[0] if table.num_rows else {}  # a segment of no n-gram has no row
        blobs = rows["asked"].to_pylist()
        grams, at = np.frombuffer(b"".join(blobs), np.int64), np.cumsum([len(b) // 8 for b in blobs])[:-1]
        words, exact = (np.frombuffer(held.get(c, b""), np.int64) for c in ("singles", "exact"))
        n = np.zeros(len(grams), np.int64)
        if len(words):
            place = np.minimum(np.searchsorted(words, grams), len(words) - 1)
            n = np.where(words[place] == grams, exact[place], 0)
        out = [pa.array([b""] * len(blobs), pa.binary())] * 2
        if pairs:
            bits = Bits.of({0: held.get("bits", b"")}, 1)
            asked_pairs = rows["pairs"].to_pylist()
            keys = _unpacked(b"".join(asked_pairs))
            cuts = np.cumsum([len(b) * 8 // _KEY for b in asked_pairs])[:-1]
            found = [(keys, cuts), (_keys(grams, segments)[0], at)]
            out = [_cut(bits.levels(k, np.zeros(len(k), np.int64)), cut) for k, cut in found]
        return trimmed(pa.table([rows["chunk"], rows["segment"], *out, _cut(n, at)], names=["chunk", "segment", "pairs", "levels", "exact"]))

    table = model.table.select(*columns)
    return asked.groupBy("segment").cogroup(table.groupBy("segment")).applyInArrow(_asked_only(answer, schema), schema)


def _cut(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes() for x in np.split(values, at)], pa.binary())


def _asked_only(answer, schema: str):
    """``answer`` for groups that have rows on the left; nothing for others."""
    empty = pa.schema([(c, pa.int64() if t == "long" else pa.binary()) for c, t in (x.split() for x in schema.split(", "))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return answer(left, right) if left.num_rows else empty.empty_table()

    return run


def scored(docs: DataFrame, model: CountFilter | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text) by a model, which is learned from ``docs`` by default.

    Columns doc_id, held_out, n_tokens (words and the end), n_known (of words seen in
    training), train_tokens, base_score (plain probabilities by exact counts) and score (the
    model's log10 probability). A null or empty text is the end alone; a very long one is a chunk
    of its own, whole. Rows are scored one by one, repeated ones too; with nothing to learn
    from, no word is known. An empty table gives no rows; other columns are left out. A filter
    of more than ``broadcast_bytes`` is asked by a join, to the same result.
    """
    spark = docs.sparkSession
    ship(spark)
    model = model or learn(docs)
    tokens, distinct, segments = model.tokens, model.distinct, model.segments
    given = spark.sparkContext.broadcast(model.bits()) if model.size <= broadcast_bytes else None
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    bodies = written(_bodies(rows))
    schema = extended(rows.drop("text"), "n_tokens long, n_known long, train_tokens long, base_score double, score double")

    def joined(found: pa.Table, name: str, grams: np.ndarray, kind) -> np.ndarray:
        value = np.empty(len(grams), kind)
        value[_by_segment(grams, segments)[0]] = np.frombuffer(b"".join(found[name].to_pylist()), kind)
        return value

    def score(chunk: pa.Table, found: pa.Table) -> pa.Table:
        body = _Body(*(chunk[c][0].as_py() for c in ("sizes", "words", "which")))
        found = found.sort_by("segment")
        exact = joined(found, "exact", body.singles, np.int64)
        if given is None:
            found_levels = [joined(found, "pairs", body.pairs, np.uint8), joined(found, "levels", body.singles, np.uint8)]
        else:
            found_levels = [given.value.levels(*_keys(grams, segments)) for grams in (body.pairs, body.singles)]
        pair, single = map(_estimates, found_levels)
        logs = _logs(pair, single[body.first], single[body.second], tokens, distinct)
        plain = np.log10((exact + ADD) / (tokens + ADD * (distinct + 1)))
        columns = [
            body.sizes + 1,
            np.add.reduceat((exact > 0)[body.now].astype(np.int64), body.begin),
            np.full(len(body.sizes), tokens),
            np.add.reduceat(plain[body.now], body.begin),
            np.add.reduceat(logs[body.index], body.begin),
        ]
        lists = [chunk[c].combine_chunks().flatten() for c in ("doc_id", "held_out")]
        return trimmed(pa.table([*lists, *(pa.array(c) for c in columns)], names=schema.names))

    answers = written(_answered(_asked(bodies, segments, given is None), model, given is None), spent=True)
    return bodies.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)
