"""Mixture-controlled packing: deficit round robin over source queues into fixed windows.

Every source is a queue of its documents' tokens. In each round a queue's deficit grows
by its share of one window, the whole tokens of the deficit are served, and the rest is
carried into the next round. The rounds, laid end to end, are cut into windows, so every
window holds the target proportions to a token per queue, and only the last is short.

What a queue has served before a round follows from its total alone, so each task places
its own documents: it needs the tokens of its queue in earlier partitions, and nothing
passes from task to task.

Sources beyond a number of queues stand in one that is itself served in turn: its sources'
tokens are cut into units, and the units go by how far they lie in their own source, so a
stretch of that queue holds its sources in proportion, however many there are.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldshelf.llm.bpe import WHITE_SPACE, Bpe, broadcast_vocabulary, byte_strings, pretoken_starts, worker_bpe
from coldshelf.llm.cluster import extended, lean, ship, written
from coldshelf.llm.textops import flat, pieces, spans

WINDOW = 2048
END_ID = 1
#: Queues without a mixture; a mixture has one for each source that it names, and one for the rest.
MAX_QUEUES = 1024
#: Tokens of a unit of the sources that share a queue.
UNIT = 256
#: Bits of a token's fraction that deficits are counted in, at most.
_SHIFT = 32
#: Rounds and queues that are looked at together, by their product.
_CELLS = 1 << 20
_ROWS = 512
#: Rows of texts that a worker is handed at a time, and bytes of them that are encoded at a time.
_HANDED = 2048
_ENCODED = 1 << 21
#: Pre-tokens that go to the tokenizers library in one call.
_MERGED = 1 << 14


#: Bytes before which a blank begins a new pre-token for sure: none that begin white space.
_SOLID = np.ones(256, bool)
_SOLID[[sign.encode()[0] for sign in WHITE_SPACE]] = False


class LibraryBpe(Bpe):
    """The same ids, for a column of texts at a time.

    Texts are cut at their blanks, each distinct stretch of a batch is looked at once, and its
    distinct pre-tokens are merged by the tokenizers library, many in one call.
    """

    def __init__(self, vocabulary, merges, special):
        super().__init__(vocabulary, merges, special)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer, models, pre_tokenizers

        # All are distinct, so the library's own memory of words would find none.
        self._library = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, cache_capacity=0))
        self._library.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\0")
        # The code points that stand for bytes; none is 0, which divides what the library is given.
        self._signs = np.zeros(256, np.uint32)
        for sign, byte in byte_strings().items():
            self._signs[byte] = ord(sign)
        self._bytes = np.diff(self.strings[1])

    def merge_all(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts, each = [np.zeros(0, self.id_type)], [np.zeros(0, np.int64)]
        for low in range(0, len(begin), _MERGED):
            some = size[low : low + _MERGED]
            count = int(some.sum())
            points = np.zeros(count + len(some) - 1, np.uint32)
            place = np.arange(count) + np.repeat(np.arange(len(some)), some)
            points[place] = self._signs[data[spans(begin[low : low + _MERGED], some)]]
            joined = points.tobytes().decode("utf-32-le")
            ids = np.array(self._library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.id_type)
            # A pre-token's ids are those whose bytes end in it.
            ends = np.searchsorted(np.cumsum(self._bytes[ids]), np.cumsum(some)) + 1
            parts.append(ids)
            each.append(np.diff(ends, prepend=0))
        return np.concatenate(parts), np.concatenate(each)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the bounds of the texts in them; none of a null."""
        data, bounds = flat(texts)
        blank = data == 32
        blank[:-1] &= _SOLID[data[1:]]
        blank[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = False  # nothing follows in its text
        edge = np.append(blank, False)
        edge[bounds] = True
        edges = np.flatnonzero(edge)
        stretches = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges), pa.py_buffer(data)).dictionary_encode()
        ids, ends = self._plain(stretches.dictionary.to_numpy(zero_copy_only=False).tolist())
        which = stretches.indices.to_numpy(zero_copy_only=False)
        each = np.diff(ends)[which]
        done = np.concatenate(([0], np.cumsum(each)))
        bounds = done[np.searchsorted(edges, bounds)]
        # A batch has fewer ids than 32 bits count, and half the memory is twice as fast.
        kind = np.int32 if done[-1] < 1 << 31 else np.int64
        ids = ids[np.arange(done[-1], dtype=kind) + np.repeat((ends[which] - done[:-1]).astype(kind), each)]
        alone = self._with_special(texts)
        if len(alone):
            parts = np.split(ids, bounds[1:-1])
            for i in alone:
                parts[i] = self.encode([texts[i].as_py()])[0]
            ids, bounds = np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return ids, bounds

    def _with_special(self, texts: pa.Array) -> np.ndarray:
        """The numbers of texts that hold a special string, which has an id of its own."""
        found = [pc.fill_null(pc.match_substring(texts, string), False).to_numpy(zero_copy_only=False) for string in self.special]
        return np.flatnonzero(np.any(found, axis=0)) if found else np.zeros(0, np.int64)

    def _plain(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct stretches without special strings, and their bounds."""
        lengths = np.fromiter(map(len, stretches), np.int64, len(stretches))
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        joined = "".join(stretches)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        if not len(points):
            return np.zeros(0, self.id_type), np.zeros(len(stretches) + 1, np.int64)
        begin = pretoken_starts(points, bounds)
        size = np.diff(np.append(begin, len(points)))
        known, each, which = self.merged(joined, points, begin, size)
        start = np.cumsum(each) - each
        ids = known[spans(start[which], each[which])]
        done = np.concatenate(([0], np.cumsum(each[which])))
        return ids, done[np.searchsorted(begin, bounds)]


class Schedule:
    """Which tokens of each queue a round serves, and where they lie in the whole.

    Amounts are whole numbers of fractions of a token, so that deficits add up without
    rounding. As queues run empty, rounds get shorter; when less than half of a window's share
    is left, a new phase begins, in which the rest share whole windows by their weights. There
    are a few dozen phases at most, however many queues.
    """

    def __init__(self, totals: list[int], weights: list[float] | None = None, window: int = WINDOW):
        self.shift = min(_SHIFT, 60 - (sum(totals) + window).bit_length())
        if self.shift < 8:
            raise ValueError("more tokens than a schedule can count")
        self.limit = np.array(totals, np.int64) << self.shift
        shares = np.array(totals if weights is None else [round(w * (1 << 40)) for w in weights], object)
        first, base, rate = [0], [], []
        done = np.zeros(len(totals), np.int64)
        while (left := np.flatnonzero(done < self.limit)).size:
            # Queues without a share come when all others are empty.
            own = left[shares[left] > 0]
            share = shares if own.size else np.array(totals, object)
            own = own if own.size else left
            whole = int(sum(share[own]))
            now = np.zeros(len(totals), np.int64)
            now[own] = [max(1, (window << self.shift) * s // whole) for s in share[own]]
            ends = -(-(self.limit[own] - done[own]) // now[own])
            order = np.argsort(ends, kind="stable")
            gone = np.cumsum(now[own][order])
            steps = int(ends[order][np.searchsorted(gone, gone[-1] / 2)])
            base.append(done)
            rate.append(now)
            first.append(first[-1] + steps)
            done = np.minimum(self.limit, done + np.minimum(steps, -(-(self.limit - done) // np.maximum(now, 1))) * now)
        self.edges = np.array(first)
        shape = (len(base), len(totals))
        self.base, self.rate = np.array(base, np.int64).reshape(shape), np.array(rate, np.int64).reshape(shape)

    def served(self, rounds: np.ndarray) -> np.ndarray:
        """Whole tokens that each queue has served before each of the rounds."""
        phase = np.clip(np.searchsorted(self.edges, rounds, side="right") - 1, 0, max(0, len(self.base) - 1))
        out = np.empty((len(rounds), len(self.limit)), np.int64)
        for p in np.unique(phase):
            chosen = phase == p
            left, rate = self.limit - self.base[p], self.rate[p]
            # No more steps than it takes to empty a queue, so that nothing overflows.
            steps = np.minimum((rounds[chosen] - self.edges[p])[:, None], -(-left // np.maximum(rate, 1)))
            out[chosen] = self.base[p] + np.minimum(left, steps * rate)
        return out >> self.shift

    def round_of(self, queue: int, tokens: np.ndarray) -> np.ndarray:
        """The rounds that serve some of a queue's tokens."""
        after = (tokens + 1) << self.shift
        p = np.searchsorted(self.base[:, queue], after) - 1
        return self.edges[p] + (after - 1 - self.base[p, queue]) // self.rate[p, queue]

    def places(self, queue: int, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All services of some stretches of a queue's tokens: the stretch's number, and the first token,
        number and place in the whole of each service."""
        low = self.round_of(queue, begin)
        count = self.round_of(queue, end - 1) - low + 1
        which = np.repeat(np.arange(len(begin)), count)
        rounds = spans(low, count)
        known = np.unique(np.concatenate((rounds, rounds + 1)))
        own, ahead = np.empty(len(known), np.int64), np.empty(len(known), np.int64)
        whole = np.empty(len(known), np.int64)
        block = max(1, _CELLS // max(1, len(self.limit)))
        for at in range(0, len(known), block):
            done = self.served(known[at : at + block])
            own[at : at + block] = done[:, queue]
            ahead[at : at + block] = done[:, :queue].sum(axis=1)
            whole[at : at + block] = done.sum(axis=1)
        now = np.searchsorted(known, rounds)
        after = np.searchsorted(known, rounds + 1)
        start = np.maximum(own[now], begin[which])
        size = np.minimum(own[after], end[which]) - start
        place = whole[now] + ahead[after] - ahead[now] + start - own[now]
        keep = size > 0
        return which[keep], start[keep], size[keep], place[keep]


def cut_at_windows(which, start, size, place, window: int):
    """The same tokens, with no piece across a window's edge."""
    while True:
        room = window - place % window
        over = size > room
        if not over.any():
            return which, start, size, place
        head = np.minimum(size, room)
        rest = [which[over], (start + head)[over], (size - head)[over], (place + head)[over]]
        which, start, size, place = (np.concatenate(x) for x in zip((which, start, head, place), rest))
        order = np.lexsort((start, which))
        which, start, size, place = which[order], start[order], size[order], place[order]


def tokenised(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Columns doc_id, source, part, begin, n_tokens and ids for each document.

    ``ids`` holds the ids with the closing one, in the vocabulary's width; ``begin`` counts
    the tokens of the same source that stand earlier in the same partition, ``part``.
    """
    spark = docs.sparkSession
    ship(spark)
    vocabulary = broadcast_vocabulary(spark, path)
    rows = docs.select("doc_id", "source", "text")
    schema = extended(rows.drop("text"), "part long, begin long, n_tokens long, ids binary")

    def run(batches):
        bpe = worker_bpe(vocabulary, LibraryBpe)
        part = TaskContext.get().partitionId()
        ahead: dict = {}
        for batch in batches:
            for low, high in pieces(batch.column("text"), _ENCODED):
                ids, bounds = bpe.encode_column(batch.column("text").slice(low, high - low))
                sources = batch.column("source").slice(low, high - low)
                each = np.diff(bounds) + 1
                begin = []
                for source, size in zip(sources.to_pylist(), each.tolist()):
                    begin.append(ahead.get(source, 0))
                    ahead[source] = begin[-1] + size
                whole = np.insert(ids, bounds[1:], end_id).astype(bpe.id_type)
                edges = np.concatenate(([0], np.cumsum(each))) * bpe.id_type.itemsize
                blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(each), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(whole)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), sources, pa.array([part] * len(each), pa.int64()), pa.array(begin, pa.int64()), pa.array(each), blobs.cast(pa.binary())],
                    names=schema.names,
                )

    return rows.mapInArrow(lean(run), schema)


def pack(
    docs: DataFrame,
    path: str,
    *,
    mixture: Mapping[str | None, float] | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    max_queues: int = MAX_QUEUES,
) -> DataFrame:
    """Packs every token of ``docs`` (doc_id, source, text) into windows of ``window`` tokens.

    ``mixture`` gives each source's share of a window, and each source that it names has a
    queue. All others share one queue, whose share is what the named ones, absent or not, leave
    of 1; if nothing is left they come last. Without a mixture the shares are those of the
    corpus, so all queues run empty together; there are ``max_queues`` queues, the largest
    sources' and one for the rest. The sources of a shared queue are held in proportion to
    their tokens over its units.

    One row per piece: doc_id, source, start and length (in the document's ids), doc_tokens,
    sequence_id, offset (place in the window), and ids (little-endian unsigned 32-bit).
    Every id lies in one piece; all windows but the last are full. A null or empty text
    is the closing id alone; a very long one fills many windows, whole; null sources are a
    source; rows with the same doc_id are packed each for itself; sources of equal size go by
    name; an empty table gives no rows; other columns are left out.
    """
    spark = docs.sparkSession
    tokens = written(tokenised(docs, path, end_id), handed=_HANDED)
    by_part = written(tokens.groupBy("source", "part").agg(F.sum("n_tokens").alias("tokens")))
    named = by_part.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    if mixture is not None:
        names = spark.createDataFrame([(s,) for s in mixture], "source string")
        named = named.join(F.broadcast(names), named.source.eqNullSafe(names.source), "left_semi")
        own = named.orderBy(F.desc("tokens"), F.asc_nulls_last("source")).collect()  # no more than the mixture names
    else:
        # One more than there may be tells whether any have to share.
        own = named.orderBy(F.desc("tokens"), F.asc_nulls_last("source")).limit(max_queues + 1).collect()
        own = own if len(own) <= max_queues else own[: max_queues - 1]
    whole = by_part.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    totals = [r.tokens for r in own]
    weights = [mixture[r.source] for r in own] if mixture is not None else None
    if shared := whole - sum(totals):
        totals.append(shared)
        if weights is not None:
            weights.append(max(0.0, 1 - sum(mixture.values())))
    queues = spark.createDataFrame([(r.source, i) for i, r in enumerate(own)], "name string, queue int")
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = by_part.withColumn("ahead", F.coalesce(F.sum("tokens").over(ahead), F.lit(0)))
    parts = parts.join(F.broadcast(queues), parts.source.eqNullSafe(F.col("name")), "left").drop("name")
    parts = written(parts).alias("p")
    placed = (
        tokens.alias("t")
        .join(parts, F.col("t.source").eqNullSafe(F.col("p.source")) & (F.col("t.part") == F.col("p.part")))
        .select(
            "t.doc_id", "t.source", "queue", (F.col("begin") + F.col("ahead")).alias("begin"), F.lit(0).cast("long").alias("start"),
            "n_tokens", F.col("n_tokens").alias("doc_tokens"), "ids",
        )
    )
    if shared:
        sizes = by_part.groupBy("source").agg(F.sum("tokens").alias("total"))
        rest = _in_turn(placed.filter(F.col("queue").isNull()).drop("queue"), sizes)
        placed = placed.filter(F.col("queue").isNotNull()).unionByName(rest.withColumn("queue", F.lit(len(own))))
    plan = spark.sparkContext.broadcast(Schedule(totals, weights, window))
    schema = extended(
        placed.select("doc_id", "source"),
        "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                yield _pieces(plan.value, batch.slice(low, _ROWS), window)

    return placed.mapInArrow(lean(run), schema)


def _in_turn(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of sources that share a queue, in units, with their places in it.

    A unit goes by the share of its source's tokens that lies before a point of it. Units are
    sorted over all tasks, and what each task holds is summed up for those after it.
    """
    total = F.col("total")
    rows = rows.alias("r").join(sizes.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))).select("r.*", "total")
    unit = F.explode(F.sequence(F.floor(F.col("begin") / UNIT), F.floor((F.col("begin") + F.col("n_tokens") - 1) / UNIT)))
    rows = rows.select("*", unit.alias("unit"))
    low = F.greatest("begin", F.col("unit") * UNIT)
    high = F.least(F.col("begin") + F.col("n_tokens"), (F.col("unit") + 1) * UNIT)
    width = F.expr("length(ids) div n_tokens")
    # Where in its units a source stands; without it, sources of one unit would all come together.
    phase = F.pmod(F.xxhash64("source"), F.lit(1 << 20)) / (1 << 20)
    rows = rows.select(
        "doc_id",
        "source",
        low.alias("own"),
        (low - F.col("begin")).alias("start"),
        (high - low).alias("n_tokens"),
        "doc_tokens",
        F.substring("ids", ((low - F.col("begin")) * width + 1).cast("int"), ((high - low) * width).cast("int")).alias("ids"),
        ((F.col("unit") * UNIT + F.least(F.lit(UNIT), total - F.col("unit") * UNIT) * phase) / total).alias("lies"),
    )
    order = ["lies", "source", "own"]
    schema = extended(rows.drop("lies", "own"), "part long, begin long")

    def run(batches):
        part, begin = TaskContext.get().partitionId(), 0
        for batch in batches:
            ends = begin + np.cumsum(batch.column("n_tokens").to_numpy())
            starts = np.concatenate(([begin], ends[:-1]))
            begin = int(ends[-1]) if len(ends) else begin
            columns = [batch.column(c) for c in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(ends), part)), pa.array(starts)], names=schema.names)

    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("lies", "own")
    units = written(sorted_rows.mapInArrow(lean(run), schema))
    sums = units.groupBy("part").agg(F.sum("n_tokens").alias("tokens")).orderBy("part").collect()  # a row a partition
    before = np.concatenate(([0], np.cumsum([r.tokens for r in sums]))).tolist()
    offsets = units.sparkSession.createDataFrame([(r.part, b) for r, b in zip(sums, before)], "part long, before long")
    return units.join(F.broadcast(offsets), "part").withColumn("begin", F.col("begin") + F.col("before")).drop("part", "before")


def _pieces(plan: Schedule, batch: pa.RecordBatch, window: int) -> pa.RecordBatch:
    queue, begin, size, first = (batch.column(c).to_numpy() for c in ("queue", "begin", "n_tokens", "start"))
    found = []
    for q in np.unique(queue):
        rows = np.flatnonzero(queue == q)
        which, start, length, place = cut_at_windows(*plan.places(int(q), begin[rows], begin[rows] + size[rows]), window)
        found.append((rows[which], start - begin[rows][which], length, place))
    row, start, length, place = (np.concatenate(x) for x in zip(*found))
    # The pieces of a row cover its ids without a gap, so in order they are the ids one after the other.
    order = np.lexsort((start, row))
    row, start, length, place = row[order], start[order], length[order], place[order]
    blobs = zip(batch.column("ids").to_pylist(), size.tolist())
    ids = np.concatenate([np.frombuffer(b, "<u2" if len(b) == 2 * n else "<u4").astype("<u4") for b, n in blobs])
    edges = np.concatenate(([0], np.cumsum(length * 4))).astype(np.int32)
    pieces = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges), pa.py_buffer(ids)])
    columns = [start + first[row], length, batch.column("doc_tokens").to_numpy()[row], place // window, place % window]
    taken = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(taken), batch.column("source").take(taken), *(pa.array(c.astype(np.int64)) for c in columns), pieces],
        names=["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
    )
