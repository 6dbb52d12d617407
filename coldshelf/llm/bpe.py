"""Byte-level BPE: encoding whole texts, and decoding by concatenating vocabulary strings.

A text is cut into pre-tokens, and each distinct pre-token of a batch is merged once: its
symbols form a doubly linked list, and a queue holds the rank of every adjacent pair. The
lists and queues of pre-tokens of like length stand side by side in arrays, and each step
takes the least rank of every queue. A long pre-token has a heap of its own, in which an
entry whose symbols have changed since it was queued is skipped. Cutting, finding the distinct
pre-tokens and putting the ids of all texts together are array operations too.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from coldshelf.llm.cluster import extended, ship
from coldshelf.llm.textops import pieces, range_hashes, spans

# Fixed values of byte-level BPE: contractions that are pre-tokens, Unicode white space,
# and the bytes that stand for themselves in vocabulary strings.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
WHITE_SPACE = "\t\n\v\f\r \x85\xa0                　"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

LETTER, NUMBER, SPACE, OTHER = range(4)
#: Texts that are decoded at a time.
DECODED = 256
#: Bytes of pre-tokens that are merged side by side, padded to one of these, and cells of such arrays.
WIDTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 48, 64)
_CELLS = 1 << 19
#: In a queue: the bits of a place, and what stands where no pair merges.
_PLACE, _NEVER = 6, (1 << 31) - 1


def load_vocabulary(path: str) -> tuple[dict[str, int], list[tuple[str, str]], dict[str, int]]:
    """Vocabulary, merges in rank order, and special strings of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return model["vocab"], merges, {t["content"]: t["id"] for t in spec["added_tokens"]}


def byte_strings() -> dict[str, int]:
    """The character that stands for each byte in vocabulary strings."""
    rest = (b for b in range(256) if b not in set(PRINTABLE))
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(rest)}


def character_classes() -> np.ndarray:
    categories = "".join(map(unicodedata.category, map(chr, range(0x110000))))  # two letters each
    major = np.frombuffer(categories.encode(), np.uint8)[::2]
    table = np.where(major == ord("L"), LETTER, np.where(major == ord("N"), NUMBER, OTHER)).astype(np.uint8)
    table[[ord(c) for c in WHITE_SPACE]] = SPACE
    return table


_CLASSES: list[np.ndarray] = []


def pretoken_starts(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places at which a pre-token begins, for texts given as code points and their bounds.

    Runs of letters, of digits and of other signs are pre-tokens, each with one blank
    before it; of a longer run of white space the last character is apart if more follows.
    """
    if not _CLASSES:
        _CLASSES.append(character_classes())
    size = len(points)
    kind = _CLASSES[0][points]
    edge = np.zeros(size + 1, bool)
    edge[bounds] = True
    run = edge[:-1].copy()
    run[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    blank = points == 32
    starts = run.copy()
    starts[1:] &= space[1:] | ~blank[:-1] | edge[1:-1]  # a blank belongs to the run after it
    before_more = space[:-1] & ~space[1:] & ~edge[1:-1]
    starts[:-1] |= before_more
    quote = np.flatnonzero((points == 39) & run)
    if len(quote):
        _contract(points, kind, edge, blank, quote, starts)
    return np.flatnonzero(starts)


def _contract(points, kind, edge, blank, quote, starts) -> None:
    """Moves the starts at contractions, which a quote mark begins unless a blank stands before it."""
    quote = quote[~(blank[np.maximum(quote - 1, 0)] & (quote > 0) & ~edge[quote])]
    padded = np.concatenate((points, np.zeros(4, points.dtype)))
    ends = np.concatenate((edge, np.ones(4, bool)))
    taken = np.zeros(len(quote), bool)
    for word in CONTRACTIONS:
        match = ~taken
        for place, sign in enumerate(word[1:], 1):
            match &= (padded[quote + place] == ord(sign)) & ~ends[quote + place]
        taken |= match
        found = quote[match]
        starts[found + 1] = False
        after = found + len(word)
        after = after[after < len(points)]
        starts[after[(kind[after] == LETTER) & ~edge[after]]] = True


class Bpe:
    """One vocabulary."""

    def __init__(self, vocabulary, merges, special):
        self.special = special
        single = byte_strings()
        self.byte_ids = [0] * 256
        for sign, byte in single.items():
            self.byte_ids[byte] = vocabulary[sign]
        self._merges = vocabulary, merges
        strings = {i: bytes(single[c] for c in s) for s, i in vocabulary.items()}
        strings |= {i: s.encode() for s, i in special.items()}
        size = max(strings) + 1
        self.size = size
        self.code = "H" if size <= 1 << 16 else "I"
        self.id_type = np.dtype(self.code)
        self.strings = _table([strings.get(i, b"") for i in range(size)])
        self.decimals = _table([b"%d," % i for i in range(size)])

    @cached_property
    def ranks(self) -> dict[tuple[int, int], tuple[int, int]]:
        """Rank and id of both for each pair of ids that merges; not needed to decode."""
        vocabulary, merges = self._merges
        return {(vocabulary[a], vocabulary[b]): (r, vocabulary[a + b]) for r, (a, b) in enumerate(merges)}

    @cached_property
    def pairs(self) -> "Pairs":
        return Pairs(self.ranks, self.size).set_bytes(self.byte_ids)

    def merge(self, pretoken: str) -> list[int]:
        """The ids of one pre-token."""
        return self._merge(pretoken.encode())

    def _merge(self, pretoken: bytes) -> list[int]:
        symbol = [self.byte_ids[b] for b in pretoken]
        size = len(symbol)
        ranks = self.ranks
        queue = []
        for i, pair in enumerate(zip(symbol, symbol[1:])):
            if found := ranks.get(pair):
                queue.append((found[0], i, *pair, found[1]))
        if not queue:
            return symbol
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, both = heapq.heappop(queue)
            j = after[i]
            if symbol[i] != left or j >= size or symbol[j] != right:
                continue  # stale: one of the two has been merged meanwhile
            symbol[i], symbol[j] = both, -1
            follow = after[i] = after[j]
            if follow < size:
                before[follow] = i
                found = ranks.get((both, symbol[follow]))
                if found:
                    heapq.heappush(queue, (found[0], i, both, symbol[follow], found[1]))
            lead = before[i]
            if lead >= 0:
                found = ranks.get((symbol[lead], both))
                if found:
                    heapq.heappush(queue, (found[0], lead, symbol[lead], both, found[1]))
        return [s for s in symbol if s >= 0]

    def merge_all(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some pre-tokens, given as ranges of bytes, one after the other, and the number of each one's."""
        parts = []
        low = 0
        for width in WIDTHS:
            rows = np.flatnonzero((size > low) & (size <= width))
            step = _CELLS // width
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                parts.append((some, *self._side_by_side(data, begin[some], size[some], width)))
            low = width
        rows = np.flatnonzero(size > low)
        if len(rows):
            found = [self._merge(data[begin[i] : begin[i] + size[i]].tobytes()) for i in rows]
            parts.append((rows, np.concatenate([np.array(f, np.int32) for f in found]), np.array([len(f) for f in found])))
        each = np.zeros(len(size), np.int64)
        for rows, _, count in parts:
            each[rows] = count
        start = np.cumsum(each) - each
        out = np.empty(int(each.sum()), self.id_type)
        for rows, ids, count in parts:
            out[spans(start[rows], count)] = ids
        return out, each

    def _side_by_side(self, data, begin, size, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Merges pre-tokens of up to ``width`` bytes, a column each; a row of no symbols stands below."""
        pairs, count = self.pairs, len(size)
        place = np.arange(width + 1)[:, None]
        inside = place < size
        raw = data[np.minimum(begin + place, len(data) - 1)]
        symbol = np.where(inside, np.array(self.byte_ids, np.int32)[raw], np.int32(-1))
        after = np.repeat((place + 1).astype(np.int8), count, axis=1)
        before = np.repeat((place - 1).astype(np.int8), count, axis=1)
        queue = np.full((width + 1, count), _NEVER, np.int32)
        rank = pairs.of_bytes[raw[:-1].astype(np.int32) << 8 | raw[1:]]
        queue[:-1] = np.where(inside[1:] & (rank != _NEVER), rank << _PLACE | place[:-1].astype(np.int32), _NEVER)
        column = np.arange(count)
        while True:
            least = queue.min(axis=0)
            live = np.flatnonzero(least != _NEVER)
            if not len(live):
                break
            if 2 * len(live) < len(column):
                queue, column, least = np.ascontiguousarray(queue[:, live]), column[live], least[live]
                live = np.arange(len(column))
            own, least = column[live], least[live]
            i = least & ((1 << _PLACE) - 1)
            both = pairs.made[least >> _PLACE]
            j = after[i, own]
            follow = after[j, own]
            symbol[i, own], symbol[j, own] = both, -1
            after[i, own], before[follow, own] = follow, i
            lead = before[i, own]
            queue[j, live] = _NEVER
            queue[i, live] = pairs.queued(both, symbol[follow, own], i)
            # Before the first symbol stands the row below all, which is in no pair.
            queue[lead, live] = pairs.queued(symbol[lead, own], both, lead)
        rest = symbol.T
        kept = rest >= 0
        return rest[kept], kept.sum(axis=1)

    def merged(self, joined: str, points: np.ndarray, begin: np.ndarray, size: np.ndarray):
        """Ids of the distinct pre-tokens of a text, one after the other, the number of each one's, and
        which of them each pre-token is; the text also as code points, the pre-tokens as ranges of them."""
        _, where, which = np.unique(range_hashes(points, begin, begin + size), return_index=True, return_inverse=True)
        # Where each code point's bytes begin.
        wide = (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        byte = np.zeros(len(points) + 1, np.int64)
        np.cumsum(wide + np.int8(1), out=byte[1:])
        first, last = byte[begin[where]], byte[begin[where] + size[where]]
        return *self.merge_all(np.frombuffer(joined.encode(), np.uint8), first, last - first), which

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the bounds of the texts in them."""
        parts, part_text = [], []
        for number, text in enumerate(texts):
            for part in self._parts(text or ""):
                parts.append(part)
                part_text.append(number)
        joined = "".join(p for p in parts if isinstance(p, str))
        lengths = np.fromiter((len(p) if isinstance(p, str) else 0 for p in parts), np.int64, len(parts))
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = pretoken_starts(points, bounds) if len(points) else np.zeros(0, np.int64)
        size = np.diff(np.append(begin, len(points)))
        known_ids, known_size, which = self.merged(joined, points, begin, size)
        known_start = np.cumsum(known_size) - known_size
        each = known_size[which]
        ids = known_ids[spans(known_start[which], each)]
        # The first id of every part; a special string is a part of no length with one id.
        done = np.concatenate(([0], np.cumsum(each)))
        part_start = done[np.searchsorted(begin, bounds)]
        special = [i for i, p in enumerate(parts) if not isinstance(p, str)]
        if special:
            ids = np.insert(ids, part_start[special], [parts[i] for i in special])
            added = np.zeros(len(parts) + 1, np.int64)
            added[np.array(special) + 1] = 1
            part_start = part_start + np.cumsum(added)
        edges = np.searchsorted(np.array(part_text, np.int64), np.arange(len(texts) + 1))
        return ids, part_start[edges]

    def _parts(self, text: str) -> Iterator[str | int]:
        """The text between special strings, and the ids of these."""
        while True:
            places = [(text.find(s), -len(s), s) for s in self.special]
            places = [p for p in places if p[0] >= 0]
            if not places:
                yield text
                return
            place, _, found = min(places)
            if place:
                yield text[:place]
            yield self.special[found]
            text = text[place + len(found) :]
            if not text:
                return

    def gathered(self, table: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The table's strings of all ids, joined, and where each id's string begins in them."""
        data, begin = table
        each = np.diff(begin)[ids]
        return data[spans(begin[ids], each)], np.concatenate(([0], np.cumsum(each)))

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids: their strings joined, with bytes that form no character replaced."""
        return self.gathered(self.strings, np.asarray(ids, np.int64))[0].tobytes().decode("utf-8", "replace")


class Pairs:
    """Ranks of pairs of ids, looked up for many pairs at once, and the id that each rank makes."""

    def __init__(self, ranks: dict[tuple[int, int], tuple[int, int]], size: int):
        pair = np.array(list(ranks), np.int64).reshape(-1, 2)
        found = np.array(list(ranks.values()), np.int64).reshape(-1, 2)
        if len(found) and int(found[:, 0].max()) >= _NEVER >> _PLACE:
            raise ValueError("more merges than a queue can hold")
        self._size = size + 1
        self._bits = max(8, (4 * len(pair)).bit_length())
        self._mask = (1 << self._bits) - 1
        self._keys = np.full(1 << self._bits, -1, np.int64)
        self._ranks = np.full(1 << self._bits, _NEVER, np.int32)
        self.made = np.zeros(int(found[:, 0].max()) + 1 if len(found) else 1, np.int32)
        self.made[found[:, 0]] = found[:, 1]
        keys = self._key(pair[:, 0], pair[:, 1])
        rank, place = found[:, 0], self._home(keys)
        while len(keys):  # what finds its place taken goes on to the next
            self._keys[place] = np.where(self._keys[place] < 0, keys, self._keys[place])
            done = self._keys[place] == keys
            self._ranks[place[done]] = rank[done]
            keys, rank, place = keys[~done], rank[~done], (place[~done] + 1) & self._mask

    def set_bytes(self, byte_ids: list[int]) -> "Pairs":
        """Also keeps the rank of every two bytes."""
        ids = np.array(byte_ids, np.int64)
        self.of_bytes = self.rank(np.repeat(ids, 256), np.tile(ids, 256))
        return self

    def _key(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        # No symbol is -1, and no pair that merges has the key of a pair with one.
        return (left.astype(np.int64) + 1) * self._size + (right + 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self._bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or ``_NEVER``."""
        keys = self._key(left, right)
        place = self._home(keys)
        seen = self._keys[place]
        out = np.where(seen == keys, self._ranks[place], _NEVER)
        rest = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(rest):
            place[rest] = (place[rest] + 1) & self._mask
            seen = self._keys[place[rest]]
            hit = seen == keys[rest]
            out[rest[hit]] = self._ranks[place[rest[hit]]]
            rest = rest[~hit & (seen >= 0)]
        return out

    def queued(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """What a queue holds for pairs at some places."""
        rank = self.rank(left, right)
        return np.where(rank != _NEVER, rank << _PLACE | place, _NEVER)


def _table(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    begin = np.concatenate(([0], np.cumsum([len(s) for s in strings])))
    return np.frombuffer(b"".join(strings), np.uint8), begin


_WORKER: dict[tuple, Bpe] = {}


def worker_bpe(vocabulary: Broadcast, kind: type[Bpe] = Bpe) -> Bpe:
    """The broadcast vocabulary, built once in each worker process."""
    name, spec = vocabulary.value
    if (name, kind) not in _WORKER:
        _WORKER.clear()
        _WORKER[name, kind] = kind(*spec)
    return _WORKER[name, kind]


def broadcast_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """A tokenizer file's vocabulary, of a fixed size, for all workers; read on the driver."""
    return spark.sparkContext.broadcast((path, load_vocabulary(path)))


def encoded(bpe: Bpe, column: pa.Array) -> Iterator[tuple[int, int, list, np.ndarray, np.ndarray]]:
    """Row range, texts, ids and bounds, for one part of a text column after another."""
    for low, high in pieces(column):
        texts = column.slice(low, high - low).to_pylist()
        ids, bounds = bpe.encode(texts)
        yield low, high, texts, ids, bounds


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Columns doc_id and ids (array of int): the ids of every whole text of ``docs``.

    A null or empty text has no ids; a very long one is encoded whole. Rows are encoded one by
    one, so repeated rows stay repeated; an empty table gives no rows; columns other than doc_id
    and text are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    vocabulary = broadcast_vocabulary(spark, path)
    schema = extended(docs.select("doc_id"), "ids array<int>")

    def run(batches):
        bpe = worker_bpe(vocabulary)
        for batch in batches:
            for low, high, _, ids, bounds in encoded(bpe, batch.column("text")):
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), lists], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(ids: DataFrame, path: str) -> DataFrame:
    """``ids`` (columns doc_id and ids) with a column text: the vocabulary's strings joined.

    Bytes that form no character become U+FFFD; null ids give a null text, no ids an empty one, and
    a very long list the whole text; an empty table gives no rows.
    """
    spark = ids.sparkSession
    ship(spark)
    vocabulary = broadcast_vocabulary(spark, path)
    rows = ids.select("doc_id", "ids")
    schema = extended(rows, "text string")

    def run(batches):
        bpe = worker_bpe(vocabulary)
        for whole in batches:
            for low in range(0, whole.num_rows, DECODED):
                batch = whole.slice(low, DECODED)
                lists = batch.column("ids")
                bounds = lists.offsets.to_numpy()
                flat = lists.values.to_numpy(zero_copy_only=False)
                known = lists.is_valid().to_pylist()
                texts = [bpe.decode(flat[a:b]) if ok else None for a, b, ok in zip(bounds, bounds[1:], known)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    return rows.mapInArrow(run, schema)
