"""Token files: concatenated ids, with Elias-Fano coded document boundaries and document ids.

A file holds the ids of its documents one after the other, in two bytes each where the
vocabulary allows. The boundaries between documents ascend, so they are stored as Elias
and Fano did: the low bits of each packed side by side, the high bits as a string of ones
(a boundary) and zeros (the next value of the high bits). That is about two bits and
log2(ids / documents) a document. The place of every 256th one is kept in 32 bits, so a
boundary is found by selecting from a few bytes after such a place; there is no table of
64-bit offsets. The documents' own ids ascend too, and are kept in the same way.

All files of a table together hold its documents in ascending order of doc_id. A manifest,
written by Spark when the tasks have succeeded, names them, so what a lost or repeated task
has left behind is in no manifest. Tasks write and read the files by pyarrow's file systems.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldshelf.llm.bpe import byte_strings
from coldshelf.llm.cluster import shared_folder, ship, written
from coldshelf.llm.textops import pieces, spans

MAGIC = b"EFTOKEN1"
#: Ones between two whose place is kept.
SAMPLE = 256
#: Ids after which a task begins another file; a longer document still stands whole in one.
FILE_TOKENS = 1 << 23
#: Ids, and documents, that are read at a time.
READ_TOKENS, READ_DOCUMENTS = 1 << 20, 1 << 13
#: Bytes of texts that are encoded at a time.
ENCODED = 1 << 23
#: Words that go to the library's merges in one call.
MERGED = 1 << 16
#: Words whose ids a worker remembers, and their longest.
REMEMBERED, LONGEST = 300_000, 64

_HEAD = struct.Struct("<8sBQQqQQ")  # magic, bytes of an id, documents, nulls, least doc_id, sizes of the two lists
_LIST = struct.Struct("<QQBI")  # values, bytes of high bits, low bits, places kept


# --- ascending lists ------------------------------------------------------------


def coded(values: np.ndarray) -> bytes:
    """An ascending list of 64-bit numbers in Elias and Fano's code, with its select places."""
    values = values.astype(np.uint64)
    count = len(values)
    most = int(values[-1]) if count else 0
    width = max(0, (most // max(count, 1)).bit_length() - 1)
    low = values & np.uint64((1 << width) - 1)
    bits = (low[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    places = (values >> np.uint64(width)).astype(np.int64) + np.arange(count)
    marks = np.zeros(int(places[-1]) + 1 if count else 0, bool)
    marks[places] = True
    high = np.packbits(marks, bitorder="little").tobytes()
    kept = places[::SAMPLE].astype("<u4")
    return b"".join(
        (
            _LIST.pack(count, len(high), width, len(kept)),
            np.packbits(bits.astype(bool).ravel(), bitorder="little").tobytes(),
            high,
            kept.tobytes(),
        )
    )


class Ascending:
    """A coded list; any run of its values is selected without decoding the rest."""

    def __init__(self, blob: bytes):
        self.count, high, self.width, kept = _LIST.unpack_from(blob)
        low = -(-self.count * self.width // 8)
        data = np.frombuffer(blob, np.uint8, offset=_LIST.size)
        self.low, self.high = data[:low], data[low : low + high]
        self.kept = np.frombuffer(blob, "<u4", kept, _LIST.size + low + high)

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, place: int) -> int:
        return int(self.part(place, place + 1)[0])

    def part(self, begin: int, end: int) -> np.ndarray:
        """The values from ``begin`` up to ``end``."""
        end = min(end, self.count)
        if begin >= end:
            return np.zeros(0, np.uint64)
        block, after = begin // SAMPLE, (end - 1) // SAMPLE + 1
        first = int(self.kept[block])
        stop = int(self.kept[after]) if after < len(self.kept) else 8 * len(self.high)
        byte = first // 8
        ones = np.flatnonzero(np.unpackbits(self.high[byte : -(-stop // 8)], bitorder="little")) + 8 * byte
        ones = ones[ones >= first][begin - block * SAMPLE : end - block * SAMPLE]
        values = (ones - np.arange(begin, end)).astype(np.uint64) << np.uint64(self.width)
        if self.width:
            bit = begin * self.width
            some = np.unpackbits(self.low[bit // 8 : -(-end * self.width // 8)], bitorder="little")
            some = some[bit % 8 :][: (end - begin) * self.width].reshape(-1, self.width).astype(np.uint64)
            values += (some << np.arange(self.width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return values

    def first_not_below(self, value: int) -> int:
        """The place of the first value that is ``value`` or more, found by halves."""
        low, high = 0, self.count
        while low < high:
            middle = (low + high) // 2
            if self[middle] < value:
                low = middle + 1
            else:
                high = middle
        return low


# --- files ----------------------------------------------------------------------


def file_bytes(doc_ids: list[int | None], sizes: np.ndarray, ids: list[bytes], width: int) -> Iterator[bytes]:
    """The parts of a file of documents in ascending order, nulls first."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], np.int64)
    least = int(known[0]) if len(known) else 0
    # Differences of 64-bit numbers need 64 bits without a sign.
    names = coded(known.view(np.uint64) - np.array(least, np.int64).view(np.uint64))
    bounds = coded(np.concatenate(([0], np.cumsum(sizes))))
    yield _HEAD.pack(MAGIC, width, len(doc_ids), nulls, least, len(names), len(bounds))
    yield names
    yield bounds
    yield from ids


class TokenFile:
    """An opened file. Only the two lists are held; ids are read as they are asked for."""

    def __init__(self, source: pa.NativeFile):
        self._source = source
        magic, self.width, self.documents, self.nulls, self.least, names, bounds = _HEAD.unpack(source.read_at(_HEAD.size, 0))
        if magic != MAGIC:
            raise ValueError("not a token file")
        self._names = Ascending(source.read_at(names, _HEAD.size))
        self._bounds = Ascending(source.read_at(bounds, _HEAD.size + names))
        self._ids = _HEAD.size + names + bounds

    def bounds(self, begin: int, end: int) -> np.ndarray:
        """Where documents ``begin`` up to ``end`` start in the file's ids, and where the last of them ends."""
        return self._bounds.part(begin, end + 1).astype(np.int64)

    def doc_ids(self, begin: int, end: int) -> list[int | None]:
        names = self._names.part(max(begin - self.nulls, 0), max(end - self.nulls, 0))
        known = (names + np.array(self.least, np.int64).view(np.uint64)).view(np.int64)
        return [None] * (min(end, self.documents) - begin - len(known)) + known.tolist()

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids from one place up to another, as unsigned 32-bit numbers."""
        data = self._source.read_at((end - begin) * self.width, self._ids + begin * self.width)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def document(self, doc_id: int) -> np.ndarray | None:
        """The ids of the first document with a doc_id; None if there is none."""
        if self.documents == self.nulls or doc_id < self.least:
            return None
        place = self._names.first_not_below(doc_id - self.least)
        if place == len(self._names) or self._names[place] != doc_id - self.least:
            return None
        return self.ids(*self.bounds(self.nulls + place, self.nulls + place + 1))


def place_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(path)


def opened(path: str) -> TokenFile:
    system, name = place_of(path)
    return TokenFile(system.open_input_file(name))


# --- encoding -------------------------------------------------------------------

#: Signs whose lower case and composed form are beyond doubt: printable ASCII and common Latin letters.
_PLAIN = re.compile("[!-~À-ÖØ-öø-įıĲ-ſ]+")
#: The vocabulary's own pattern, for those signs in lower case, and line ends.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|\n|[^a-zß-öø-ſ0-9\n]+")


class WordIds:
    """Ids by the tokenizers library, for a vocabulary that drops white space and marks the ends of words.

    Nothing reaches across a blank of ASCII, so the ids of a text are those of its words, and
    each distinct word of a batch is looked at once; a worker remembers words, in bounded
    number. New words of plain signs are cut into their parts here and go to the library's
    merges, many in one call; all others go through the whole library.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer, models, pre_tokenizers

        self._library = Tokenizer.from_str(spec)
        self._library.no_truncation()
        self._library.no_padding()
        model = json.loads(spec)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        suffix = model["end_of_word_suffix"]
        self._merges = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=suffix))
        self._merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\0")
        if not all("<|" in t["content"] for t in json.loads(spec)["added_tokens"]):
            raise ValueError("special strings are expected to hold <|")
        signs = {byte: sign for sign, byte in byte_strings().items()}
        self._bytes = np.zeros(max(model["vocab"].values()) + 1, np.int64)
        for string, number in model["vocab"].items():
            self._bytes[number] = len(string.removesuffix(suffix))
        self._signs = {byte: sign for byte, sign in signs.items() if byte}
        most = max(self._library.get_vocab(with_added_tokens=True).values(), default=0)
        self.type = np.dtype("<u2" if most < 1 << 16 else "<u4")
        self._new: dict[str, bytes] = {"": b""}
        self._old: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each text's; none of a null."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        words = lists.flatten().dictionary_encode()
        found = self._ids(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        each = np.fromiter(map(len, found), np.int64, len(found)) // self.type.itemsize
        start = np.cumsum(each) - each
        which = words.indices.to_numpy(zero_copy_only=False)
        size = each[which]
        ids = np.frombuffer(b"".join(found), self.type)[spans(start[which], size)]
        first = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
        return ids, np.diff(np.concatenate(([0], np.cumsum(size)))[first])

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words. Two generations keep the memory of them bounded."""
        new, old = self._new, self._old
        found = [new.get(w) or old.get(w) for w in words]
        missing = [i for i, ids in enumerate(found) if not ids]
        plain = []
        for i in missing:
            word = words[i]
            if _PLAIN.fullmatch(word) and "<|" not in word:
                plain.append(i)
            else:
                found[i] = np.array(self._library.encode(word, add_special_tokens=False).ids, self.type).tobytes()
        for i, ids in zip(plain, self._merged([words[i] for i in plain])):
            found[i] = ids
        if len(new) > REMEMBERED // 2:
            new, self._old = {"": b""}, new
            self._new = new
        new.update((words[i], found[i]) for i in missing if len(words[i]) <= LONGEST)
        return found

    def _merged(self, words: list[str]) -> list[bytes]:
        """Ids of words of plain signs, many in one call."""
        found = []
        for low in range(0, len(words), MERGED):
            lines = "\n".join(words[low : low + MERGED]).lower()
            # The vocabulary is written in signs that stand for bytes; a zero byte stands between parts.
            parts = "\0".join(_PARTS.findall(lines)).replace("\0\n\0", "\0")
            parts = parts.encode().decode("latin-1").translate(self._signs)
            encoding = self._merges.encode_batch_fast([parts], add_special_tokens=False)[0]
            ids = np.array(encoding.ids, self.type)
            # A word's ids are those whose bytes end in it.
            breaks = np.flatnonzero(np.frombuffer(lines.encode() + b"\n", np.uint8) == 10)
            last = np.searchsorted(np.cumsum(self._bytes[ids]), breaks - np.arange(len(breaks))) + 1
            stops = (last * self.type.itemsize).tolist()
            data = ids.tobytes()
            found += [data[a:b] for a, b in zip([0, *stops], stops)]
        return found


_WORKER: dict[str, WordIds] = {}


def worker_words(spec: Broadcast) -> WordIds:
    """The broadcast vocabulary, built once in each worker process."""
    name, text = spec.value
    if name not in _WORKER:
        _WORKER.clear()
        _WORKER[name] = WordIds(text)
    return _WORKER[name]


def _blobs(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The ids of each document as bytes."""
    edges = np.concatenate(([0], np.cumsum(sizes))) * ids.itemsize
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(ids)])
    return whole.cast(pa.binary())


# --- tables ---------------------------------------------------------------------

_MANIFEST = "part long, file long, path string, documents long, tokens long"


def write(docs: DataFrame, path: str, end_id: int, folder: str | None = None, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes the ids of all whole texts of ``docs`` (doc_id, text) as token files; returns their manifest.

    ``path`` is a file of the tokenizers library whose vocabulary drops white space and marks
    the ends of words. Each document's ids end with ``end_id``. The files lie in ``folder``, by
    default a new one in the shared folder. A manifest row: part and file (the files' order),
    path, documents and tokens. Documents ascend by doc_id, an integer, through all files; those
    without one come first. Documents of the same doc_id keep the order of the table, in
    as many parts as they need. A null or empty text is the closing id alone; repeated rows are
    documents of their own; a very long text is whole, in one file. An empty table gives no
    files; other columns are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(path, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast((path, file.read()))  # of the vocabulary's fixed size
    folder = (folder or shared_folder(spark)).rstrip("/")

    def save(batches):
        words = worker_words(spec)
        if end_id > np.iinfo(words.type).max:
            raise ValueError(f"the closing id {end_id} is too large for the vocabulary's ids")
        part, number = TaskContext.get().partitionId(), 0
        names, sizes, ids, size = [], [], [], 0
        for batch in batches:
            for low, high in pieces(batch.column("text"), min(ENCODED, file_tokens)):
                found, each = words.encode(batch.column("text").slice(low, high - low))
                names += batch.column("doc_id").slice(low, high - low).to_pylist()
                sizes.append(each + 1)
                ids.append(np.insert(found, np.cumsum(each), end_id).astype(words.type).tobytes())
                size += len(ids[-1]) // words.type.itemsize
                if size >= file_tokens:
                    yield _saved(folder, part, number, names, np.concatenate(sizes), ids, words.type.itemsize)
                    number += 1
                    names, sizes, ids, size = [], [], [], 0
        if names:
            yield _saved(folder, part, number, names, np.concatenate(sizes), ids, words.type.itemsize)

    # The place in the table tells equal doc_ids apart, so that any number of them is dealt to several tasks.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("place"))
    rows = rows.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
    return written(rows.select("doc_id", "text").mapInArrow(save, _MANIFEST))


def _saved(folder: str, part: int, number: int, names: list, sizes: np.ndarray, ids: list[bytes], width: int) -> pa.RecordBatch:
    """Writes a file of its own name; the row that names it in the manifest."""
    system, root = place_of(folder)
    system.create_dir(root, recursive=True)
    name = f"part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.tokens"
    with system.open_output_stream(f"{root}/{name}") as target:
        for some in file_bytes(names, sizes, ids, width):
            target.write(some)
    row = {"part": part, "file": number, "path": f"{folder}/{name}", "documents": len(names), "tokens": int(sizes.sum())}
    return pa.RecordBatch.from_pylist([row])


#: Parts whose files are numbered together.
_GROUP = 1024


def placed(manifest: DataFrame) -> DataFrame:
    """The files of a manifest, with the number of all ids in files before each, as ``base``.

    Files are summed in groups of parts; of each group one number reaches the driver.
    """
    group = F.floor(F.col("part") / _GROUP)
    sums = manifest.groupBy(group.alias("group")).agg(F.sum("tokens").alias("tokens")).orderBy("group").collect()
    ahead, before = {}, 0
    for row in sums:
        ahead[row.group] = before
        before += row.tokens
    spark = manifest.sparkSession
    groups = spark.createDataFrame(list(ahead.items()), "group long, ahead long")
    earlier = Window.partitionBy("group").orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("group", group).withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    return files.join(F.broadcast(groups), "group").withColumn("base", F.col("base") + F.col("ahead")).drop("group", "ahead")


def read(manifest: DataFrame) -> DataFrame:
    """The documents of a manifest's files: doc_id, start (ids of all documents before it), n_tokens and
    ids (little-endian unsigned 32-bit numbers). A manifest without files gives no rows."""
    spark = manifest.sparkSession
    ship(spark)

    def run(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                file = opened(path)
                low = 0
                while low < file.documents:
                    bounds = file.bounds(low, low + READ_DOCUMENTS)
                    count = max(1, int(np.searchsorted(bounds, bounds[0] + READ_TOKENS, side="right")) - 1)
                    bounds = bounds[: count + 1]
                    sizes = np.diff(bounds)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.doc_ids(low, low + len(sizes)), pa.int64()),
                            pa.array(base + bounds[:-1]),
                            pa.array(sizes),
                            _blobs(file.ids(int(bounds[0]), int(bounds[-1])), sizes),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    low += len(sizes)

    files = placed(manifest).select("path", "base")
    return files.repartition(max(1, manifest.count())).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def document(manifest: DataFrame, doc_id: int) -> list[int] | None:
    """The ids of one document, selected from the files that may hold it; None if there is none."""

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                found = opened(path).document(doc_id)
                if found is not None:
                    yield pa.RecordBatch.from_pydict({"path": [path], "ids": pa.array([found.tobytes()], pa.binary())})

    ship(manifest.sparkSession)
    found = manifest.select("path").mapInArrow(run, "path string, ids binary").orderBy("path").first()
    return None if found is None else np.frombuffer(found.ids, "<u4").tolist()
