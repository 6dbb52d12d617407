"""Near duplicates by b-bit MinHash.

The shingle sets of documents are hashed to minima. Minima in bands give candidate pairs;
of each minimum only the low bits are kept, packed into bit planes, and the number of equal
places estimates a candidate's similarity after correction for places equal by chance.
What the estimate leaves is confirmed on the full sets.

Documents with equal sets are one class from the start. In a bucket of a band, classes are
compared with the bucket's centre first, the class with most company over all bands; what a
confirmed link joins needs no more comparing, so a large group of copies costs a row per
member. Where neighbours of one centre remain in different components, their sketches are compared
as well, block by block; sets go only to those blocks where a member may have a link, and only
links are returned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.cluster import extended, few, ship, written
from coldshelf.llm.components import components
from coldshelf.llm.textops import Words, flat, mix, pieces, prefix_sums, spans, windows

#: Pairs of ids of up to this many bytes are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
#: A centre with more members than this meets them in several tasks.
CENTRE_ROWS = 512
#: Neighbours of a centre that a task takes from each of two blocks, about.
BLOCK_ROWS = 256


@dataclass(frozen=True)
class Settings:
    """Percent of similarity that links, words of a shingle, and the sketch.

    With 32 bands of 5 rows a pair of similarity 0.85 is missed with a chance of 7e-9, of 0.8
    with 3e-6. The estimate may fall short by ``slack``, over four standard errors.
    """

    percent: int = 85
    width: int = 5
    bands: int = 32
    rows: int = 5
    slack: float = 0.15

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def planes(self) -> int:
        """64-bit words of one bit plane."""
        return -(-self.hashes // 64)


BITS = 2


def _shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes and the bounds of each text's; a text of fewer words is one shingle."""
    keys, _, begin = windows(words.hash, words.first, width)
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        size = counts[short]
        place = spans(np.zeros(len(short), np.int64), size)
        factor = mix((place + 1).astype(np.uint64))
        sums = np.add.reduceat(words.hash[spans(words.first[short], size)] * factor, np.cumsum(size) - size)
        whole = mix(sums + size.astype(np.uint64))
        keys = np.insert(keys, begin[short], whole)
        added = np.zeros(len(counts) + 1, np.int64)
        added[short + 1] = 1
        begin = begin + np.cumsum(added)
    return keys, begin


def _sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and their bounds."""
    keys, begin = _shingles(words, width)
    each = [np.unique(keys[a:b]) for a, b in zip(begin, begin[1:])]
    return (np.concatenate(each) if each else keys), prefix_sums(np.array([len(e) for e in each], np.int64))


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of non-empty ranges."""
    return np.add.reduceat(values, begin[:-1])


def _signatures(sets: np.ndarray, begin: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and packed bit planes of non-empty sets, a row for each set."""
    rng = np.random.default_rng(20)
    factors = rng.integers(0, 1 << 32, settings.hashes, np.uint32) | np.uint32(1)
    shifts = rng.integers(0, 1 << 32, settings.hashes, np.uint32)
    points = (sets >> np.uint64(32)).astype(np.uint32)
    n = len(begin) - 1
    minima = np.empty((n, settings.hashes), np.uint32)
    for i in range(settings.hashes):
        minima[:, i] = np.minimum.reduceat(points * factors[i] + shifts[i], begin[:-1])
    banded = minima.reshape(n, settings.bands, settings.rows).astype(np.uint64)
    keys = np.tile(np.arange(settings.bands, dtype=np.uint64), (n, 1))
    for row in range(settings.rows):
        keys = mix(keys * np.uint64(31) + banded[:, :, row])
    low = np.zeros((n, BITS, settings.planes * 64), np.uint8)
    for bit in range(BITS):
        low[:, bit, : settings.hashes] = (minima >> np.uint32(bit)) & np.uint32(1)
    return keys.view(np.int64), np.packbits(low, axis=2).view(np.int64).reshape(n, BITS * settings.planes)


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """Columns doc_id, n_shingles, set_a, set_b (128 bits that name the set), bands and sketch.

    A text without words has an empty set, and nulls in the columns after n_shingles.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    schema = extended(
        rows.drop("text"), "n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>"
    )

    def run(batches):
        for batch in batches:
            for low, high in pieces(batch.column("text")):
                words = Words(*flat(batch.column("text").slice(low, high - low)))
                sets, begin = _sets(words, settings.width)
                size = np.diff(begin)
                full = np.flatnonzero(size)
                if len(full):
                    edges = np.append(begin[:-1][full], begin[-1])
                    names = [_sums(mix(sets + np.uint64(k)), edges).view(np.int64) for k in (1, 2)]
                    keys, sketch = _signatures(sets, edges, settings)
                    found = [pa.array(names[0]), pa.array(names[1]), _lists(keys), _lists(sketch)]
                else:
                    found = [pa.nulls(0, pa.int64())] * 2 + [pa.nulls(0, pa.list_(pa.int64()))] * 2
                place = np.full(len(size), -1)
                place[full] = np.arange(len(full))
                place = pa.array(place, mask=place < 0)
                columns = [batch.column("doc_id").slice(low, high - low), pa.array(size), *(f.take(place) for f in found)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def _lists(matrix: np.ndarray) -> pa.Array:
    bounds = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.ascontiguousarray(matrix).ravel()))


def shingle_sets(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` with column text replaced by set, the array of its distinct shingle hashes."""
    ship(rows.sparkSession)
    keep = [c for c in rows.columns if c != "text"]
    schema = extended(rows.select(keep), "set array<long>")

    def run(batches):
        for batch in batches:
            for low, high in pieces(batch.column("text")):
                part = batch.slice(low, high - low)
                sets, begin = _sets(Words(*flat(part.column("text"))), width)
                lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists], names=schema.names)

    return rows.mapInArrow(run, schema)


def estimate(a: str, b: str, settings: Settings) -> Column:
    """Similarity by the equal places of two sketches, without those equal by chance."""
    unequal = None
    for word in range(settings.planes):
        differ = None
        for bit in range(BITS):
            at = bit * settings.planes + word
            bits = F.col(a)[at].bitwiseXOR(F.col(b)[at])
            differ = bits if differ is None else differ.bitwiseOR(bits)
        count = F.bit_count(differ)
        unequal = count if unequal is None else unequal + count
    chance = 2.0**-BITS
    return (1 - unequal / F.lit(float(settings.hashes)) - chance) / (1 - chance)


def _small(df: DataFrame, bytes_a_row: int) -> DataFrame:
    """``df`` marked for a broadcast where its measured size allows it."""
    return F.broadcast(df) if df.count() * bytes_a_row <= BROADCAST_BYTES else df


def confirmed(docs: DataFrame, pairs: DataFrame, most: int, settings: Settings) -> DataFrame:
    """The pairs (a, b), ``most`` at most, of document ids whose full sets are similar enough. ``a`` may have many partners."""
    texts = docs.select("doc_id", "text")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / CENTRE_ROWS).cast("int").alias("parts"))
    pairs = written(few(pairs.join(parts, "a").withColumn("part", F.pmod(F.hash("b"), "parts")), most, 24))
    sides = written(few(pairs.select("a", "part").distinct(), pairs.count(), 16))
    members = shingle_sets(texts.join(_small(pairs, 48), F.col("doc_id") == F.col("b")).select("a", "part", "b", "text"), settings.width)
    centres = shingle_sets(texts.join(_small(sides, 32), F.col("doc_id") == F.col("a")).select("a", "part", "text"), settings.width)
    both = members.withColumnRenamed("set", "set_b").join(centres.withColumnRenamed("set", "set_a"), ["a", "part"])
    shared = F.size(F.array_intersect("set_a", "set_b"))
    sized = both.select("a", "b", shared.alias("shared"), (F.size("set_a") + F.size("set_b") - shared).alias("either"))
    return sized.filter(F.col("shared") * 100 >= F.col("either") * settings.percent).select("a", "b").distinct()


def _buckets(classes: DataFrame, settings: Settings) -> DataFrame:
    """Columns key, id, company: the buckets of two classes or more, each set of members once.

    ``company`` counts the classes met in all bands, so it is largest in the middle of a group.
    """
    rows = classes.select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"))
    marks = [F.sum(F.hash("id", F.lit(k)).cast("long")).alias(f"mark{k}") for k in (1, 2)]
    sizes = rows.groupBy("key").agg(F.count("*").alias("members"), *marks).filter("members > 1")
    most = classes.count() * settings.bands
    sizes = written(few(sizes, most // 2, 32))
    rows = written(few(rows.join(sizes, "key"), most, 40))
    most = rows.count()
    company = rows.groupBy("id").agg(F.sum("members").alias("company"))
    once = rows.groupBy("members", "mark1", "mark2").agg(F.min("key").alias("key")).select("key")
    return written(few(rows.join(once, "key", "left_semi").select("key", "id").join(company, "id"), most, 24))


def _neighbours(classes: DataFrame, settings: Settings) -> DataFrame:
    """Columns a and b: each bucket's centre with its other members, every pair once.

    Two classes that share a bucket are both neighbours of its centre, or one is the centre.
    """
    buckets = _buckets(classes, settings)
    most = buckets.count()
    centres = buckets.groupBy("key").agg(F.max_by("id", F.struct("company", "id")).alias("a"))
    pairs = buckets.join(written(few(centres, most, 16)), "key").select("a", F.col("id").alias("b"))
    return written(few(pairs.filter("a <> b").distinct(), most, 16))


def _likely(pairs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """The pairs whose sketches leave room for the similarity that links."""
    sketches = classes.select("doc_id", "sketch")
    first = sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sketch_a"))
    second = sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sketch_b"))
    enough = estimate("sketch_a", "sketch_b", settings) >= settings.percent / 100 - settings.slack
    return pairs.join(first, "a").join(second, "b").filter(enough).select("a", "b")


def _among_neighbours(docs: DataFrame, classes: DataFrame, neighbours: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """Links between neighbours of one centre that are in different components, as edges (u, v).

    The neighbours are dealt into blocks, and each task counts the equal bits of two blocks'
    sketches. Members that may be linked with one of another component there meet again with
    their full sets, so no pair leaves a task but a link. Centres whose neighbours are one component
    are done.
    """
    members = neighbours.join(labels, neighbours.b == labels.node, "left").select(
        "a", "b", F.coalesce("component", "b").alias("component")
    )
    open_centres = (
        members.groupBy("a")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
        .filter("low < high")
        .select("a", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    )
    members = members.join(written(few(open_centres, neighbours.count(), 12)), "a")
    members = members.join(classes.select(F.col("doc_id").alias("b"), "sketch"), "b")
    own, other = F.pmod(F.hash("b"), "blocks"), F.col("other")
    dealt = members.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "a", F.least(own, other).alias("low"), F.greatest(own, other).alias("high"), "b", "component", "sketch"
    )
    percent, key = settings.percent, ["a", "low", "high"]
    kind = dict(docs.dtypes)["doc_id"]

    def meet(group):
        likely = _likely_members(np.stack(group["sketch"].to_numpy()), group["component"].to_numpy(), settings)
        return group.loc[likely, [*key, "b", "component"]]

    # By number: these rows are few bytes and much work, and by their bytes few tasks would get them all.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = dealt.repartition(tasks, *key).groupBy(*key).applyInPandas(meet, f"a {kind}, low int, high int, b {kind}, component {kind}")
    near = written(near)
    texts = docs.select("doc_id", "text").join(_small(near.select("b").distinct(), 16), F.col("doc_id") == F.col("b"))
    sets = shingle_sets(texts.select("b", "text"), settings.width)

    def compare(group):
        found = _alike(group["set"].tolist(), group["component"].to_numpy(), percent)
        ids = group["b"].to_numpy()
        return pd.DataFrame({"u": ids[found[0]], "v": ids[found[1]]})

    return near.join(sets, "b").groupBy(*key).applyInPandas(compare, f"u {kind}, v {kind}")


def _likely_members(sketches: np.ndarray, component: np.ndarray, settings: Settings) -> np.ndarray:
    """Places of those whose sketch leaves room for a link with one of another component."""
    # Without a sign: of a negative number the bits of its absolute value would be counted.
    planes = sketches.astype(np.int64).view(np.uint64).reshape(len(sketches), BITS, settings.planes)
    unequal = np.zeros((len(planes), len(planes)), np.int64)
    for word in range(settings.planes):
        differ = np.zeros(unequal.shape, np.uint64)
        for bit in range(BITS):
            own = planes[:, bit, word]
            differ |= own[:, None] ^ own[None, :]
        unequal += np.bitwise_count(differ)
    chance = 2.0**-BITS
    alike = (1 - unequal / settings.hashes - chance) / (1 - chance)
    likely = (alike >= settings.percent / 100 - settings.slack) & (component[:, None] != component[None, :])
    return np.flatnonzero(likely.any(axis=1))


def _alike(sets: list[np.ndarray], component: np.ndarray, percent: int, columns: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of sets in different components that are similar enough."""
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    _, which, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1  # the others are in no intersection
    number = np.cumsum(shared) - 1
    keep = shared[which]
    owner, which = owner[keep], number[which][keep]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(shared.sum()), columns):
        a, b = np.searchsorted(which, (low, low + columns))
        part = np.zeros((len(sets), columns), np.float32)
        part[owner[a:b], which[a:b] - low] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    alike = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    return np.nonzero(np.triu(alike & (component[:, None] != component[None, :]), 1))


def links(docs: DataFrame, classes: DataFrame, edges: DataFrame, settings: Settings) -> DataFrame:
    """Columns node and component for the classes (doc_id, bands, sketch) that similarity or ``edges`` (u, v) link."""
    neighbours = _neighbours(classes, settings)
    most = neighbours.count()
    close = confirmed(docs, _likely(neighbours, classes, settings), most, settings)
    most += edges.count()
    edges = written(few(edges.unionByName(close.select(F.col("a").alias("u"), F.col("b").alias("v"))), most, 16))
    labels = components(edges)
    more = written(_among_neighbours(docs, classes, neighbours, labels, settings))
    return labels if more.isEmpty() else components(edges.unionByName(more))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with the component of its document.

    Columns doc_id, n_shingles, component_id (the smallest doc_id that links reach) and kept
    (whether it is that document). Two documents are linked if their sets of distinct shingles
    are alike by the settings. A text of fewer words than a shingle is one shingle. A text
    without words, or null, is linked with nothing. Rows with one doc_id are one document;
    a row without doc_id is linked with nothing, has no component and is kept. Very long texts
    count with all their shingles; of equally good representatives the smallest doc_id is taken. An
    empty table gives no rows; other columns are left out.
    """
    found = written(signatures(docs, settings))
    usable = found.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    most = found.count()
    names = written(few(usable.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep")), most, 24))
    several = usable.groupBy("doc_id").agg(F.min("set_a").alias("low"), F.max("set_a").alias("high")).filter("low < high")
    same = (
        usable.join(several.select("doc_id"), "doc_id", "left_semi")
        .join(names, ["set_a", "set_b"])
        .select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    )
    classes = (
        usable.alias("s")
        .join(names.alias("n"), F.expr("s.doc_id = n.rep AND s.set_a = n.set_a AND s.set_b = n.set_b"))
        .select("s.doc_id", "s.bands", "s.sketch")
    )
    classes = written(few(classes, most, 8 * (settings.bands + BITS * settings.planes + 1)))
    labels = links(docs, classes, written(same), settings)
    return _rows(found, names, labels)


def _rows(found: DataFrame, names: DataFrame, labels: DataFrame) -> DataFrame:
    own = F.col("doc_id").isNotNull()
    return (
        found.select("doc_id", "n_shingles", "set_a", "set_b")
        .join(names, ["set_a", "set_b"], "left")
        .join(labels, F.col("rep") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.when(own, F.coalesce("component", "rep", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def one_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay when each group of near duplicates keeps one document.

    Of rows with the same doc_id one stays as well; rows without doc_id all stay. Null and empty
    texts, which are linked with nothing, stay; very long texts are compared whole; an empty table
    gives no rows; clashing column names are carried through.
    """
    found = written(near_duplicates(docs, settings).select("doc_id", "kept").filter("doc_id IS NOT NULL"))
    gone = found.filter("NOT kept").select("doc_id").distinct()
    several = found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    gone, several = _small(written(gone), 16), written(several)
    rest = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if several.isEmpty():
        return rest
    twins = rest.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return rest.join(several, "doc_id", "left_anti").unionByName(twins).select(*docs.columns)
