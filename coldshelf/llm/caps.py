"""Near duplicates of embeddings by spherical caps.

Filters are caps around the words of a random product code: a rotated vector is cut into
blocks, every block has its own random code, and a filter's direction is one codeword of
each block. A vector goes into every filter whose direction it exceeds a threshold with,
found by list decoding: block after block is added to the scores, and a partial choice is
dropped as soon as the best rest cannot lift it over the threshold. Vectors that share a
filter and a label are candidates; sign bits rule out most of them, and exact cosines decide.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.cluster import extended, ship, written
from coldshelf.llm.components import components

COSINE = 0.93
#: Least number of rotations.
ROTATIONS = 8
BLOCKS = 2
#: Chance that a pair at just the threshold shares no filter in any rotation.
MISS = 1e-6
#: Filters that a vector is in, on average, in each rotation.
EACH = 4
#: Random pairs at the threshold, and rotations of them, that the chance is measured on.
TRIAL_PAIRS, TRIAL_ROTATIONS = 500, 4
#: Standard errors that the number of equal signs may fall short.
SIGN_SLACK = 4.5
SIGNS = 64
#: Vectors of fewer dimensions all share one filter for each label.
LEAST_DIMENSIONS = 8


@dataclass(frozen=True)
class Caps:
    """The filters of vectors of one size: codewords of a block, the score that a filter asks for, in
    units of a random unit vector's standard deviation, and the rotations."""

    words: int
    height: float
    rotations: int = ROTATIONS

    @staticmethod
    def sized(vectors: int, cosine: float, size: int) -> Caps:
        """Filters for so many vectors of this size with one label.

        Their number grows with the vectors, so that a filter's share of them does not, until a
        cap is as narrow as the neighbourhood that is searched. The height follows from the
        exact distribution of a unit vector's coordinate. How often a pair at the threshold
        shares no filter of a rotation is measured, and as many rotations are taken as bring
        the chance of a miss in all of them below the allowed one.
        """
        at, above = _coordinate(size)
        near = float(np.interp(cosine, at, above))
        words = max(24, math.ceil(math.sqrt(min(max(1, vectors) / 4, EACH / max(near, 1e-300)))))
        height = float(np.interp(-EACH / words**BLOCKS, -above, at)) * math.sqrt(size)
        missed = _missed(Caps(words, height, TRIAL_ROTATIONS), cosine, size)
        return Caps(words, height, max(ROTATIONS, math.ceil(math.log(MISS) / math.log(missed))))


def _coordinate(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of a coordinate of a random unit vector, and the chance that it is larger."""
    at = np.linspace(-1, 1, 200_001)
    weight = (1 - at * at) ** ((size - 3) / 2)
    above = np.cumsum(weight[::-1])[::-1]
    return at, above / above[0]


def _missed(caps: Caps, cosine: float, size: int) -> float:
    """Chance that a pair at this cosine shares no filter of one rotation: what random pairs show,
    and two standard errors more."""
    rng = np.random.default_rng([9, size])
    x, y = rng.normal(size=(2, TRIAL_PAIRS, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    filters = caps.words**BLOCKS
    first, second = (
        row * (caps.rotations * filters) + number for row, number in (decode(u, caps) for u in (x, cosine * x + math.sqrt(1 - cosine * cosine) * y))
    )
    trials = TRIAL_PAIRS * caps.rotations
    missed = 1 - len(np.unique(np.intersect1d(first, second) // filters)) / trials
    return min(missed + 2 * math.sqrt(max(missed, 1 / trials) / trials), 1 - 1 / trials)


def _rotation(size: int, number: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([6, size, number]).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def _codes(size: int, number: int, words: int) -> list[np.ndarray]:
    """Codewords of each block, of length 1 over all blocks together."""
    rng = np.random.default_rng([7, size, number])
    edges = np.linspace(0, size, BLOCKS + 1).astype(int)
    out = []
    for width in np.diff(edges):
        code = rng.normal(size=(words, width))
        out.append(code / np.linalg.norm(code, axis=1, keepdims=True) * math.sqrt(width / size))
    return out


def decode(unit: np.ndarray, caps: Caps) -> tuple[np.ndarray, np.ndarray]:
    """Row and filter number of every cap that the unit vectors (rows) are in, one in each rotation at least."""
    size = unit.shape[1]
    rows, numbers = [], []
    step = max(8, min(512, (1 << 18) // caps.words))  # rows whose scores are held at a time
    edges = np.linspace(0, size, BLOCKS + 1).astype(int)
    for rotation in range(caps.rotations):
        turned = unit @ _rotation(size, rotation).T
        codes = _codes(size, rotation, caps.words)
        for low in range(0, len(unit), step):
            part = turned[low : low + step]
            scores = [part[:, a:b] @ code.T for a, b, code in zip(edges, edges[1:], codes)]
            best = np.cumsum([s.max(axis=1) for s in scores[::-1]], axis=0)[::-1]
            # A vector that no filter reaches that far goes into the nearest one.
            need = np.minimum(caps.height / math.sqrt(size), best[0] - 1e-9)
            row, number, sum_ = np.arange(len(part)), np.full(len(part), rotation), np.zeros(len(part))
            for block, score in enumerate(scores):
                rest = best[block + 1] if block + 1 < BLOCKS else np.zeros(len(part))
                grown = sum_[:, None] + score[row]
                which, word = np.nonzero(grown + rest[row][:, None] >= need[row][:, None])
                row, number, sum_ = row[which], number[which] * caps.words + word, grown[which, word]
            rows.append(low + row)
            numbers.append(number)
    return np.concatenate(rows), np.concatenate(numbers)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one size as the rows of a matrix."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(len(column), -1)


def filters(vectors: DataFrame, caps: dict[int, Caps]) -> DataFrame:
    """Columns id, label, size, filter and signs: a row for each cap that a vector is in, by its size's caps."""
    ship(vectors.sparkSession)
    rows = vectors.select("id", "label", "size", "embedding")
    schema = extended(rows.select("id", "label", "size"), "filter long, signs long")

    def run(batches):
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                for low in range(0, part.num_rows, 2048):
                    yield decoded(part.slice(low, 2048), int(size))

    def decoded(part, size):
        unit = _matrix(part.column("embedding"))
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        planes = np.random.default_rng([8, size]).normal(size=(size, SIGNS))
        signs = np.packbits(unit @ planes > 0, axis=1).view(np.int64).ravel()
        row, number = decode(unit, caps[size]) if size in caps else (np.arange(len(unit)), np.zeros(len(unit), int))
        known = [part.column(c).take(pa.array(row)) for c in ("id", "label", "size")]
        return pa.RecordBatch.from_arrays([*known, pa.array(number), pa.array(signs[row])], names=schema.names)

    return rows.mapInArrow(run, schema)


def usable() -> Column:
    """Whether a row's vector can be linked with others."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~bad & some, F.lit(False))


def similar(pairs: DataFrame, cosine: float) -> DataFrame:
    """The pairs (a, b, vector_a, vector_b) with at least this cosine, in double precision."""
    ship(pairs.sparkSession)
    schema = pairs.select("a", "b").schema

    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            sizes = np.asarray(batch.column("vector_a").value_lengths())
            for size in np.unique(sizes):
                chosen = np.flatnonzero(sizes == size)
                x, y = (_matrix(batch.column(c).take(pa.array(chosen))) for c in ("vector_a", "vector_b"))
                lengths = np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))
                keep[chosen] = (x * y).sum(axis=1) / lengths >= cosine
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.select("a", "b", "vector_a", "vector_b").mapInArrow(run, schema)


def candidates(vectors: DataFrame, caps: dict[int, Caps], cosine: float) -> DataFrame:
    """Pairs a < b of ids that share a label and a filter, and whose signs leave room for the cosine."""
    rows = written(filters(vectors, caps))
    chance = math.acos(cosine) / math.pi
    most = math.ceil(SIGNS * chance + SIGN_SLACK * math.sqrt(SIGNS * chance * (1 - chance)))
    x, y = rows.alias("x"), rows.alias("y")
    same = F.expr("x.label = y.label AND x.size = y.size AND x.filter = y.filter AND x.id < y.id")
    near = F.bit_count(F.col("x.signs").bitwiseXOR(F.col("y.signs"))) <= most
    return x.join(y, same & near).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Every row of ``embeddings`` (vec_id, embedding, label) with its links and component.

    Columns vec_id, n_links (other vectors with the same label, the same number of components
    and at least this cosine), component_id (the smallest vec_id that links reach) and kept
    (whether it is that vector). Vectors that are null, empty, zero, or hold a null or
    non-finite component, and those without a label, have no links. Equal vectors are linked;
    they are one class until the end. Repeated rows with one vec_id are one vector. A row
    without vec_id has no links and no component and is kept. A pair at the cosine itself is
    linked; of vectors that are equally central the smallest vec_id is taken. An empty table gives
    no rows; other columns are left out. There are no texts.
    """
    rows = embeddings.select("vec_id", "label", "embedding", usable().alias("usable"))
    rows = rows.withColumns({"name_a": F.xxhash64("embedding"), "name_b": F.xxhash64(F.lit(1), "embedding")})
    key = ["label", "name_a", "name_b"]
    good = rows.filter("usable")
    sizes = good.select(*key, "vec_id").distinct().groupBy(*key).agg(F.min("vec_id").alias("id"), F.count("*").alias("members"))
    sizes = written(sizes)
    vectors = written(
        good.join(sizes.withColumnRenamed("id", "vec_id"), [*key, "vec_id"], "left_semi")
        .dropDuplicates([*key, "vec_id"])
        .select(F.col("vec_id").alias("id"), "label", F.size("embedding").alias("size"), "embedding")
    )
    most = vectors.groupBy("label", "size").agg(F.count("*").alias("n")).groupBy("size").agg(F.max("n").alias("n"))
    # A row for each number of components; where no two vectors can meet, filters are of no use.
    layouts = {r.size: Caps.sized(r.n, cosine, r.size) for r in most.filter((F.col("size") >= LEAST_DIMENSIONS) & (F.col("n") > 1)).collect()}
    pairs = written(candidates(vectors, layouts, cosine))
    first = vectors.select(F.col("id").alias("a"), F.col("embedding").alias("vector_a"))
    second = vectors.select(F.col("id").alias("b"), F.col("embedding").alias("vector_b"))
    links = written(similar(pairs.join(first, "a").join(second, "b"), cosine))
    labels = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    members = sizes.select("id", "members")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    beside = (
        both.join(members.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("of")).agg(F.sum("members").alias("beside"))
    )
    classes = written(
        sizes.join(beside, sizes.id == beside.of, "left")
        .join(labels, sizes.id == labels.node, "left")
        .select(
            *key,
            (F.col("members") - 1 + F.coalesce("beside", F.lit(0))).alias("links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    found = rows.filter("usable").select("vec_id", *key).join(classes, key).select("vec_id", "links", "component")
    rest = rows.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("component"))
    return found.unionByName(rest).select(
        "vec_id",
        F.col("links").cast("long").alias("n_links"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"),
    )
