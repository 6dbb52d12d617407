"""Quality rules: counts of whole texts, and compression bands.

The compression ratio is the size after zstandard over the size before. Text that
repeats itself compresses far better than prose of its length, and text without
language hardly at all; short text always compresses badly, so the limits go by length.
Fixed chunks are measured as well, because a long document can hide a bad stretch.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.cluster import carried, extended, restored, ship
from coldshelf.llm.textops import Words, flat, per_text, pieces, repeat_words

SYMBOLS = b"#*$%&|<>"
WIDTH = 8
CHUNK = 4096
LEVEL = 3
_WORD = re.compile(r"[^\x20\x09-\x0D]")


@dataclass(frozen=True)
class Band:
    """Least and greatest ratio of texts with at least ``size`` bytes."""

    size: int
    least: float
    most: float


#: Limits of whole texts, by length in bytes. Below 64 bytes the format's own frame decides.
BANDS = (
    Band(0, 0.0, 100.0),
    Band(64, 0.50, 1.6),
    Band(128, 0.42, 1.2),
    Band(256, 0.38, 0.95),
    Band(512, 0.36, 0.90),
    Band(1024, 0.34, 0.85),
    Band(4096, 0.32, 0.80),
    Band(16384, 0.28, 0.80),
)
#: Limits of a chunk; a last chunk of under half the size counts with the one before it.
CHUNK_BAND = Band(CHUNK // 2, 0.30, 0.82)


def measured(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), *, chunk: int = CHUNK, level: int = LEVEL) -> DataFrame:
    """Counts and ratios of every whole text of ``docs`` (doc_id, text).

    Columns doc_id, n_bytes, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    ratio, least_chunk and most_chunk. A null or empty text has counts and sizes of 0 and
    null ratios. Rows are measured one by one, repeated ones too; an empty table gives no
    rows; of the other columns those of ``keep`` are kept.
    """
    ship(docs.sparkSession)
    rows = docs.select(*dict.fromkeys((*keep, "text")))
    schema = extended(
        rows.select(*keep),
        "n_bytes long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "ratio double, least_chunk double, most_chunk double",
    )

    def run(batches):
        import zstandard

        compressor = zstandard.ZstdCompressor(level=level)
        symbol = np.zeros(256, bool)
        symbol[list(SYMBOLS)] = True
        for batch in batches:
            text = batch.column("text")
            for low, high in pieces(text):
                part = text.slice(low, high - low)
                data, bounds = flat(part)
                words = Words(data, bounds, fold=False)
                sizes = np.diff(bounds)
                ratios = [_ratios(compressor, data[a:b], chunk) for a, b in zip(bounds, bounds[1:])]
                counts = [
                    sizes,
                    words.counts(),
                    per_text(words.inside & ((data & 0xC0) != 0x80), bounds),
                    per_text(symbol[data], bounds),
                    np.array([_dup_lines(t or "") for t in part.to_pylist()], np.int64),
                    repeat_words(words, WIDTH),
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(low, high - low) for c in keep),
                        *(pa.array(c.astype(np.int64)) for c in counts),
                        *(pa.array(c, pa.float64()) for c in zip(*ratios)),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)


def _ratios(compressor, data: np.ndarray, chunk: int) -> tuple[float | None, float | None, float | None]:
    if not len(data):
        return None, None, None
    whole = len(compressor.compress(data)) / len(data)
    cuts = [*range(0, max(1, len(data) - chunk // 2 + 1), chunk), len(data)]
    if len(cuts) == 2:
        return whole, whole, whole
    each = [len(compressor.compress(data[a:b])) / (b - a) for a, b in zip(cuts, cuts[1:])]
    return whole, min(each), max(each)


def _dup_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    return len(lines) - len(set(lines))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def in_bands(bands: tuple[Band, ...] = BANDS, chunks: Band = CHUNK_BAND) -> Column:
    """Whether a measured text lies in the band of its length, and its chunks in theirs."""
    verdict = F.lit(True)
    for band in sorted(bands, key=lambda b: b.size):
        verdict = F.when(F.col("n_bytes") >= band.size, F.col("ratio").between(band.least, band.most)).otherwise(verdict)
    whole_chunks = (F.col("least_chunk") >= chunks.least) & (F.col("most_chunk") <= chunks.most)
    several = F.col("n_bytes") >= CHUNK + chunks.size
    return F.coalesce(verdict & (~several | whole_chunks), F.lit(True))


def judged(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``measured`` with base_failed (the plain rules), in_bands and kept (neither objects)."""
    found = measured(docs, keep).withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    return found.withColumn("in_bands", in_bands()).withColumn("kept", ~F.col("base_failed") & F.col("in_bands"))


def passed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the rules keep.

    Null and empty texts fail, as all texts of few words; very long ones are measured whole; each
    row is judged by its own text, repeated ones too; an empty table gives no rows; clashing
    column names are carried through.
    """
    return restored(judged(carried(docs), ("doc", "text")).filter("kept"), docs)
