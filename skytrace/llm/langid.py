"""Language identification by compression.

For every language a raw-content zstandard dictionary is made of passages of labelled documents.
A text is reduced to lower-case letters and single spaces, cut into blocks that are short beside
the dictionaries, and every block is compressed with each dictionary. The language whose
dictionary gives the fewest bytes over the whole text wins. A text is rejected when the winner saves
hardly any of the bytes that the runner-up needs.

A few words take so few bytes that languages tie by rounding. Below ``SHORT`` bytes the text is also
compressed behind each of up to ``SLICES`` slices of a dictionary, and what it adds there on average
counts as much as its own size: a measure in parts of a byte.

The dictionaries are fitted on a bounded sample: ``per_language`` documents of each language, the
ones with the smallest hash in each of as many slots, ``passage`` characters of each from a place
that the hash selects. Everything else reads whole texts.

The dictionaries go to every task, so there may be ``MAX_LANGUAGES`` languages; more are an error.

Nulls and edges: a null text or one without a letter is ``und`` with score 0 and rejected. Rows
without language teach nothing. Ties go to the language with more labelled rows, then by name.
Repeated rows are scored each; with nothing to learn from, every text is ``und``. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.llm import text as T

PER_LANGUAGE = 512
PASSAGE = 1500
MAX_LANGUAGES = 128
LEVEL = 3
CHUNK = 4096
SHORT = 200
SLICES = 32
SLICE = 4096
MIN_MARGIN = 0.005
#: Bits of a compressed size overstate the evidence, as blocks share words.
TEMPERATURE = 0.05
UNDETERMINED = "und"

RESULT = ("doc_id bigint, lang_pred string, score double, margin double, accepted boolean")


def letters(text: Column) -> Column:
    """Lower-case letters and single spaces; empty for null."""
    plain = F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"\P{L}+", " ")
    return F.trim(plain)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE,
        passage: int = PASSAGE) -> list[tuple[str, bytes]]:
    """Languages, most frequent first, with their dictionaries."""
    known = docs.where(F.col("lang").isNotNull()).select(
        F.col("lang").cast("string"), F.xxhash64("doc_id").alias("key"), "text")
    slot = F.pmod(F.col("key"), F.lit(per_language))
    slots = known.groupBy("lang", slot.alias("slot")).agg(
        F.min("key").alias("key"), F.count(F.lit(1)).alias("rows"))
    totals = slots.groupBy("lang").agg(F.sum("rows").alias("rows")).limit(MAX_LANGUAGES + 1)
    totals = {r.lang: r.rows for r in totals.collect()}
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not totals:
        return []
    plain = letters(F.col("text"))
    room = F.greatest(F.length("plain") - F.lit(passage), F.lit(0)) + 1
    taken = F.substring(F.col("plain"), (F.pmod(F.col("key"), room) + 1).cast("int"),
                        F.lit(passage))
    # At most MAX_LANGUAGES x per_language rows.
    sample = (known.join(F.broadcast(slots.select("lang", "key")), ["lang", "key"])
              .withColumn("plain", plain).select("lang", "key", taken.alias("taken"))
              .groupBy("lang", "key").agg(F.min("taken").alias("taken")).collect())
    passages: dict[str, list[tuple[int, str]]] = {}
    for row in sample:
        if row.taken:
            passages.setdefault(row.lang, []).append((row.key, row.taken))
    ranked = sorted(passages, key=lambda name: (-totals[name], name))
    return [(name, " ".join(t for _, t in sorted(passages[name])).encode()) for name in ranked]


@lru_cache(maxsize=2)
def _compressors(model: tuple[tuple[str, bytes], ...]) -> list:
    """One compressor for each language, kept for all tasks of a worker."""
    made = []
    for _, content in model:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(
            level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False,
            write_dict_id=False))
    return made


def sizes(text: bytes, model: tuple[tuple[str, bytes], ...]) -> np.ndarray:
    """Compressed bytes of the whole text with each language's dictionary."""
    chunks = [text[i:i + CHUNK] for i in range(0, len(text), CHUNK)]
    return np.array([sum(len(c.compress(chunk)) for chunk in chunks)
                     for c in _compressors(model)], np.int64)


@lru_cache(maxsize=2)
def _contexts(model: tuple[tuple[str, bytes], ...]) -> list[list[tuple[bytes, int]]]:
    """Slices of each language's dictionary with their compressed sizes.

    Equally many of each language; none if a dictionary is shorter than one slice.
    """
    count = min(SLICES, min(len(content) for _, content in model) // SLICE)
    made = []
    for _, content in model:
        begins = [len(content) * i // count for i in range(count)]
        slices = [content[b:b + SLICE] + b" " for b in begins]
        made.append([(c, len(_plain().compress(c))) for c in slices])
    return made


@lru_cache(maxsize=1)
def _plain() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)


def measured(text: bytes, model: tuple[tuple[str, bytes], ...]) -> np.ndarray:
    """Sizes in bytes; of a short text in parts of a byte."""
    found = sizes(text, model).astype(float)
    if len(text) >= SHORT or not _contexts(model)[0]:
        return found
    added = [np.mean([len(_plain().compress(c + text)) - n for c, n in slices])
             for slices in _contexts(model)]
    return (found + added) / 2


def decide(text: bytes, model: tuple[tuple[str, bytes], ...],
           min_margin: float) -> tuple[str, float, float, bool]:
    """Language, score, share of bytes saved against the runner-up, whether that is enough."""
    if not text or not model:
        return UNDETERMINED, 0.0, 0.0, False
    found = measured(text, model)
    best = int(found.argmin())
    rest = np.delete(found, best)
    margin = 1.0 - float(found[best]) / float(rest.min()) if len(rest) else 1.0
    weights = np.exp2(-8 * TEMPERATURE * (found - found[best]))
    return model[best][0], float(1 / weights.sum()), margin, margin >= min_margin


def _predicted(batches: Iterable[pa.RecordBatch], model: tuple[tuple[str, bytes], ...],
               min_margin: float) -> Iterator[pa.RecordBatch]:
    for batch in T.blocks(batches, "plain"):
        texts = T.column(batch, "plain").cast(pa.binary()).to_pylist()
        found = [decide(t or b"", model, min_margin) for t in texts]
        columns = list(zip(*found))
        yield pa.RecordBatch.from_arrays(
            [T.column(batch, "doc_id"), pa.array(columns[0], pa.string()),
             pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.float64()),
             pa.array(columns[3], pa.bool_())],
            ["doc_id", "lang_pred", "score", "margin", "accepted"])


def predict(docs: DataFrame, model: list[tuple[str, bytes]],
            min_margin: float = MIN_MARGIN) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``margin`` and ``accepted`` of every row."""
    return docs.select(F.col("doc_id").cast("bigint"),
                       letters(F.col("text")).alias("plain")).mapInArrow(
        partial(_predicted, model=tuple(model), min_margin=min_margin), RESULT)


def held_out(doc_id: Column) -> Column:
    """Rows that are not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def evaluated(docs: DataFrame, min_margin: float = MIN_MARGIN) -> DataFrame:
    """Predictions for all rows by dictionaries made of those that are not held out."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, model, min_margin).withColumn("held_out", held_out(F.col("doc_id")))


def keep_identified(docs: DataFrame, min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs`` whose language is identified with a sufficient margin."""
    model = fit(docs)
    # The last column is taken by its place.
    plain = letters(F.col("text")).alias(T.fresh(docs.columns, "plain"))
    return docs.select("*", plain).mapInArrow(
        partial(_kept, model=tuple(model), min_margin=min_margin), docs.schema)


def _kept(batches: Iterable[pa.RecordBatch], model: tuple[tuple[str, bytes], ...],
          min_margin: float) -> Iterator[pa.RecordBatch]:
    for batch in T.blocks(batches, -1):
        texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
        good = pa.array([decide(t or b"", model, min_margin)[3] for t in texts], pa.bool_())
        yield batch.select(range(batch.num_columns - 1)).filter(good)
