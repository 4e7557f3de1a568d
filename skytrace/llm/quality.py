"""Quality by co-training: a text classifier and a metadata classifier teach each other.

The text view has hashed three-byte sequences of the whole text and how much its words repeat. The
metadata view has source, language, declared length and the layout of the page: lines, and shares of
capitals, digits, signs and other bytes. Both are logistic models. In every round each model scores
all documents without a label and hands those it is surest of, in the proportion of the classes, to
the other model's training set. At the end each view's log odds are calibrated on labelled documents that
neither has trained on, and a last logistic model weighs the two against each other.

The models are fitted in one task, on bounded samples: the ``LABELLED`` labelled documents with the
smallest hashes, and at most ``TAUGHT_ROWS`` pseudo-labelled ones from each view and round. What is
sure is decided by quantiles over the distinct texts of all documents without a label. Every document
is scored, on its whole text.

Nulls and edges: null and empty texts have an empty text view; null source, language or length are
values of their own. Several labels of one document count by their mean; null labels are left out.
Without labels of both classes every document gets the share of good labels, or 1. Repeated rows
are scored each; other columns are kept by ``keep_good`` and ignored by ``scores``. A declared length
that is no number is a null one. Ties between documents are settled by hashes of their texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.llm import text as T
from skytrace.llm.linear import apply_logistic, fit_logistic, sigmoid
from skytrace.session import written

LABELLED = 4000
ROUNDS = 4
#: Share of the texts without a label that a view is sure of in a round, and how many it hands on.
TAUGHT = 0.05
TAUGHT_ROWS = 200
#: Share of the labelled sample that is only used to calibrate.
CALIBRATION = 0.3
MIN_SCORE = 0.3
SEQUENCES = 512
SOURCES, LANGUAGES = 32, 16
BLOCK_BYTES = 1 << 20

SCORES = ("doc_id bigint, text_score double, page_score double, score double, keep boolean")

_KINDS = np.zeros(256, np.int64)  # 0: small letters and spaces
_KINDS[65:91] = 1
_KINDS[48:58] = 2
_KINDS[[b for b in range(33, 127) if not chr(b).isalnum()]] = 3
_KINDS[128:] = 4
_KINDS[10] = 5


def text_view(texts: pa.Array) -> np.ndarray:
    """A row per text: square roots of the shares of hashed sequences, and repetition."""
    data, offsets = T.buffer_of(texts)
    n = len(offsets) - 1
    wide = data.astype(np.int64)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    inside = owner[2:] == owner[:-2]
    hashed = (wide[2:] * 0x9E3779B1 + wide[1:-1] * 0x85EBCA77 + wide[:-2] * 0xC2B2AE3D) >> 7
    at = (owner[2:] * SEQUENCES + hashed % SEQUENCES)[inside]
    counts = np.bincount(at, minlength=n * SEQUENCES).reshape(n, SEQUENCES)
    shares = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
    words, firsts = T.word_hashes(data, offsets)
    lengths = np.diff(firsts)
    of = np.repeat(np.arange(n), lengths)
    again = np.zeros(len(words), np.int64)
    again[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
    distinct = np.diff(np.searchsorted(np.unique(of << 40 | (words >> np.uint64(24)).astype(
        np.int64)), np.arange(n + 1) << 40))
    most = np.maximum(lengths, 1)
    # Few of many words are distinct even in good texts: compare with a power of their number.
    repeated = np.stack((T.per_text(again, firsts) / most, distinct / most ** 0.8), axis=1)
    return np.hstack((shares * 4, repeated))


def _buckets(values: pa.Array, size: int) -> np.ndarray:
    """One of ``size`` for each value; null is a value of its own."""
    data, offsets = T.buffer_of(values.cast(pa.string()))
    hashed = T.span_hashes(np.insert(data, offsets[:-1], 0), offsets[:-1] + np.arange(len(values)),
                           offsets[1:] + np.arange(1, len(values) + 1))
    filled = np.zeros((len(values), size + 1))
    known = pc.is_valid(values).to_numpy(zero_copy_only=False)
    at = np.where(known, (hashed % np.uint64(size)).astype(np.int64), size)
    filled[np.arange(len(values)), at] = 1
    return filled


def page_view(batch: pa.RecordBatch) -> np.ndarray:
    """A row per document: where it comes from and how its page is laid out."""
    data, offsets = T.buffer_of(T.column(batch, "text"))
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    kinds = np.bincount(owner * 6 + _KINDS[data], minlength=6 * n).reshape(n, 6)
    size = np.maximum(np.diff(offsets), 1)[:, None]
    declared = T.column(batch, "n_chars").cast(pa.float64())
    chars = np.nan_to_num(pc.fill_null(declared, 0.0).to_numpy(zero_copy_only=False))
    numbers = np.column_stack((
        kinds[:, 1:5] / size * 4, np.log1p(kinds[:, 5]), np.log1p(np.maximum(chars, 0)),
        np.log1p(size[:, 0] / (1 + kinds[:, 5])),
        pc.is_null(declared).to_numpy(zero_copy_only=False)))
    return np.hstack((numbers, _buckets(T.column(batch, "source"), SOURCES),
                      _buckets(T.column(batch, "lang"), LANGUAGES)))


class Model:
    """Two calibrated views and the weight of each in their combination."""

    def __init__(self, prior: float, text: np.ndarray | None = None,
                 page: np.ndarray | None = None, joint: np.ndarray | None = None):
        self.prior, self.text, self.page, self.joint = prior, text, page, joint

    def score(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of a good document by text, by page and by both."""
        if self.text is None:
            constant = np.full(batch.num_rows, self.prior)
            return constant, constant, constant
        by_text = apply_logistic(text_view(T.column(batch, "text")), self.text)
        by_page = apply_logistic(page_view(batch), self.page)
        both = np.column_stack((by_text, by_page))
        return sigmoid(by_text), sigmoid(by_page), sigmoid(apply_logistic(both, self.joint))


def _calibrated(weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights whose log odds are scaled and shifted to fit labels not trained on."""
    scale, shift = fit_logistic(apply_logistic(x, weights)[:, None], y, ridge=0.1)
    out = weights * max(scale, 0.0)
    out[-1] += shift
    return out


def combined(views: list[np.ndarray], weights: list[np.ndarray], y: np.ndarray) -> Model:
    """Calibrate each view on labels not trained on, then weigh the two against each other."""
    own = [_calibrated(w, x, y) for w, x in zip(weights, views)]
    odds = np.column_stack([apply_logistic(x, w) for w, x in zip(own, views)])
    joint = fit_logistic(odds, y, ridge=0.1)
    if joint[:2].min() < 0:  # a view that only misleads beside the other one is left out
        used = joint[:2] >= 0
        joint = np.zeros(3)
        joint[np.append(used, True)] = fit_logistic(odds[:, used], y, ridge=0.1)
    return Model(float(y.mean()), *own, joint)


#: Features of one document; ``pupil`` is the view that learns from it, null for both.
SAMPLE = ("key bigint, label int, pupil int, text_view array<float>, page_view array<float>")


def _sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.blocks(batches, size=BLOCK_BYTES):
        views = [text_view(T.column(batch, "text")), page_view(batch)]
        yield pa.RecordBatch.from_arrays(
            [T.column(batch, c) for c in ("key", "label", "pupil")] + [
                pa.array(list(v.astype(np.float32)), pa.list_(pa.float32())) for v in views],
            ["key", "label", "pupil", "text_view", "page_view"])


def fit_views(views: list[np.ndarray], label: np.ndarray, pupil: np.ndarray,
              last: bool) -> tuple[float, list[np.ndarray] | Model | None]:
    """Both views from labelled rows (``pupil`` -1) and from what each was taught (0 or 1).

    The share of good labels, and weights; with ``last`` the calibrated model. None if the labels
    are all alike. Rows must be in order of a hash: a stride is a random part of them.
    """
    known = pupil < 0
    y = label[known].astype(float)
    if not len(y):
        return 1.0, None
    if y.min() == y.max():
        return float(y.mean()), None
    held = np.arange(len(y)) % 10 < 10 * CALIBRATION
    if len({*y[held]}) < 2 or len({*y[~held]}) < 2:
        held = np.zeros(len(y), bool)
    own = [np.concatenate((np.flatnonzero(known)[~held], np.flatnonzero(pupil == side)))
           for side in (0, 1)]
    weights = [fit_logistic(v[at], label[at].astype(float)) for v, at in zip(views, own)]
    if not last:
        return float(y.mean()), weights
    judged = np.flatnonzero(known)[held if held.any() else ~held]
    return float(y.mean()), combined([v[judged] for v in views], weights,
                                     label[judged].astype(float))


def _fitted(batches: Iterable[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Weights from all samples, which one task reads: their number is bounded."""
    batches = list(batches)
    if not batches:
        yield pa.RecordBatch.from_arrays([pa.array([1.0]), pa.array(
            [[]], pa.list_(pa.list_(pa.float64())))], ["share", "weights"])
        return
    table = pa.Table.from_batches(batches).sort_by([("key", "ascending"), ("pupil", "ascending")])
    label = table.column("label").to_numpy()
    pupil = table.column("pupil").fill_null(-1).to_numpy()
    views = [np.stack(T.lists(table.column(c))).astype(float) if len(table) else np.zeros((0, 1))
             for c in ("text_view", "page_view")]
    share, found = fit_views(views, label, pupil, last)
    made = ([] if found is None else [found.text, found.page, found.joint] if last else found)
    yield pa.RecordBatch.from_arrays(
        [pa.array([share]), pa.array([[w.tolist() for w in made]],
                                     pa.list_(pa.list_(pa.float64())))], ["share", "weights"])


def _odds(batches: Iterable[pa.RecordBatch],
          weights: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in T.blocks(batches, size=BLOCK_BYTES):
        views = text_view(T.column(batch, "text")), page_view(batch)
        yield pa.RecordBatch.from_arrays(
            [T.column(batch, "doc_id"), T.column(batch, "text_key"),
             *[pa.array(apply_logistic(v, w)) for v, w in zip(views, weights)]],
            ["doc_id", "text_key", "odds0", "odds1"])


def _inputs(docs: DataFrame) -> list[Column]:
    """Columns that the views read; an absent one is null, as is a length that is no number."""
    have = set(docs.columns)
    kinds = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string",
             "n_chars": "bigint"}
    return [(F.col(c).try_cast(t) if c in have else F.lit(None).cast(t)).alias(c)
            for c, t in kinds.items()]


def taught(free: DataFrame, share: float, rows: int = TAUGHT_ROWS,
           part: float = TAUGHT) -> DataFrame:
    """Pseudo-labels of a round: ``doc_id``, ``text_key``, ``label`` and the ``pupil`` view.

    ``free`` has a row per distinct text with the log odds of both views. A view labels the texts of
    its surest ``part``, good and bad in the proportion of the classes, if it is sure of them at all;
    of these the ``rows`` with the smallest hashes are handed to the other view.
    """
    good, bad = part * share, part * (1 - share)
    cuts = free.agg(*[F.percentile_approx(f"odds{v}", [bad, 1 - good]).alias(f"cuts{v}")
                      for v in (0, 1)]).first()
    chosen = []
    for teacher in (0, 1):
        odds, cut = F.col(f"odds{teacher}"), cuts[f"cuts{teacher}"] or [0.0, 0.0]
        for label, sure, size in ((1, (odds >= cut[1]) & (odds > 1), share),
                                  (0, (odds <= cut[0]) & (odds < -1), 1 - share)):
            chosen.append(free.where(sure).orderBy(F.xxhash64("text_key"), "doc_id").limit(
                max(1, round(rows * size))).select(
                "doc_id", "text_key", F.lit(label).alias("label"),
                F.lit(1 - teacher).alias("pupil")))
    return reduce(DataFrame.unionByName, chosen)


def _one_task(samples: list[DataFrame], last: bool):
    return reduce(DataFrame.unionByName, samples).coalesce(1).mapInArrow(
        partial(_fitted, last=last), "share double, weights array<array<double>>").first()


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS,
        taught_rows: int = TAUGHT_ROWS) -> Model:
    """Both views, fitted on samples of labelled rows and on pseudo-labels of all other rows."""
    truth = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        (F.avg("quality") >= 0.5).cast("int").alias("label"))
    rows = docs.select(*_inputs(docs)).withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    ids = rows.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    marked = written(ids.join(truth, "doc_id").withColumn("key", F.xxhash64("doc_id")), "labelled")
    wanted = marked.orderBy("key").limit(labelled)  # at most ``labelled`` rows
    samples = [written(rows.join(F.broadcast(wanted), "doc_id").withColumn(
        "pupil", F.lit(None).cast("int")).mapInArrow(_sampled, SAMPLE), "sample")]
    used = None
    for number in range(rounds + 1):
        share, weights = _one_task(samples, number == rounds)
        weights = [np.array(w) for w in weights]
        if not weights or number == rounds:
            return Model(share, *weights)
        odds = written(rows.mapInArrow(
            partial(_odds, weights=weights),
            "doc_id bigint, text_key bigint, odds0 double, odds1 double"), "odds")
        # Labelled rows grow with the documents, so both sides are shuffled.
        free = odds.join(marked.select("doc_id").hint("merge"), "doc_id", "left_anti")
        if used is not None:
            # At most 2 x ``taught_rows`` texts a round.
            free = free.join(F.broadcast(used), "text_key", "left_anti")
        free = written(free.groupBy("text_key").agg(
            *[F.min(c).alias(c) for c in ("doc_id", "odds0", "odds1")]), "free")
        chosen = written(taught(free, share, taught_rows), "taught")
        texts = chosen.select("text_key").distinct()
        used = texts if used is None else used.unionByName(texts)
        # Copies of a text are one row; their ids may repeat too.
        found = rows.join(F.broadcast(chosen), ["doc_id", "text_key"]).withColumn(
            "key", F.col("text_key"))
        samples.append(written(found.dropDuplicates(["text_key", "pupil"]).mapInArrow(
            _sampled, SAMPLE), "sample"))
    raise ValueError("rounds must not be negative")


def _scored(batches: Iterable[pa.RecordBatch], model: Model,
            min_score: float) -> Iterator[pa.RecordBatch]:
    for batch in T.blocks(batches, size=BLOCK_BYTES):
        found = model.score(batch)
        yield pa.RecordBatch.from_arrays(
            [T.column(batch, "doc_id"), *map(pa.array, found), pa.array(found[2] >= min_score)],
            ["doc_id", "text_score", "page_score", "score", "keep"])


def scores(docs: DataFrame, model: Model, min_score: float = MIN_SCORE) -> DataFrame:
    """Probability of being good by each view and by both, for every row."""
    return docs.select(*_inputs(docs)).mapInArrow(
        partial(_scored, model=model, min_score=min_score), SCORES)


def _kept(batches: Iterable[pa.RecordBatch], model: Model,
          min_score: float) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    for batch in T.blocks(batches, 1 - len(names), size=BLOCK_BYTES):
        columns = batch.num_columns - len(names)
        inputs = pa.RecordBatch.from_arrays(batch.columns[columns:], names)
        yield batch.select(range(columns)).filter(pa.array(model.score(inputs)[2] >= min_score))


def keep_good(docs: DataFrame, labels: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``min_score``."""
    # The last columns are taken by their places.
    inputs = [c.alias(T.fresh(docs.columns, f"input{i}")) for i, c in enumerate(_inputs(docs))]
    return docs.select("*", *inputs).mapInArrow(
        partial(_kept, model=fit(docs, labels), min_score=min_score), docs.schema)
