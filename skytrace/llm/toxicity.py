"""Toxic spans by a linear-chain conditional random field.

Tokens are runs of letters, digits and bytes above ASCII, A-Z lower-cased. A token's features are
its hashed spelling, beginning and ending; two labels, clean and toxic, follow each other by a
learned transition. Forward-backward gives every token's marginal probability of being toxic; a
document's score is a logistic function of its highest marginal and of how many toxic tokens are
expected, and runs of tokens above one half are its offending spans, in code points.

Labels are per document, so training tokens are labelled first: words that stand in toxic documents
in many surroundings, and hardly in clean ones, mark their occurrences in toxic documents.

Fitted on a bounded sample, the documents with the smallest hashes: ``TOXIC`` toxic and ``CLEAN``
clean ones, ``SAMPLE_TOKENS`` neighbouring tokens of each for the field and all tokens of each for the model of
documents. Every document is scored on all its
tokens. A chain of any length is computed in columns: each column's tokens are first reduced to one
2 x 2 matrix, the matrices carry the state from column to column, then all columns run at once.

Nulls and edges: null and empty texts have no tokens and get the score of a text without toxic
tokens. Several labels of a document count as toxic if any is. Null labels are left out; without
labels of both classes every score is the share of toxic ones. Repeated rows are scored each; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.llm import text as T
from skytrace.llm.linear import apply_logistic, fit_logistic, sigmoid

TOXIC = 2000
CLEAN = 4000
SAMPLE_TOKENS = 1024
FEATURES = 1 << 18
BEGINNING, ENDING = 5, 4
WINDOW = 24
#: When a word counts as toxic: surroundings, share of its documents, log likelihood ratio.
LEAST, PURITY, EVIDENCE = 5, 0.7, 24.0
PREDICTED = 0.3
COLUMNS = 1024
BLOCK_BYTES = 2 << 20

RESULT = ("doc_id bigint, score double, predicted int, toxic_tokens double, "
          "spans array<struct<begin:bigint, end:bigint, probability:double>>")

_INSIDE = np.zeros(256, bool)
_INSIDE[128:] = True
_INSIDE[[b for b in range(128) if chr(b).isalnum()]] = True


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Begin and end of each token, each text's first token, and three hashed features."""
    inside = _INSIDE[data]
    spaced = np.where(inside, np.frombuffer(T.LOWER, np.uint8)[data], np.uint8(32))
    starts, ends, firsts = T.spans(spaced, offsets)
    found = [(starts, ends), (starts, np.minimum(starts + BEGINNING, ends)),
             (np.maximum(ends - ENDING, starts), ends)]
    features = np.stack([
        (T.mixed(T.span_hashes(spaced, a, b) + np.uint64(k)) % np.uint64(FEATURES)).astype(np.int32)
        for k, (a, b) in enumerate(found)])
    return starts, ends, firsts, features


class Field:
    """Emission weights of the toxic label, and transitions between clean (0) and toxic (1)."""

    def __init__(self) -> None:
        self.weights = np.zeros(FEATURES)
        self.bias = 0.0
        self.moves = np.zeros((2, 2))
        self.document = np.zeros(3)

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[features].sum(axis=0) + self.bias, -30, 30)


def marginals(emissions: np.ndarray, begins: np.ndarray, moves: np.ndarray,
              columns: int = COLUMNS) -> np.ndarray:
    """Probability of label 1 at every token; ``begins`` marks each chain's first token."""
    n = len(emissions)
    if not n:
        return np.zeros(0)
    width = min(columns, n)
    height = -(-n // width)
    padded = height * width
    odds = np.ones(padded)
    odds[:n] = np.exp(emissions)
    first = np.ones(padded, bool)
    first[:n] = begins
    odds, first = (x.reshape(width, height).T for x in (odds, first))
    step = np.exp(moves)
    # m[i][j]: from label i before to label j here; at a chain's begin all labels before are equal.
    m = [[np.where(first, 1.0, step[i, j]) * (odds if j else 1.0) for j in (0, 1)] for i in (0, 1)]

    rows = [[np.full(width, float(i == j)) for j in (0, 1)] for i in (0, 1)]
    scale = [np.zeros(width), np.zeros(width)]
    for t in range(height):
        for i in (0, 1):
            a, b = rows[i]
            x, y = a * m[0][0][t] + b * m[1][0][t], a * m[0][1][t] + b * m[1][1][t]
            total = x + y
            rows[i] = [x / total, y / total]
            scale[i] += np.log(total)
    top = np.maximum(*scale)
    reduced = np.array([[r * np.exp(s - top) for r in row] for row, s in zip(rows, scale)])
    before, after = np.empty((2, width)), np.empty((2, width))
    state = np.array([0.5, 0.5])
    for c in range(width):
        before[:, c] = state
        state = state @ reduced[:, :, c]
        state = state / state.sum()
    state = np.array([0.5, 0.5])
    for c in range(width - 1, -1, -1):
        after[:, c] = state
        state = reduced[:, :, c] @ state
        state = state / state.sum()

    forward = np.empty((height, width))
    a, b = before
    for t in range(height):
        x, y = a * m[0][0][t] + b * m[1][0][t], a * m[0][1][t] + b * m[1][1][t]
        total = x + y
        a, b = x / total, y / total
        forward[t] = b
    out = np.empty((height, width))
    a, b = after
    for t in range(height - 1, -1, -1):
        toxic = forward[t] * b
        out[t] = toxic / (toxic + (1 - forward[t]) * a)
        x, y = m[0][0][t] * a + m[0][1][t] * b, m[1][0][t] * a + m[1][1][t] * b
        total = x + y
        a, b = x / total, y / total
    return out.T.ravel()[:n]


def document_features(p: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Highest marginal and logarithm of expected toxic tokens; the expectation itself."""
    expected = T.per_text(p, firsts)
    filled = np.flatnonzero(np.diff(firsts))
    highest = np.zeros(len(firsts) - 1)
    if len(filled):
        highest[filled] = np.maximum.reduceat(p, firsts[:-1][filled])
    return np.column_stack((highest, np.log1p(np.maximum(expected, 0)))), expected


# Training


def toxic_words(words: np.ndarray, contexts: np.ndarray, doc: np.ndarray, label: np.ndarray,
                least: int = LEAST, purity: float = PURITY,
                evidence: float = EVIDENCE) -> np.ndarray:
    """Words that stand in toxic documents far more often than chance has it.

    One entry per token: its word, the words beside it, its document. A word is chosen when at
    least ``least`` different surroundings in toxic documents have it (copies of one document are
    no evidence), ``purity`` of its documents are toxic, and its log likelihood ratio against the
    share of toxic documents is at least ``evidence``.
    """
    ids, at = np.unique(words, return_inverse=True)
    n = len(label) + 1
    pairs = np.unique(at * n + doc)
    toxic = np.bincount((pairs // n)[label[pairs % n] == 1], minlength=len(ids)).astype(float)
    clean = np.bincount((pairs // n)[label[pairs % n] == 0], minlength=len(ids)).astype(float)
    own = label[doc] == 1
    _, first = np.unique(T.mixed(contexts[own]) + at[own].astype(np.uint64), return_index=True)
    surroundings = np.bincount(at[own][first], minlength=len(ids))
    share = label.mean()
    total = toxic + clean
    rate = toxic / total
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.where(toxic > 0, toxic * np.log(rate / share), 0)
                     + np.where(clean > 0, clean * np.log((1 - rate) / (1 - share)), 0))
    return ids[(surroundings >= least) & (rate >= purity) & (ratio >= evidence)]


def train(field: Field, features: np.ndarray, firsts: np.ndarray, label: np.ndarray,
          rounds: int = 60, rate: float = 0.5, shrink: float = 1e-4) -> None:
    """Maximise the likelihood of token labels by adaptive gradient steps over all chains."""
    lengths = np.diff(firsts)
    begins = np.zeros(features.shape[1], bool)
    begins[firsts[:-1][lengths > 0]] = True
    after = np.flatnonzero(~begins)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[after - 1], label[after]), 1)
    squares, bias_squares, move_squares = np.full(FEATURES, 1e-8), 1e-8, np.full((2, 2), 1e-8)
    for _ in range(rounds):
        emissions = field.emissions(features)
        p = marginals(emissions, begins, field.moves)
        slope = (p - label) / max(len(label), 1)
        by_feature = sum(np.bincount(f, slope, FEATURES) for f in features) + \
            shrink / 100 * field.weights
        # Expected transitions: pair marginals from the one-sided ones and the potentials.
        pair = _pairs(emissions, begins, field.moves, after)
        by_move = (pair - seen) / max(len(label), 1) + shrink * field.moves
        squares += by_feature ** 2
        bias_squares += slope.sum() ** 2
        move_squares += by_move ** 2
        field.weights -= rate * by_feature / np.sqrt(squares)
        field.bias -= rate * slope.sum() / np.sqrt(bias_squares)
        field.moves -= 0.2 * by_move / np.sqrt(move_squares)


def _pairs(emissions: np.ndarray, begins: np.ndarray, moves: np.ndarray,
           after: np.ndarray) -> np.ndarray:
    """Expected number of each transition."""
    n = len(emissions)
    forward, backward = np.full((n, 2), 0.5), np.full((n, 2), 0.5)
    starts = np.flatnonzero(begins)
    lengths = np.diff(np.append(starts, n))
    step, odds = np.exp(moves), np.exp(emissions)
    weight = np.column_stack((np.ones(n), odds))
    for k in range(int(lengths.max(initial=0))):
        at = starts[lengths > k] + k
        now = (weight[at] if not k else (forward[at - 1] @ step) * weight[at])
        forward[at] = now / now.sum(axis=1, keepdims=True)
    for k in range(int(lengths.max(initial=0)) - 2, -1, -1):
        at = starts[lengths > k + 1] + k
        now = (backward[at + 1] * weight[at + 1]) @ step.T
        backward[at] = now / now.sum(axis=1, keepdims=True)
    joint = (forward[after - 1][:, :, None] * step
             * (weight[after] * backward[after])[:, None, :])
    return (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def _sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.blocks(batches, size=BLOCK_BYTES):
        *_, firsts, features = tokens(*T.buffer_of(T.column(batch, "text")))
        keys = T.column(batch, "key").to_numpy()
        parts = []
        for i, key in enumerate(keys):
            room = max(0, int(firsts[i + 1] - firsts[i]) - SAMPLE_TOKENS)
            begin = firsts[i] + (int(key) % (room + 1))
            parts.append(features[:, begin:min(begin + SAMPLE_TOKENS, firsts[i + 1])])
        yield pa.RecordBatch.from_arrays(
            [T.column(batch, "key"), T.column(batch, "label"),
             pa.array([p.ravel() for p in parts], pa.list_(pa.int32()))],
            ["key", "label", "features"])


def fit(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> Field:
    """A field trained on samples of the documents that have a label."""
    truth = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        (F.max("toxic") > 0).cast("int").alias("label"))
    ids = docs.select(F.col("doc_id").cast("bigint")).distinct()
    marked = ids.join(truth, "doc_id").withColumn("key", F.xxhash64("doc_id"))
    chosen = [marked.where(F.col("label") == k).orderBy("key").limit(size)
              for k, size in ((1, toxic), (0, clean))]
    wanted = chosen[0].unionByName(chosen[1])  # at most toxic + clean rows
    table = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(
        F.broadcast(wanted), "doc_id").mapInArrow(
        _sampled, "key bigint, label int, features array<int>").toArrow().sort_by("key")
    label = np.array(table.column("label").to_pylist(), np.int64)
    parts = [f.reshape(3, -1) for f in T.lists(table.column("features"))]
    totals = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    totals = totals.get(0, 0), totals.get(1, 0)
    field = learn(parts, label, totals)
    # Documents are scored by their whole texts, so that is what their model learns from.
    whole = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(
        F.broadcast(wanted), "doc_id").withColumn(
        "same", F.xxhash64(F.coalesce("text", F.lit("")))).mapInArrow(
        partial(_documents, field=field), "same bigint, label int, features array<double>")
    table = whole.toArrow()
    if len(table):
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("same", "label", "features"))))
        rows = [r for i, r in enumerate(rows) if not i or r[:2] != rows[i - 1][:2]]
        fit_documents(field, np.array([r[2] for r in rows]),
                      np.array([r[1] for r in rows], np.int64), totals)
    return field


def _documents(batches: Iterable[pa.RecordBatch], field: Field) -> Iterator[pa.RecordBatch]:
    """What the document model sees of every whole text."""
    for batch in T.blocks(batches, size=BLOCK_BYTES):
        starts, _, firsts, features = tokens(*T.buffer_of(T.column(batch, "text")))
        begins = np.zeros(len(starts), bool)
        begins[firsts[:-1][np.diff(firsts) > 0]] = True
        p = marginals(field.emissions(features), begins, field.moves)
        found = document_features(p, firsts)[0]
        yield pa.RecordBatch.from_arrays(
            [T.column(batch, "same"), T.column(batch, "label"),
             pa.array(found.tolist(), pa.list_(pa.float64()))], ["same", "label", "features"])


def fit_documents(field: Field, features: np.ndarray, label: np.ndarray,
                  totals: tuple[int, int]) -> None:
    """Fit the document model on whole documents, at the rate of toxic ones among all."""
    if not len(label) or label.min() == label.max():
        return
    field.document = fit_logistic(features, label, ridge=0.1)
    if min(totals):
        field.document[-1] += np.log(totals[1] / totals[0]) - np.log(label.mean() / (
            1 - label.mean()))


def learn(parts: list[np.ndarray], label: np.ndarray, totals: tuple[int, int] = (0, 0)) -> Field:
    """A field from the features of each document's tokens and the documents' labels.

    ``totals`` are all clean and toxic documents of which these are samples.
    """
    field = Field()
    rate = float(label.mean()) if len(label) else 0.0
    field.bias = -5.0
    field.document = np.array([0.0, 0.0, np.log(max(rate, 1e-6) / max(1 - rate, 1e-6))])
    if not len(label) or label.min() == label.max():
        return field
    # Equal documents teach once.
    seen, kept = set(), []
    for i, part in enumerate(parts):
        key = (part.tobytes(), label[i])
        if key not in seen:
            seen.add(key)
            kept.append(i)
    parts, label = [parts[i] for i in kept], label[kept]
    lengths = np.array([p.shape[1] for p in parts])
    features = np.concatenate(parts, axis=1).astype(np.int64)
    doc = np.repeat(np.arange(len(parts)), lengths)
    sides = np.stack((np.roll(features[0], 1), np.roll(features[0], -1))).astype(np.uint64)
    words = toxic_words(features[0], sides[0] * np.uint64(FEATURES) + sides[1], doc, label)
    marked = np.isin(features[0], words) & (label[doc] == 1)
    # Train on the surroundings of toxic tokens and on a window of every document.
    near = np.zeros(len(marked), bool)
    for at in np.flatnonzero(marked):
        near[max(0, at - WINDOW):at + WINDOW + 1] = True
    position = np.arange(len(doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    near |= position < WINDOW
    # Where words stand that only look toxic in a clean document, the field must see them too.
    near |= np.isin(features[0], words)
    chain = np.cumsum(np.diff(near.astype(int), prepend=0) == 1) * len(parts) + doc
    changed = np.flatnonzero(np.diff(chain[near], prepend=-1))
    train(field, features[:, near], np.append(changed, near.sum()), marked[near].astype(np.int64))
    begins = np.zeros(len(doc), bool)
    firsts = np.concatenate(([0], np.cumsum(lengths)))
    begins[firsts[:-1][lengths > 0]] = True
    p = marginals(field.emissions(features), begins, field.moves)
    fit_documents(field, document_features(p, firsts)[0], label, totals)
    return field


def _scored(batches: Iterable[pa.RecordBatch], field: Field,
            predicted: float) -> Iterator[pa.RecordBatch]:
    for batch in T.blocks(batches, size=BLOCK_BYTES):
        data, offsets = T.buffer_of(T.column(batch, "text"))
        starts, ends, firsts, features = tokens(data, offsets)
        begins = np.zeros(len(starts), bool)
        begins[firsts[:-1][np.diff(firsts) > 0]] = True
        p = marginals(field.emissions(features), begins, field.moves)
        found, expected = document_features(p, firsts)
        score = sigmoid(apply_logistic(found, field.document))
        hit = np.flatnonzero(p >= 0.5)
        # Code points before a byte: bytes that do not continue a character.
        chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        owner = np.searchsorted(firsts, hit, "right") - 1
        last = -2
        for t, d in zip(hit.tolist(), owner.tolist()):
            base = chars[offsets[d]]
            if t == last + 1 and spans[d]:
                spans[d][-1]["end"] = int(chars[ends[t]] - base)
                spans[d][-1]["probability"] = max(spans[d][-1]["probability"], float(p[t]))
            else:
                spans[d].append({"begin": int(chars[starts[t]] - base),
                                 "end": int(chars[ends[t]] - base), "probability": float(p[t])})
            last = t
        yield pa.RecordBatch.from_arrays(
            [T.column(batch, "doc_id"), pa.array(score),
             pa.array((score >= predicted).astype(np.int32)), pa.array(expected),
             pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()),
                                                 ("probability", pa.float64())])))],
            ["doc_id", "score", "predicted", "toxic_tokens", "spans"])


def score(docs: DataFrame, field: Field, predicted: float = PREDICTED) -> DataFrame:
    """Score, prediction, expected toxic tokens and offending spans of every row."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        partial(_scored, field=field, predicted=predicted), RESULT)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def evaluated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All documents scored by a field that has not seen the labels of those held out."""
    own = F.col("doc_id").cast("bigint")
    field = fit(docs.where(~held_out(own)), labels.where(~held_out(own)))
    return score(docs, field).withColumn("held_out", held_out(own))
