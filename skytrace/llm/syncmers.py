"""Document fingerprints from closed syncmers, in built-in functions only.

A k-mer of ``K`` words is chosen when the smallest hash among its runs of ``S`` words lies at its
first or last run. The choice depends on those words alone, so an unchanged passage yields the same
anchors wherever it stands. An anchor is 40 bits of the k-mer's hash over its position (24 bits, in
words); a fingerprint is all anchors with different hashes, 16 hexadecimal digits each, so it grows
with the text. Texts of fewer words, or without a chosen k-mer, have one anchor: their whole hash.

Likeness of two fingerprints (``passages``): of all hashes of both together, the share that occurs
in both and keeps its distance, give or take ``TOLERANCE`` words, to the common anchor before or
behind it. Passages may be moved by any number of words, each by its own.

A caller that wants fingerprints of bounded size can ask for the ``size`` smallest anchors. Their
likeness is an estimate from the ``size`` smallest hashes of both, and it knows one displacement, the
usual one. The registered query does not use it.

Following documents: ids are dealt into ranges of about equal numbers by quantiles, each range is
one window task, and the first row of each range also goes to the range before it. Texts move once.

Nulls and edges: a null text is empty; empty texts are alike. Rows with a null ``doc_id`` come first.
Rows with equal ids follow each other by text. A table of one row follows itself; an empty one gives
no rows. Other columns of the input are ignored. Position 2**24 is counted as 0 again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 5
S = 2
TOLERANCE = 8
POSITION_BITS = 24
RANGE_BYTES = 16 << 20
#: Bounds the list of range starts that is broadcast (24 bytes each).
MAX_RANGES = 65_536
MAX_QUANTILES = 512

_WHITE = " \t\n\u000b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Runs of other than the six ASCII white space characters; one empty word if there are none."""
    return F.split(F.btrim(text, F.lit(_WHITE)), "[ \\t-\\r]+")


def _packed(hashed: Column, position: Column) -> Column:
    high = hashed.bitwiseAND(F.lit(-(1 << POSITION_BITS)))
    return high.bitwiseOR(position.cast("bigint").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)))


def _hash_of(anchor: Column) -> Column:
    return F.shiftright(anchor, POSITION_BITS)


def _position_of(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit((1 << POSITION_BITS) - 1))


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Anchors of all closed syncmers of a text, in order of position; at least one."""
    inner = k - s + 1
    whole = F.array(_packed(F.xxhash64(text), F.lit(0)))

    def chosen(runs: Column) -> Column:
        def at_edge(i: Column) -> Column:
            edge = F.least(F.get(runs, i), F.get(runs, i + (inner - 1)))
            middle = [F.get(runs, i + j) for j in range(1, inner - 1)]
            return edge <= (F.least(*middle) if len(middle) > 1 else middle[0])

        return F.filter(F.sequence(F.lit(0), F.size(runs) - inner), at_edge)

    def of(hashes: Column) -> Column:
        runs = F.transform(
            F.slice(hashes, 1, F.size(hashes) - (s - 1)),
            lambda h, i: F.xxhash64(h, *[F.get(hashes, i + j) for j in range(1, s)]))
        found = let(runs, lambda r: F.transform(
            chosen(r), lambda i: _packed(
                F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]), i)))
        return F.when(F.size(hashes) >= k, found).otherwise(F.array().cast("array<bigint>"))

    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    return let(let(hashed, of), lambda a: F.when(F.size(a) > 0, a).otherwise(whole))


def sketch(text: Column, k: int = K, s: int = S) -> Column:
    """All anchors with different hashes, in order; of equal hashes the first position."""
    return let(F.sort_array(anchors(text, k, s)), lambda ordered: F.filter(
        ordered, lambda a, i: (i == 0) | (_hash_of(a) != _hash_of(F.get(ordered, i - 1)))))


def digits(anchors_of_text: Column) -> Column:
    """A fingerprint as text."""
    return F.array_join(F.transform(
        anchors_of_text, lambda a: F.lpad(F.lower(F.hex(a)), 16, "0")), "")


def passages(a: Column, b: Column, tolerance: int = TOLERANCE) -> Column:
    """Share of anchors common to two whole sketches that keep their distance to a neighbour."""
    low = F.lit((1 << POSITION_BITS) - 1)

    def shares(merged: Column) -> Column:
        pairs = F.filter(F.sequence(F.lit(1), F.size(merged) - 1), lambda i: _hash_of(
            F.get(merged, i)) == _hash_of(F.get(merged, i - 1)))
        return let(F.flatten(F.transform(
            pairs, lambda i: F.array(F.get(merged, i - 1), F.get(merged, i)))), of_common)

    def of_common(common: Column) -> Column:
        # Both sides in order of hash: one anchor of each for every common hash.
        places = F.zip_with(
            F.array_intersect(a, common), F.array_intersect(b, common),
            lambda x, y: F.shiftleft(_position_of(x), POSITION_BITS).bitwiseOR(_position_of(y)))
        moved = F.transform(F.sort_array(places),
                            lambda p: p.bitwiseAND(low) - F.shiftright(p, POSITION_BITS))
        return let(moved, share)

    def share(moved: Column) -> Column:
        def near(d: Column, i: Column) -> Column:
            return F.coalesce(F.abs(d - F.get(moved, i)) <= tolerance, F.lit(False))

        kept = F.size(F.filter(moved, lambda d, i: near(d, i - 1) | near(d, i + 1)))
        # One common anchor alone has no neighbour to disagree with.
        kept = F.greatest(kept, F.least(F.size(moved), F.lit(1)))
        return kept / (F.size(a) + F.size(b) - F.size(moved))

    return let(F.sort_array(F.concat(a, b)), shares)


def _ranges(docs: DataFrame, range_bytes: int) -> tuple[Column, int]:
    """The range number of ``doc_id``: quantiles, and equal steps between them."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = int(min(MAX_RANGES, max(1, total // range_bytes)))
    quantiles = min(ranges, MAX_QUANTILES)
    steps = -(-ranges // quantiles)
    bounds = docs.agg(F.percentile_approx(
        "doc_id", [i / quantiles for i in range(quantiles + 1)])).first()[0] or [0]
    bounds = sorted(set(bounds))
    edges = F.lit(bounds)
    lower = F.size(F.filter(edges, lambda e: e <= F.col("doc_id"))) - 1
    lower = F.greatest(F.lit(0), F.least(lower, F.lit(max(len(bounds) - 2, 0))))

    def number(i: Column) -> Column:
        begin = F.get(edges, i).cast("double")
        width = F.coalesce(F.get(edges, i + 1).cast("double") - begin, F.lit(1.0))
        step = F.floor((F.col("doc_id").cast("double") - begin) / width * steps)
        return i.cast("bigint") * steps + F.greatest(F.lit(0), F.least(step, F.lit(steps - 1)))

    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(let(lower, number)), ranges


def with_next(docs: DataFrame, columns: list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``docs`` with ``next_<column>`` of the following row by ``doc_id``; the first after the last.

    ``docs`` needs ``doc_id`` and ``text``.
    """
    number, ranges = _ranges(docs, range_bytes)
    placed = docs.withColumn("range_no", number)
    # One row per range, of which there are at most MAX_RANGES (and one for null ids).
    firsts = sorted((r.range_no, r.first_id) for r in placed.groupBy("range_no").agg(
        F.min("doc_id").alias("first_id")).collect())
    before = [n for n, _ in firsts[-1:] + firsts[:-1]]
    extra = docs.sparkSession.createDataFrame(
        [(first, n) for (_, first), n in zip(firsts, before)], "first_id bigint, to_range bigint")
    guests = placed.join(F.broadcast(extra), F.col("doc_id").eqNullSafe(F.col("first_id")))
    guests = guests.select(*docs.columns, F.col("to_range").alias("range_no"),
                           F.lit(True).alias("guest"))
    rows = placed.select(*docs.columns, "range_no", F.lit(False).alias("guest")).unionByName(guests)
    order = W.partitionBy("range_no").orderBy("guest", F.asc_nulls_first("doc_id"), "text")
    following = rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return following.where(~F.col("guest")).drop("guest", "range_no")


def compared(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each document's fingerprint beside its edited text's and the next document's.

    The edited text has its last half replaced by as many code points of the next document.
    """
    own = docs.select(F.col("doc_id").cast("bigint"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Fingerprints may be as long as texts: the next one is computed again rather than moved.
    rows = with_next(own, ["text"], range_bytes)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"),
                       "text", "next_text")
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *[
        sketch(F.col(text)).alias(name) for text, name in
        (("text", "sketch"), ("edited", "edited_sketch"), ("next_text", "next_sketch"))])

    def near(other: str) -> Column:
        return passages(F.col("sketch"), F.col(other))

    return rows.select(
        "doc_id", "n_chars", "edited_sha256", digits(F.col("sketch")).alias("fingerprint"),
        digits(F.col("edited_sketch")).alias("edited_fingerprint"),
        near("edited_sketch").alias("near_edited"), near("next_sketch").alias("near_next"))
