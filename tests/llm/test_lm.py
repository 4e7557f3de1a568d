import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from skytrace.llm import eliasfano as E
from skytrace.llm import lm
from tests.llm.helpers import documents, invented, odd_documents


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "\n"]


def plain_scores(rows):
    """Word, pair and triple counts in dictionaries."""
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    one, two, three = Counter(), Counter(), Counter()
    for i, t in rows:
        if not held[i]:
            own = ["\n", *tokens(t)]
            one.update(own[1:])
            two.update(zip(own, own[1:]))
            three.update(zip(own, own[1:], own[2:]))
    kinds = defaultdict(int)
    for a, b, _ in three:
        kinds[a, b] += 1
    total, known = sum(one.values()), len(one)
    out = []
    for i, t in rows:
        own = ["\n", *tokens(t)]
        base = score = 0.0
        for k in range(1, len(own)):
            word, before = own[k], own[k - 1]
            p = (one[word] + 0.1) / (total + 0.1 * (known + 1))
            base += math.log10(p)
            weight = 2 * one[before] ** 0.8 if one[before] else 1.0
            p = (two[before, word] + weight * p) / (one[before] + weight)
            if k > 1:
                pair = (own[k - 2], before)
                n = kinds[pair]
                if n:
                    p = (three[(*pair, word)] + n * p) / (two[pair] + n)
            score += math.log10(p)
        out.append((i, held[i], len(own) - 1, sum(one[w] > 0 for w in own[1:]), total, base, score))
    return out


@pytest.mark.parametrize("sizes", [{}, {"BLOCK_TOKENS": 300, "WORD_PART_BYTES": 4000,
                                        "TRIE_TOKENS": 700}])
def test_scores_against_counted_dictionaries(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(lm, name, value)
    monkeypatch.setattr(lm.T, "BLOCK_BYTES", 2000)
    rows = list(enumerate(["The the THE a", None, "", *invented(150)]))
    found = {r.doc_id: r for r in lm.scores(documents(spark, rows)).collect()}
    assert len(found) == len(rows)
    for i, held, n, known, total, base, score in plain_scores(rows):
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base)
        # Shares are rounded down by less than a step each.
        assert score - 3 * n / E.STEPS_PER_DECADE <= r.score <= score + 1e-9


def test_copies_score_better_than_single_words(spark):
    rows = [(i, t) for i, t in enumerate(invented(200)) if t]
    found = [r for r in lm.scores(documents(spark, rows)).collect() if r.held_out]
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


def test_tries_can_be_stored(spark, tmp_path):
    files = lm.trie_files(documents(spark, list(enumerate(invented(30))))).collect()
    for f in files:
        (tmp_path / f.name).write_bytes(f.content)
    assert E.Trie.load(str(tmp_path)).pairs.words.n > 0


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = lm.scores(docs).collect()
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    for a, b in zip(sorted(plain_scores(plain), key=key), sorted(
            [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)
             for r in rows], key=key)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    assert lm.scores(documents(spark, [])).count() == 0


@pytest.mark.parametrize("top", [1, 30, 10**6, 2**45])
def test_elias_fano(top):
    draw = np.random.default_rng(top % 97)
    for n in (0, 1, 2, 700):
        values = np.sort(draw.integers(0, top, n))
        made = E.EliasFano.of(values)
        assert made.access(np.arange(n)).tolist() == values.tolist()
        if n:
            wanted = np.concatenate((draw.integers(0, top + 3, 200), values[:50] + 1))
            begin = draw.integers(0, n + 1, len(wanted))
            end = np.minimum(begin + draw.integers(0, n + 1, len(wanted)), n)
            expected = [b + int(np.searchsorted(values[b:e], w))
                        for w, b, e in zip(wanted, begin, end)]
            assert made.successor(wanted, begin, end).tolist() == expected


def test_trie_knows_what_it_was_given(tmp_path):
    draw = np.random.default_rng(0)
    a, b, c = draw.integers(1, 60, 4000), draw.integers(1, 40, 4000), draw.integers(0, 30, 4000)
    rows, number = E.distinct_rows(a, b, c)
    E.Trie.of(a[rows], b[rows], c[rows], np.bincount(number), np.bincount(a)[a[rows]],
              lm.pair_weight).save(str(tmp_path))
    trie = E.Trie.load(str(tmp_path))
    assert isinstance(trie.pairs.words.high, np.memmap)
    ones, pairs = Counter(a.tolist()), Counter(zip(a.tolist(), b.tolist()))
    triples = Counter(zip(a.tolist(), b.tolist(), c.tolist()))
    qa, qb, qc = (draw.integers(1, n, 3000) for n in (70, 50, 40))
    at = trie.pair(qa, qb)
    below = trie.triples.find(at, qc)
    for x, y, z, i, j in zip(qa.tolist(), qb.tolist(), qc.tolist(), at, below):
        assert (i >= 0) == ((x, y) in pairs) and (j >= 0) == ((x, y, z) in triples)
        if i >= 0:
            share = pairs[x, y] / (ones[x] + 2 * ones[x] ** 0.8)
            stored = E.probabilities(trie.pairs.values["share"][[i]])[0]
            assert 0.998 * share < stored <= share * (1 + 1e-9)


def test_packed_columns():
    draw = np.random.default_rng(2)
    columns = [draw.integers(0, top, 50) for top in (1, 200, 70_000, 2**50)] + [np.zeros(0, int)]
    for c, d in zip(columns, lm.unpack(lm.pack(*columns))):
        assert c.tolist() == d.tolist()
