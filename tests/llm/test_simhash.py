import numpy as np
import pytest
import xxhash

from skytrace.llm import simhash as S
from skytrace.llm import text as T
from tests.llm.helpers import documents, invented, odd_documents


def plain_fingerprint(text):
    words = (text or "").encode().translate(T.LOWER).split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes, distance=4):
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= distance:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(codes))]


def clustered(n, seed):
    draw = np.random.default_rng(seed)
    centres = draw.integers(0, 2**63, max(2, n // 40)).tolist()
    codes = set()
    while len(codes) < n:
        code = centres[draw.integers(len(centres))]
        for _ in range(draw.integers(0, 6)):
            code ^= 1 << int(draw.integers(64))
        codes.add(code)
    return list(codes)


def partition(labels):
    groups = {}
    for i, label in enumerate(labels):
        groups.setdefault(label, []).append(i)
    return sorted(map(tuple, groups.values()))


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 900, 3000])
def test_index_finds_every_component(n):
    codes = clustered(n, n)
    found = S.components(np.array(codes, np.uint64))
    assert partition(found.tolist()) == partition(plain_components(codes))


def test_gray_neighbours_differ_in_one_bit():
    codes = np.arange(64, dtype=np.uint64) ^ (np.arange(64, dtype=np.uint64) >> np.uint64(1))
    assert S.gray_rank(codes).tolist() == list(range(64))


def test_bands_cover_any_four_bits():
    draw = np.random.default_rng(1)
    for blocks in (5, 6, 7):
        masks = S.bands(blocks)
        for _ in range(300):
            flips = sum(1 << int(b) for b in set(draw.integers(0, 64, 4).tolist()))
            assert any(flips & (m % 2**64) == 0 for m in masks)
    assert S.blocks_for(1000) == 5 < S.blocks_for(10**9)


def test_chunked_fingerprint(monkeypatch):
    text = invented(1, 3)[0] + " " + " ".join(f"t{i}" for i in range(500))
    whole = S.fingerprint(text.encode())
    assert whole == plain_fingerprint(text)
    split = T.word_chunks
    monkeypatch.setattr(T, "word_chunks", lambda t: split(t, 30))
    assert S.fingerprint(text.encode()) == whole


@pytest.mark.parametrize("options", [{}, {"bucket_rows": 0}, {"piece_rows": 5}])
def test_groups_against_all_pairs(spark, monkeypatch, options):
    texts = invented(400)
    ids = [3 * i + 5 for i in range(len(texts))]
    links = S.links
    monkeypatch.setattr(S, "links", lambda d, distance: links(d, distance, **options))
    rows = S.groups(documents(spark, list(zip(ids, texts)))).collect()
    prints = [plain_fingerprint(t) for t in texts]
    expected = {i: (f"{p:016x}", ids[c]) for i, p, c in zip(ids, prints, plain_components(prints))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == expected
    assert len({c for _, c in expected.values()}) < len(texts)


def test_odd_rows_and_one_of_each_group(spark):
    docs = odd_documents(spark)
    rows = S.groups(docs).collect()
    assert len(rows) == docs.count()
    by = {(r.doc_id, r.fingerprint): r.component_id for r in rows}
    zero = "0" * 16
    assert by[2, zero] == by[3, zero] == by[4, zero] == by[None, zero] == 2
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    # Each of the groups {1, 6, 6} and {2, 3, 4} keeps one row; both rows without an id stay.
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        map(str, (-9, 1, 2, 5, 7, 8, None, None)))


def test_empty(spark):
    assert S.groups(documents(spark, [])).count() == 0
    assert S.keep_one(documents(spark, [])).count() == 0
