import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from skytrace.llm import packing as P
from tests.llm.helpers import documents, invented, odd_documents


def tokenizer():
    return Tokenizer.from_file(P.VOCABULARY)


def test_ids_equal_those_of_whole_texts():
    draw = random.Random(2)
    signs = "aB é'sTt \u0085\x1c3½́İΣςÅ日本😀.,!-\n\t\xa0ﬁ"
    texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(40))) for _ in range(800)]
    texts += ["".join(chr(draw.randrange(1, 0x300)) for _ in range(30)) for _ in range(300)]
    texts += ["<|endoftext|> a<|startoftext|>b", "a <|endoftext|> b", "x<|endoftext|>y<|end",
              "<|EndOfText|> z", "é<|endoftext|>é <|startoftext|><|startoftext|>", "'s 'S it's IT'S don't x'll", "café " * 50, ""]
    encoder = P.Encoder(open(P.VOCABULARY, encoding="utf-8").read(), cached=100)
    whole = tokenizer()
    for text in texts:
        found = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert found == whole.encode(text, add_special_tokens=False).ids, text


def plain_plan(counts, capacity):
    """Bin by bin: greedy, then the smallest against the best pair."""
    left = {n: c for n, c in enumerate(counts) if c}
    bins = []

    def take(n):
        left[n] -= 1
        if not left[n]:
            del left[n]

    while left:
        own, room = [], capacity
        while fitting := [n for n in left if n <= room]:
            own.append(max(fitting))
            room -= own[-1]
            take(own[-1])
        if len(own) > 1 and room:
            gap, best = room + own[-1], None
            for a in sorted(left):
                for b in sorted(left):
                    if a <= b and (a != b or left[a] > 1) and a + b <= gap and (
                            best is None or a + b > sum(best)):
                        best = (a, b)
            if best and sum(best) > own[-1]:
                out = own.pop()
                take(best[0])
                take(best[1])
                left[out] = left.get(out, 0) + 1
                own += best
        bins.append(sum(own))
    return bins


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_that_of_single_bins(seed):
    draw = np.random.default_rng(seed)
    capacity = int(draw.integers(5, 40))
    counts = np.zeros(capacity + 1, np.int64)
    np.add.at(counts, draw.integers(1, capacity + 1, 150), 1)
    used = {}
    seen = np.zeros_like(counts)
    for length, rank, n, sequence, per, offset in P.plan(counts, capacity):
        assert rank == seen[length] and n % per == 0
        seen[length] += n
        for i in range(n):
            place = used.setdefault(sequence + i // per, [])
            place.append((offset + i % per * length, length))
    assert (seen == counts).all()
    for place in used.values():
        end = 0
        for begin, length in sorted(place):
            assert begin == end
            end += length
        assert end <= capacity
    fills = sorted(sum(n for _, n in place) for place in used.values())
    assert fills == sorted(plain_plan(counts.tolist(), capacity))


def checked(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for place in by.values():
        end = 0
        for offset, length in sorted(place):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_all_pieces_are_packed(spark):
    texts = [*invented(120), "long " * 9000]
    docs = documents(spark, list(enumerate(texts)))
    placed = P.packed(docs, with_ids=True)
    rows = placed.collect()
    whole = tokenizer()
    expected = {}
    for i, text in enumerate(texts):
        ids = [*whole.encode(text, add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start:start + 2048], "<u4")
            expected[i, k] = (start, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    used = checked(rows, 2048)
    assert used <= -(-sum(r.length for r in rows) // 2048) + 1
    sequences = {r.sequence_id: r.ids for r in P.sequences(placed).collect()}
    for r in rows:
        assert sequences[r.sequence_id][r.offset:r.offset + r.length] == r.ids


def test_buckets_do_not_change_places(spark):
    cut = spark.createDataFrame([(i, 0, 1 + i % 3) for i in range(300)],
                                "doc_id bigint, piece int, length bigint")
    for rows in (1, 7, 1000):
        assert checked(P.pack(cut, 10, bucket_rows=rows).collect(), 10) == 60


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = P.packed(docs).collect()
    checked(rows, 2048)
    assert sum(r.piece == 0 for r in rows) == docs.count()
    assert {r.length for r in rows if r.doc_id in (2, 3, 4)} == {1}
    assert P.packed(documents(spark, [])).count() == 0
