import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from skytrace.llm import text as T
from skytrace.llm import tokencount as C
from tests.llm.helpers import documents, invented, odd_documents


def whole_tokenizer(pieces):
    """The same vocabulary in a unigram tokenizer."""
    low = float(min(s for _, s in pieces))
    vocabulary = [("<unk>", low)] + [(p, float(s)) for p, s in pieces]
    vocabulary += [(f"<0x{b:02X}>", low) for b in range(256)]
    made = Tokenizer(models.Unigram(vocabulary, 0, byte_fallback=True))
    made.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="never",
                                                  split=False)
    return made


def expected(tokenizer, texts):
    return [len(tokenizer.encode(" " + t, add_special_tokens=False).ids) if t else 0 for t in texts]


def test_counts_of_the_public_vocabulary(spark):
    draw = random.Random(1)
    texts = ["".join(draw.choice("ab \n\té😀thez.") for _ in range(draw.randrange(40)))
             for _ in range(400)]
    texts += invented(50) + ["", " ", "  a  b ", "日本語 テスト", "a" * 500, "x\n\n y\r\n"]
    rows = C.counts(documents(spark, list(enumerate(texts)))).collect()
    found = [r.n_tokens for r in sorted(rows, key=lambda r: r.doc_id)]
    assert found == expected(whole_tokenizer(C.load()), texts)


@pytest.mark.parametrize("seed", range(4))
def test_ties_of_tiny_vocabularies(seed):
    draw = random.Random(seed)
    pieces = {"▁" + "".join(draw.choice("ab") for _ in range(draw.randint(0, 2))) for _ in range(4)}
    pieces |= {"".join(draw.choice("abc") for _ in range(draw.randint(1, 4))) for _ in range(14)}
    scored = [(p, -draw.randint(1, 3)) for p in sorted(pieces)]
    texts = ["".join(draw.choice("abcd ") for _ in range(draw.randrange(14))) for _ in range(400)]
    tokenizer = whole_tokenizer(scored)
    _, found = C.Segmenter(scored).totals(*T.buffer_of(pa.array(texts)))
    assert found.tolist() == expected(tokenizer, texts)


def test_memory_of_parts_is_bounded():
    texts = invented(40)
    pieces = C.load()
    small = C.Segmenter(pieces, remembered=10)
    large = C.Segmenter(pieces)
    for i in range(0, 40, 10):
        part = T.buffer_of(pa.array(texts[i:i + 10]))
        assert (small.totals(*part) == large.totals(*part)).all()


def test_pieces_across_spaces_are_refused():
    with pytest.raises(ValueError):
        C.Segmenter([("a▁b", -1)])


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = C.counts(docs).collect()
    assert len(rows) == docs.count()
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {0}
    assert C.counts(documents(spark, [])).count() == 0
