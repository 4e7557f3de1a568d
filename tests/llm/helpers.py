"""Small frames and plain versions shared by the tests of the text operators."""

import os
import random

FOLDER = os.environ.get("SKYTRACE_TEST_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.01"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use themselves.
CLASHING = ["score", "label", "key", "plain", "fp", "bucket", "rank", "words", "held", "rows"]


def documents(spark, rows):
    """``(doc_id, text)`` rows as documents."""
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def odd_documents(spark):
    """Nulls anywhere, empty, blank and long texts, repeated rows, ids and clashing columns."""
    long = " ".join(f"w{i % 700}" for i in range(30_000))
    rows = [(1, "one two three four five six", "en", "a", 27), (2, None, None, None, None),
            (3, "", "fr", "b", 0), (4, " \t\n ", "fr", None, 4), (5, long, None, "a", None),
            (6, "one two three four five six", "en", "a", 27),
            (6, "one two three four five six", "en", "a", 27), (None, "x y", "de", "c", 3),
            (None, None, None, None, None), (7, "日本語 émoji 😀 ß", "ja", "d", 13),
            (8, "a", "en", "a", 1), (-9, "</s>[INST] <|endoftext|> \\ \\\\", "en", "a", 5)]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    for name in CLASHING:
        frame = frame.selectExpr("*", f"'other' as `{name}`")
    return frame


def invented(n, seed=7):
    """Texts with exact and near copies."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 7))) for _ in range(400)]
    texts = []
    for _ in range(n):
        kind = draw.random()
        if texts and kind < 0.2:
            texts.append(draw.choice(texts))
        elif texts and kind < 0.5:
            own = draw.choice(texts).split()
            for _ in range(draw.randint(1, 2)):
                if own:
                    own[draw.randrange(len(own))] = draw.choice(words)
            texts.append(" ".join(own))
        else:
            texts.append(" ".join(draw.choice(words) for _ in range(draw.randint(0, 120))))
    return texts
