import random
import sys

import numpy as np

from vitals.llm import learning, toxicity
from vitals.llm.wordhash import BUCKETS, LONGEST, MOST_STRIPPED, PER_WORD, PREFIXES, features, hashed


def plain(texts):
    """Features word by word."""
    own = [[features(w) for w in t.split()] for t in texts]
    rows = [f + [BUCKETS] * (PER_WORD - len(f)) for words in own for f in words]
    return np.array(rows, np.int32).reshape(-1, PER_WORD), np.cumsum([0, *map(len, own)])


def same(texts):
    found, edges = hashed(texts)
    rows, bounds = plain(texts)
    return found.shape == rows.shape and (found == rows).all() and edges.tolist() == bounds.tolist()


def test_words_are_hashed_as_one_by_one():
    n = MOST_STRIPPED
    odd = ["", " ", "...", "-" * n, "-" * (n + 1), "(" * n + "a" + "!" * n, "(" * (n + 1) + "a", "a" + "." * (n + 1)]
    odd += ["X" * k for k in (*PREFIXES, PREFIXES[-1] + 1, LONGEST - 1, LONGEST, LONGEST + 1, 5000)]
    odd += ["a\x00b", "a\x0bb\x0cc", "a\u00a0b\u2028c\x1cd\x85e", "ÉTÉ Über \U0001f600", "\ta\r\n b "]
    given = [t.encode() for t in odd]
    assert same([]) and same(given) and all(same([t]) and same([t, b"", t]) for t in given)


def test_made_up_texts_are_hashed_as_word_by_word():
    rng = random.Random(3)
    letters = ["a", "Z", "b", "-", ".", "(", "#", " ", "\n", "\x0b", "É", "\u2028", "\x1c"]
    for _ in range(300):
        some = ["".join(rng.choices(letters, [6, 4, 6, 1, 1, 1, 1, 3, 1, 1, 1, 1, 1], k=rng.choice([0, 1, 9, 90]))) for _ in range(4)]
        assert same([t.encode() for t in some])


def network(row):
    return toxicity.started(row, 0.3, np.random.default_rng(8))


def test_work_does_not_grow_with_the_words_that_differ():
    """Words that no text before had cost no call of Python each."""
    score = network({features(b"word7")[0]: 1}).scorer()
    text = " ".join(f"word{i}" for i in range(20_000))
    score("word")
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        score(text)
    finally:
        sys.setprofile(None)
    assert calls < 2_000


def test_scores_are_the_same_together_and_alone():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    net = network({b: i for i, b in enumerate(sorted({features(w.encode())[0] for w in words[:12]}), 1)})
    given = [" ".join(rng.choices(words, k=rng.choice([0, 1, 2, 3, 30]))) for _ in range(400)] + ["w1", "", "\n", "w2 w3"]
    score = net.scorer()
    assert net.scores()(given).tolist() == [score(t) for t in given]
    assert len({*map(score, given)}) > 100 and score("") == 0.0 < score("other")


def test_coded_texts_score_as_their_texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    net = network({b: i for i, b in enumerate(sorted({features(w.encode())[0] for w in words[:4]}), 1)})
    given = [" ".join(rng.choices(words, k=rng.choice([0, 1, 2, 5, 60]))) for _ in range(200)]
    ids, known = toxicity.coder(net.row)([t.encode() for t in given])
    assert known.tolist() == [bool(t) for t in given] and sum(map(len, ids)) < sum(len(t.split()) for t in given)
    found = net.probabilities(np.concatenate(ids), np.cumsum([0, *map(len, ids)]))
    assert np.where(known, found, 0.0).tolist() == net.scores()(given).tolist()


def test_buckets_are_counted_once_a_text(spark):
    texts = ["Vile vile, vile!", "", " ", "a vile dog", "dog " * 500 + "-" * 90 + " " + "x" * 200, None] * 3
    df = spark.createDataFrame([(i, t, "en", i % 2) for i, t in enumerate(texts)], "doc_id long, text string, lang string, toxic int")
    rows = learning.labelled_rows(df.drop("toxic"), df.select("doc_id", "toxic"), "toxic")
    expected = {}
    for r in rows.select("text", "label").collect():
        for b in {b for w in r.text.encode().split() for b in features(w)} | {BUCKETS}:
            expected.setdefault(b, [0, 0])[r.label] += 1
    assert {r.bucket: [r.harmless, r.toxic] for r in toxicity.bucket_counts(rows).collect()} == expected
