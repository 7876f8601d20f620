import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import regex

from vitals.llm import spelling


def brute_vocabulary(rows, error_rate=31, least=7):
    counts = Counter()
    for doc_id, text in rows:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % error_rate == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2 and len(w) >= least}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute_variants(counts, ratio=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("chars, small", [(40, 64), (1 << 14, 64), (1 << 14, 0)])
def test_variants_against_brute_force(spark, chars, small, monkeypatch):
    monkeypatch.setattr(spelling, "SMALL", small)
    rng = random.Random(chars)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))): rng.choice([2, 3, 30, 400, 5000]) for _ in range(300)}
    words |= {"x" * n: 10**n for n in range(1, 7)} | {"\U0001f600bcd": 7, "bcd": 700, "a一cd": 7}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(spelling.variants(frame, chars=chars)) == brute_variants(words)


def test_vocabulary_against_brute_force(spark, documents, monkeypatch):
    rng = random.Random(2)
    pool = ["Straßenbahn", "naïveté-Übermut", "ÀÉÎÕÜabc×÷", "hyphen-ated words", "tiny", "ĀĀlongerword", "İstanbulese", "ªword¿s", "ſtreetlamp"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(40))) for i in range(120)] + [(None, "Straßenbahn " * 3), (5, None), (6, ""), (7, "z" * 50_000 + " " + "z" * 50_000)]
    for rate in (31, 2):
        found = {r.word: r.n for r in spelling.vocabulary(documents(rows), error_rate=rate).collect()}
        assert found == brute_vocabulary(rows, rate)


def test_tasks_pass_on_full_counters(spark, documents):
    rows = [(i, " ".join(f"word{chr(97 + i % 26)}{chr(97 + k)}xyz" for k in range(26))) for i in range(200)]
    assert {r.word: r.n for r in spelling.vocabulary(documents(rows * 2)).collect()} == brute_vocabulary(rows * 2)


def test_prefix_and_suffix_identify_single_edits():
    rng = random.Random(5)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) for _ in range(80)]
    near = spelling.near_pairs(*spelling.aligned(words), *[np.arange(len(words))] * 2)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            if a != b:
                assert near[i, j] == one_edit(a, b), (a, b)


def test_no_words_and_clashing_columns(spark, documents):
    assert spelling.spelling_variants(documents([])).collect() == []
    assert spelling.spelling_variants(documents([(1, None), (None, "")])).collect() == []
    docs = documents([(i, "Repetition repetitian") for i in range(12)]).withColumnRenamed("extra", "word")
    assert sum(r.n for r in spelling.spelling_variants(docs).collect()) <= 24


def test_a_hot_block_is_cut_into_bounded_tiles(spark):
    words = spark.createDataFrame([(f"common{i:05d}", i + 2) for i in range(3000)], "word string, n long")
    sizes = [r["count"] for r in spelling.tiles(words, 2200).groupBy(*spelling.KEYS).count().collect()]
    assert max(sizes) < 2 * 2 * 2200 / 12
    found = {r.word: r.n_near for r in spelling.near_words(words, 2200).collect()}
    assert found["common00000"] == 9 * 3 + 2 and len(found) == 3000
