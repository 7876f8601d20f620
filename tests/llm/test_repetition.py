import random
import re
from collections import Counter

import pytest

from vitals.llm import repetition


def brute(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    seen = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(n)}
    lines = [l for l in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", l)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        f"n_repeat_words_{n}": len(inside),
        f"repeat_chars_{n}": sum(len(words[i]) for i in inside),
    }


@pytest.mark.parametrize("n", [1, 2, 5, 8])
def test_counts_equal_brute_force(n):
    rng = random.Random(n)
    words = ["a", "b", "cé", "\U0001f600", "d#", " e"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "\n", "\t", "  ", "\x0b"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += ["", "\n\n", "one", "a b c d e f g h " * 2, "x\x1cy\x85z " * 20]
    found = repetition.measure(texts, [n])
    for i, t in enumerate(texts):
        assert {k: int(found[k][i]) for k in brute(t, n)} == brute(t, n)


def test_equal_hashes_of_different_windows_do_not_count(monkeypatch):
    monkeypatch.setattr(repetition, "mixed", lambda x: x.astype("uint64") * 0)
    texts = ["a b c d e f", "a b a b c", ""]
    found = repetition.measure(texts, [2])
    assert found["n_repeat_words_2"].tolist() == [brute(t, 2)["n_repeat_words_2"] for t in texts]


def test_verdicts(documents):
    rng = random.Random(1)
    clean = " ".join(f"w{rng.random()}" for _ in range(100))
    line = " ".join(f"v{k}" for k in range(12))
    rows = [(1, clean), (2, "too short"), (3, (line + "\n") * 12), (4, None), (5, ""), (6, clean), (6, clean), (None, clean + "\n" + line)]
    docs = documents(rows).withColumnRenamed("extra", "kept")
    found = {(r.doc_id, r.base_failed, r.kept) for r in repetition.repetition(docs).collect()}
    assert found == {(1, False, True), (2, True, False), (3, True, False), (4, True, False), (5, True, False), (6, False, True), (None, False, True)}
    assert repetition.repetition(documents([])).collect() == []


def test_a_very_long_text(documents):
    text = " ".join(f"w{i % 70_000}" for i in range(140_000))
    row = repetition.repetition(documents([(1, text)])).first()
    assert row.n_words == row.n_repeat_words_8 == 140_000
