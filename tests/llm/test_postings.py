import random
import re
from hashlib import sha256

import numpy as np
import pytest

from vitals.llm import postings


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, width=10):
    wins = {}
    for item_id, text in items:
        own = words_of(text)
        for k in range(max(1, len(own) - width + 1)):
            if own:
                wins.setdefault(tuple(own[k : k + width]), set()).add("" if item_id is None else str(item_id))
    sizes = {len(w) for w in wins}
    out = []
    for doc_id, text in docs:
        own, hit, ids = words_of(text), set(), set()
        for n in sizes:
            for k in range(len(own) - n + 1):
                found = wins.get(tuple(own[k : k + n]))
                if found:
                    hit.update(range(k, k + n))
                    ids |= found
        out.append((doc_id, len(own), sorted(hit), sorted(ids)))
    return sorted(out, key=str)


def found(docs, items, width=10, segment=1 << 21, block=1 << 24):
    rows = postings.contamination(postings.index(docs, segment), items, width, block).collect()
    return sorted(((r.doc_id, r.n_words, list(r.hit), list(r.item_ids)) for r in rows), key=str)


@pytest.fixture(scope="module")
def drawn():
    rng = random.Random(3)
    vocabulary = ["a", "b", "the", "Ünï", "x1", "42", "rare", "日本語"]
    docs = [(i, " ".join(rng.choice(vocabulary[:5] if rng.random() < 0.9 else vocabulary) for _ in range(rng.randint(0, 80)))) for i in range(80)]
    docs += [(None, "the b-a; THE"), (3, None), (4, ""), (5, "?!"), (6, docs[7][1]), (6, docs[7][1])]
    items = [(i, " ".join(rng.choice(vocabulary[:6]) for _ in range(rng.randint(1, 7)))) for i in range(12)]
    items += [(20, docs[7][1]), (21, None), (22, "."), (None, "rare RARE"), (1, "second text of one"), (23, "b a the " * 4)]
    return docs, items


@pytest.mark.parametrize("width, segment, block", [(3, 1 << 21, 1 << 24), (4, 100, 1 << 24), (10, 300, 500)])
def test_contamination_against_brute_force(spark, documents, drawn, width, segment, block):
    docs, items = drawn
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    got = found(documents(docs).withColumnRenamed("extra", "term").repartition(3), asked, width, segment, block)
    assert got == brute(docs, items, width)
    assert any(hit for _, _, hit, _ in got) and any(not hit for _, n, hit, _ in got if n > 10)


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_phrases_and_words_near_each_other(documents, drawn, slop):
    docs, _ = drawn
    phrases = [["the"], ["b", "a", "the"], ["a", "a"], ["rare", "the", "x1"], ["nowhere", "a"], [], ["日本語", "b"]]
    expected = []
    for doc_id, text in docs:
        own = words_of(text)
        at = {w: [k for k, x in enumerate(own) if x == w] for w in set(own)}
        for n, phrase in enumerate(phrases):
            for start in range(-slop, len(own) + slop):
                if phrase and all(any(abs(p - start - k) <= slop for p in at.get(w, ())) for k, w in enumerate(phrase)):
                    expected.append((n, str(doc_id), start))
    index = postings.index(documents(docs), 200)
    rows = postings.matches(index, phrases, slop).collect()
    assert sorted((r.phrase, str(r.doc_id), r.start) for r in rows) == sorted(expected)


def test_many_candidates_are_compared_in_steps(documents, drawn, monkeypatch):
    docs, _ = drawn
    monkeypatch.setattr(postings, "AT_ONCE", 7)
    phrases = postings.Phrases([["a", "b"], ["b"], ["the", "a"]])
    own = [w for _, t in docs for w in words_of(t)]
    lists = [np.array([k for k, w in enumerate(own) if w == t], np.int32) for t in phrases.number]
    got = sorted((p, s) for ps, ss, _ in phrases.found(lists, np.array([0]), len(own), 0) for p, s in zip(ps.tolist(), ss.tolist()))
    assert got == sorted((n, k) for n, p in enumerate((["a", "b"], ["b"], ["the", "a"])) for k in range(len(own)) if own[k : k + len(p)] == p)


def test_every_word_is_indexed(documents, drawn):
    docs, _ = drawn
    rows = postings.index(documents(docs), 150).collect()
    starts = {(r.segment, r.doc): r for r in rows if r.term is None}
    found = {}
    for r in rows:
        if r.term is not None:
            for place in np.cumsum(np.frombuffer(r.places, np.int32)).tolist():
                found[r.segment, place] = r.term
    got = sorted((str(d.doc_id), [found[d.segment, d.start + k] for k in range(d.n_words)]) for d in starts.values())
    assert got == sorted((str(i), words_of(t)) for i, t in docs)


def test_empty_tables(spark, documents, drawn):
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(documents([]), none) == []
    assert found(documents([(1, "a b")]), none) == [(1, 2, [], [])]
    row = postings.digests(documents([(1, "a b")]), none).first()
    assert (row.n_hit, row.items_sha256, row.contaminated) == (0, sha256(b"").hexdigest(), False)
