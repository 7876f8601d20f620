import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vitals.llm import components, simhash


def brute_fingerprint(text, width):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_equal_brute_force():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["The", "Été", "ox", "a b", "\x1cz"]) for _ in range(n)) for n in range(40)]
    for t in texts + ["", "\t\n", "one", "One  two\nthree"]:
        for width in (1, 4):
            assert simhash.fingerprint(t, width) == brute_fingerprint(t, width)


@pytest.mark.parametrize("bits", [3, 8, 13])
def test_the_code_covers_every_value_within_one_bit(bits):
    code = simhash.CoveringCode(bits)
    x = np.arange(1 << bits, dtype=np.uint64)
    home = code.home(x)
    assert (np.bitwise_count(home ^ x) <= 1).all() and (code.syndrome(home) == 0).all()
    words = np.unique(home)
    for radius in (0, 1, 2):
        rows, found = code.within(x, radius)
        expected = {(i, w) for i in range(len(x)) for w in words.tolist() if (i ^ w).bit_count() <= radius}
        assert len(rows) == len(expected) and set(zip(rows.tolist(), found.tolist())) == expected


@pytest.mark.parametrize("cell, threshold, parts", [(simhash.CELL, 4, 3), (20, 4, 3), (simhash.CELL, 7, 4), (7, 2, 2)])
def test_links_connect_what_brute_force_connects(spark, cell, threshold, parts):
    rng = random.Random(threshold)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for f in fps[:12]:  # chains and dense groups around some of them
        for _ in range(25):
            for b in rng.sample(range(64), rng.randint(1, threshold + 1)):
                f ^= 1 << b
            fps.append(f)
    center = fps[0]
    fps += [center ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)]
    fps = sorted(set(fps))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = simhash.links(simhash.cells(simhash.anchored(frame, threshold, parts), cell), threshold).collect()
    for r in links:
        assert ((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= 64
    near = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= threshold]
    assert classes([(r.u, r.v) for r in links], signed) == classes(near, signed)
    assert len(links) < len(signed) * 60  # no pairs of a dense group


def test_components_of_random_graphs_and_a_long_chain(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(200)]
    links += [(5, 5), (7, 8), (8, 7)]
    frame = spark.createDataFrame(links, "u long, v long")
    found = {r.u: r.v for r in components.components(frame).collect()}
    nodes = {n for link in links for n in link}
    assert {n: found.get(n, n) for n in nodes} == classes(links, nodes)
    assert components.components(frame.limit(0)).collect() == []


def test_documents_with_nulls_copies_and_no_words(spark, documents):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(9, text), (4, text.upper()), (7, text), (7, text), (2, None), (3, ""), (1, "\n"), (5, "other words here now then"), (None, text)]
    docs = documents(rows).withColumnRenamed("extra", "fp")
    found = sorted((str(r.doc_id), r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert found == sorted([("9", 4), ("4", 4), ("7", 4), ("7", 4), ("None", 4), ("2", 1), ("3", 1), ("1", 1), ("5", 5)])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5]
    assert [r.doc_id for r in simhash.one_of_each(documents([(None, "a b"), (None, "a b")])).collect()] == [None]
    assert simhash.near_duplicates(documents([])).collect() == []
    assert simhash.one_of_each(documents([])).collect() == []


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = {r.doc_id: brute_fingerprint(r.text or "", 4) for r in rows}
    ids = sorted(fps)
    near = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (fps[a] ^ fps[b]).bit_count() <= 4]
    expected = classes(near, ids)
    for r in simhash.classes(docs).collect():
        assert (r.fingerprint, r.component_id) == (f"{fps[r.doc_id]:016x}", expected[r.doc_id])


def test_one_hot_group_of_copies(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the hot text again").otherwise(F.concat(F.lit("text number "), F.col("id") * 7919)).alias("text"))
    hot = [r.component_id for r in simhash.near_duplicates(docs).filter("doc_id % 3 = 0").collect()]
    assert len(hot) == 1000 and set(hot) == {0}


def test_only_texts_that_share_enough_shingles_are_removed(spark, documents):
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(300)]

    def edited(n):
        words = list(base)
        for k in rng.sample(range(0, 300, 6), n):
            words[k] = f"e{rng.randint(0, 9999)}"
        return " ".join(words)

    rows = [(i, edited(i % 30)) for i in range(120)] + [(500, ""), (501, "\n"), (502, "one two"), (503, "One two"), (504, "one three")]
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in rows for w in [t.lower().split()]}
    prints = {i: simhash.fingerprint(t, 2) for i, t in rows}
    bits = [(a, b) for a in sets for b in sets if a < b and (prints[a] ^ prints[b]).bit_count() <= 7]
    candidate = classes(bits, sets)
    near = [(a, b) for a in sets for b in sets if a < b and candidate[a] == candidate[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    expected = {a for a, b in classes(near, sets).items() if a == b}
    assert len(expected) > len({b for b in candidate.values()})
    docs = documents(rows)
    assert {r.doc_id for r in simhash.one_of_each(docs, 2, 7, 4).collect()} == expected
    cut = spark.createDataFrame([(1, i, t, 4000) for i, t in rows], "root long, text_hash long, text string, bytes long")
    links = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for side in (1000, 4000):
        found = simhash.text_links(cut, side=side).collect()
        assert classes([(r.u, r.v) for r in found], sets) == classes(links, sets)


def brute_mixed(h, family):
    if family == 0:
        return h
    h = (h + 0x9E3779B97F4A7C15 * family) % 2**64
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    h = (h ^ h >> 27) * 0x94D049BB133111EB % 2**64
    return h ^ h >> 31


def test_families_of_fingerprints_equal_brute_force():
    text = " ".join(f"word{i % 17} and{i}" for i in range(60))
    hashes = [int(h) for h in simhash.shingles(text, 2)]
    for k, found in enumerate(simhash.fingerprints(text, 2, 4)):
        mixed = [brute_mixed(h, k) for h in hashes]
        assert found == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in mixed) > len(mixed))
    assert simhash.fingerprints("", 2, 3) == [0, 0, 0]


def test_every_family_proposes(spark, documents):
    rng = random.Random(5)
    rows, sets = [], {}
    for group in range(40):
        base = [f"w{rng.randint(0, 9999)}" for _ in range(120)]
        for _ in range(3):
            words = list(base)
            for k in rng.sample(range(5, 115, 10), rng.randint(0, 3)):
                words[k] = f"e{rng.randint(0, 9999)}"
            rows.append((len(rows), " ".join(words)))
            sets[len(sets)] = {tuple(words[k : k + 5]) for k in range(116)}
    near = [(a, b) for a in sets for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    prints = {i: simhash.fingerprints(t, 2, 3) for i, t in rows}

    def expected(families):
        proposed = [classes([(a, b) for a in sets for b in range(a) if (prints[a][k] ^ prints[b][k]).bit_count() <= 7], sets) for k in range(families)]
        return {a for a, b in classes([(a, b) for a, b in near if any(p[a] == p[b] for p in proposed)], sets).items() if a == b}

    for families in (1, 3):
        assert {r.doc_id for r in simhash.one_of_each(documents(rows), 2, 7, 4, families).collect()} == expected(families)
    everything = {a for a, b in classes(near, sets).items() if a == b}
    assert len(expected(3)) < len(expected(1)) and len(expected(3) - everything) <= 2


def test_columns_may_have_any_names(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(i, text, i, i, i, i, i, i) for i in range(3)], "doc_id long, text string, _n int, _hash int, hash int, root int, text_hash int, nth int")
    (row,) = simhash.one_of_each(docs).collect()
    assert tuple(row) == (0, text, 0, 0, 0, 0, 0, 0)
