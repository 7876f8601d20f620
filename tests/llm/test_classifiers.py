import zlib

import numpy as np
import pytest

from vitals.llm import learning, quality, toxicity
from vitals.llm.tables import held_out

ROOT = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{ROOT}/documents.parquet").cache(), spark.read.parquet(f"{ROOT}/labels.parquet").cache()


@pytest.mark.parametrize("module, label, least", [(quality, "quality", 0.99), (toxicity, "toxic", 0.97)])
def test_accuracy_on_held_out_rows(tables, module, label, least):
    docs, labels = tables
    found = module.judged(docs, labels)
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").filter("held_out").select("score", label).collect()
    scores, truth = np.array([r.score for r in rows]), np.array([r[label] for r in rows])
    assert len(rows) > 500 and learning.auc(scores, truth) >= least


def test_held_out_rows_are_those_of_the_checksum(spark):
    df = spark.range(200)
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in df.select("id", held_out(df.id).alias("h")).collect())


def test_the_sample_is_bounded_and_never_held_out(spark, tables):
    docs, labels = tables
    rows = learning.labelled_sample(docs.union(docs), labels, "quality", 100, 2000)
    assert 0 < len(rows) <= 100 and all(len(t) <= 2000 for t, _ in rows)
    learned = {t for i, t in docs.select("doc_id", "text").collect() if zlib.crc32(str(i).encode()) % 5}
    assert all(t in learned for t, _ in rows)


def test_scores_do_not_depend_on_anything_but_the_text(spark, documents):
    net = quality.train([("GOOD text here. " * 9, 1), ("%%% ### bad", 0)] * 20, epochs=2)
    tox = toxicity.train([("you are an idiot " * 3, 1, "en"), ("you are a good person", 0, "en")] * 20, epochs=2)
    rows = [(1, "some text " * 200), (1, "some text " * 200), (None, None), (3, ""), (4, " \n"), (5, "x"), (6, "é" * 5000)]
    for module, network in ((quality, net), (toxicity, tox)):
        scores = [r.score for r in module.scored(documents(rows).withColumnRenamed("extra", "score"), network).collect()]
        assert len(scores) == len(rows) and all(0 <= s <= 1 for s in scores)
        assert scores[0] == scores[1] and scores[2] == scores[3] == 0.0
        assert module.scored(documents([]), network).collect() == []


def test_chunks_cover_every_byte():
    for n in (1, 5, 511, 512, 513, 1000, 5000):
        raw = bytes(i % 251 for i in range(n))
        pairs = quality.chunked(raw)
        assert ((pairs[:, :-1] & 255) == (pairs[:, 1:] >> 8)).all()
        data = np.concatenate([pairs >> 8, pairs[:, -1:] & 255], 1)
        assert data.shape[1] == quality.CHUNK
        if n >= quality.CHUNK:
            starts = [*range(0, n - quality.CHUNK, quality.HOP), n - quality.CHUNK]
            assert all(bytes(d.astype(np.uint8)) == raw[s : s + quality.CHUNK] for d, s in zip(data, starts, strict=True))
            assert all(b - a <= quality.CHUNK for a, b in zip(starts, starts[1:]))


def test_a_bad_passage_anywhere_in_a_long_text_tells():
    rng = np.random.default_rng(1)
    good = lambda: " ".join(rng.choice(["river", "stone", "cloud", "walks", "there"], 40))
    rows = [(good(), 1) for _ in range(150)] + [(good() + " " + "$%$#@ " * 30, 0) for _ in range(150)]
    net = quality.train(rows, epochs=4)
    long = " ".join(good() for _ in range(40))
    assert net.probabilities([long])[0] > net.probabilities([long + " $%$#@ " * 60])[0]


def test_no_rows_or_one_class():
    assert 0 <= quality.train([]).probabilities(["a"])[0] <= 1
    assert toxicity.train([]).scorer()("a") <= 1
    assert quality.train([("abc", 1)] * 5, epochs=1).probabilities(["abc"])[0] > 0.5


def test_thresholds_by_language():
    scores = [(k / 1000, 0, "en") for k in range(900)] + [(0.1, 0, "de")] * 100 + [(0.9, 1, "de")] * 10 + [(0.99, 0, "fr")] * 3
    found = toxicity.calibrated(scores)
    assert found["de"] == toxicity.THRESHOLD and found["en"] > 0.85 and "fr" not in found and "" in found


def test_flags_use_the_threshold_of_the_language(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0.6, "en"), (0.6, "de"), (0.6, None), (0.8, "de")], "s double, l string")
    flags = [r[0] for r in df.select(toxicity.flagged(F.col("s"), F.col("l"), {"": 0.5, "de": 0.7})).collect()]
    assert flags == [True, False, True, True]


def plain_quality(net, text):
    """The score in loops over bytes."""
    raw = text.encode()
    if not raw:
        return 0.0
    if len(raw) < quality.CHUNK:
        raw = (raw * quality.CHUNK)[: quality.CHUNK]
    last = len(raw) - quality.CHUNK
    chunks = [raw[s : s + quality.CHUNK] for s in [*range(0, last, quality.HOP), last]]
    vectors, filters = net.embedding.astype(float), net.filters.astype(float)
    pooled = []
    for chunk in chunks:
        best = np.full(quality.FILTERS, -np.inf)
        for p in range(len(chunk) - quality.WIDTH + 1):
            best = np.maximum(best, sum(vectors[chunk[p + w]] @ filters[w] for w in range(quality.WIDTH)))
        pooled.append(np.maximum(best + net.bias, 0))
    features = np.concatenate([np.max(pooled, 0), np.mean(pooled, 0), [1]])
    return float(1 / (1 + np.exp(-(features @ net.weights.astype(float)))))


def plain_toxicity(net, text):
    """The score in loops over words."""
    words = text.encode().split()
    if not words:
        return 0.0
    side = [np.zeros(toxicity.EMBEDDED)] * (toxicity.WIDTHS[-1] - 1)
    own = [sum((net.embedding[r].astype(float) for b in toxicity.features(w) if (r := net.row.get(b))), np.zeros(toxicity.EMBEDDED)) for w in words]
    vectors = side + own + side
    hidden = []
    for width in toxicity.WIDTHS:
        windows = [sum(vectors[p + k] @ net.filters[width][k].astype(float) for k in range(width)) for p in range(len(vectors) - width + 1)]
        hidden += np.maximum(np.max(windows, 0) + net.bias[width], 0).tolist()
    return float(1 / (1 + np.exp(-(np.array(hidden) @ net.weights[:-1].astype(float) + net.weights[-1]))))


def test_scores_equal_those_of_plain_loops(tables):
    docs, labels = tables
    rows = docs.join(labels, "doc_id").orderBy("doc_id").limit(400).select("text", "quality", "toxic", "lang").collect()
    texts = [r.text or "" for r in rows]
    net = quality.train([(t, r.quality) for t, r in zip(texts, rows)], epochs=1)
    tox = toxicity.train([(t, r.toxic, r.lang) for t, r in zip(texts, rows)], epochs=1)
    odd = ["", "x", "\u00e9" * 700, "$" * 511 + "ab", " ".join(texts[:3])]
    score = tox.scorer()
    assert np.allclose(net.probabilities(odd + texts[:4]), [plain_quality(net, t) for t in odd + texts[:4]], atol=1e-4)
    assert np.allclose([score(t) for t in odd + texts[:40]], [plain_toxicity(tox, t) for t in odd + texts[:40]], atol=1e-4)


@pytest.mark.parametrize("offset", [0, 1])
def test_bad_passages_tell_at_even_and_odd_bytes(offset):
    rng = np.random.default_rng(2)
    words = ["river", "stone", "cloud", "walks", "there", "of"]
    good = lambda n: " ".join(rng.choice(words, n))
    rows = [(good(60), 1) for _ in range(200)] + [(good(40) + " " + "$%$#@ " * 6 + good(20), 0) for _ in range(200)]
    net = quality.train(rows, epochs=6)
    for _ in range(20):
        left = good(900)
        left = left[: len(left) // 2 * 2 + offset]
        clean, bad = net.probabilities([left + " " + good(30), left + " " + "$%$#@ " * 6 + good(20)])
        assert bad < clean


class Noted(Exception):
    pass


@pytest.mark.parametrize(
    "module, rows",
    [
        (quality, [("some good text " * 50, 1), ("$%& bad " * 90, 0), ("short", 1), ("plain words " * 70, 0)]),
        (toxicity, [("you fool " * 3 + "x", 1, "en"), ("you are kind", 0, "en"), ("fool of a dog", 1, "en"), ("kind dog", 0, "en")] * 3),
    ],
)
def test_gradients_equal_differences(monkeypatch, module, rows):
    """The first step's gradients against the change of the loss."""
    seen = {}

    class Note:
        def __init__(self, parameters, rate):
            seen["parameters"] = parameters

        def update(self, gradients):
            seen["gradients"] = gradients
            raise Noted

    monkeypatch.setattr(module, "Adam", Note)
    nets = []
    build = module.Network
    monkeypatch.setattr(module, "Network", lambda *a: nets.append(build(*a)) or nets[-1])
    with pytest.raises(Noted):
        module.train(rows, batch=len(rows))
    net, gradients, parameters = nets[0], seen["gradients"], seen["parameters"]
    plain = plain_quality if module is quality else plain_toxicity
    chosen = [r[:2] for r in rows]

    def loss():
        return -np.mean([np.log(p if y else 1 - p) for p, y in ((plain(net, t), y) for t, y in chosen)])

    rng = np.random.default_rng(4)
    for name, values in parameters.items():
        own = gradients[name].astype(float) - (1e-4 * values if module is quality and name == "weights" else 0)
        flat = np.flatnonzero(np.abs(own.ravel()) > 1e-3)
        for at in rng.permutation(flat)[:4]:
            old, step = values.flat[at], 2e-3
            values.flat[at] = old + step
            up = loss()
            values.flat[at] = old - step
            down = loss()
            values.flat[at] = old
            assert np.isclose((up - down) / (2 * step), own.flat[at], rtol=0.1, atol=1e-3), (name, at)


@pytest.fixture(scope="module")
def marked(spark):
    """More labelled rows than the former sample held, some longer than it took; a third of the marks mislead."""
    rng = np.random.default_rng(5)
    plain = ["river", "stone", "cloud", "walks", "there", "of", "lantern", "meadow"]
    rows = []
    for i in range(7000):
        words = rng.choice(plain, 12).tolist()
        toxic = int(rng.random() < 0.3)
        if toxic or rng.random() < 0.1:
            words[rng.integers(12)] = str(rng.choice(["vile", "wretch"]))
        # A word that only long texts hold.
        text = " ".join(words) if i % 100 else "river " * 4000 + ("scoundrel " if toxic else "")
        rows.append((i, text, [None, "en", "de", "xx"][i % 4] if i > 200 else "fr", toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    return df.drop("toxic"), df.select("doc_id", "toxic"), rows


def test_every_labelled_row_is_learned_from(marked):
    docs, labels, rows = marked
    net = toxicity.fit(docs, labels, epochs=1, shard_rows=10_000)
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    assert len(learned) > 5_000 and any(len(r[1]) > 20_000 for r in learned)
    words, truth = [r[1].encode().split() for r in learned], np.array([r[3] for r in learned])
    assert sorted(net.row) == sorted(toxicity.telling(words, truth))
    assert toxicity.features(b"scoundrel")[0] in net.row
    score = net.scorer()
    expected = toxicity.calibrated([(score(t), y, lang) for _, t, lang, y in learned])
    assert net.thresholds == expected and max(expected.values()) > toxicity.THRESHOLD and "en" in expected


def test_one_shard_equals_training_in_one_process(marked):
    docs, labels, rows = marked
    net = toxicity.fit(docs, labels, epochs=2, shard_rows=10_000)
    ordered = learning.labelled_rows(docs, labels, "toxic", ("lang",)).orderBy("order", "id", "label", "tie")
    plain = toxicity.train([(r.text, r.label, r.lang) for r in ordered.collect()], epochs=2)
    assert net.row == plain.row and net.thresholds == plain.thresholds
    assert all((a == b).all() for a, b in zip(net.parameters().values(), plain.parameters().values()))


def test_shards_hold_every_row_and_do_not_depend_on_partitions(spark, marked):
    docs, labels, rows = marked
    given = learning.labelled_rows(docs, labels, "toxic", ("lang",))
    held = toxicity.coded(given, {b: 1 for b in toxicity.features(b"vile")}, 9).collect()
    assert sorted(r.id for r in held) == [r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    assert {r.shard for r in held} == set(range(9))
    runs = [
        toxicity.fit(d, labels, epochs=2, shard_rows=700) for d in (docs.repartition(3), docs.repartition(7, "lang"))
    ]
    assert all((a == b).all() for a, b in zip(runs[0].parameters().values(), runs[1].parameters().values()))
    assert runs[0].thresholds == runs[1].thresholds
    score = runs[0].scorer()
    out = [r for r in rows if not zlib.crc32(str(r[0]).encode()) % 5]
    assert learning.auc(np.array([score(r[1]) for r in out]), np.array([r[3] for r in out])) > 0.9


def test_long_shards_come_in_several_runs():
    import pyarrow as pa

    def batch(*rows):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["shard", "ids", "label"])

    given = [batch((0, b"ab", 1), (0, b"c", 0), (1, b"d", 1)), batch((1, b"e", 0), (1, b"f", 1), (2, b"long" * 9, 0))]
    found = list(toxicity.shard_runs(given, 2, 10))
    assert found == [(0, [b"ab", b"c"], [1, 0]), (1, [b"d", b"e"], [1, 0]), (1, [b"f"], [1]), (2, [b"long" * 9], [0])]


@pytest.mark.parametrize("rows", [[], [(1, "vile", None)], [(1, None, 1), (2, "", 0)], [(1, "x", 1)] * 3])
def test_tables_without_much_to_learn(spark, rows):
    df = spark.createDataFrame([(i, t, "en", y) for i, t, y in rows], "doc_id long, text string, lang string, toxic int")
    net = toxicity.fit(df.drop("toxic"), df.select("doc_id", "toxic"))
    assert 0 <= net.scorer()("some text") <= 1
