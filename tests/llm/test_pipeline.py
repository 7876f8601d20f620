import re

import public_tokenizers
import pytest
from compare import compare, duck
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from vitals.llm import mixing, pii, quality, simhash
from vitals.llm.oracle import ORACLE_SQL
from vitals.llm.tables import stored

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert compare(entry.queries()[name](spark, SF), duck(SF), ORACLE_SQL[name]) == []


def test_one_query_per_operator():
    numbers = [int(m[1]) for name in entry.queries() if (m := re.match(r"op(\d+)_", name))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()


def components(links, nodes):
    """Each node's smallest node reachable over links."""
    root = {i: i for i in nodes}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in nodes}


def test_the_pipeline_equals_its_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    network = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [r for r in docs.collect() if network.probabilities([r.text or ""])[0] >= quality.THRESHOLD]
    near = corpus_pipeline.NEAR
    prints = {r.doc_id: simhash.fingerprints(r.text or "", near["width"], near["families"]) for r in rows}
    words = {r.doc_id: (r.text or "").encode().lower().split() for r in rows}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    pairs = [(a, b) for a in sets for b in sets if a < b]
    proposed = [
        components([(a, b) for a, b in pairs if (prints[a][k] ^ prints[b][k]).bit_count() <= near["threshold"]], sets)
        for k in range(near["families"])
    ]
    meet = [(a, b) for a, b in pairs if any(p[a] == p[b] for p in proposed)]
    similar = [(a, b) for a, b in meet if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    least = components(similar, sets)
    kept = {r.doc_id: r for r in rows if least[r.doc_id] == r.doc_id}
    frame = spark.createDataFrame(list(kept.values()), docs.schema)
    texts = {r.doc_id: r.text for r in pii.redact(frame).collect()}
    mixed = mixing.replicate(frame.drop("text").join(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "doc_id"))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = sorted((r.doc_id, r.source, library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids) for r in mixed.collect())
    found = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.source, r.ids) for r in found) == expected
    assert all(r.decodes and r.n_tokens == len(r.ids) for r in found)


def test_stages_keep_the_columns_and_take_nulls_copies_and_empty_tables(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    text = "Words of a clean and ordinary sentence, written to me@x.org. " * 8
    rows = [(1, text, "en", "s", 9), (2, text, "en", None, None), (3, None, None, "s", 0), (4, "", "en", "s", 0), (None, text, "en", "s", 1), (5, "ab cd " * 9000, "en", "t", 1)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = docs.withColumn("_score", docs.n_chars)
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), name)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == corpus_pipeline.COLUMNS
        docs.collect()


def test_personal_data_leaves_the_texts(spark):
    docs = spark.createDataFrame([(1, "write to me@x.org", "en", "s", 17)], "doc_id long, text string, lang string, source string, n_chars long")
    row = corpus_pipeline.personal_data_stage(spark, docs, SF).first()
    assert (row.text, row.n_chars) == ("write to [EMAIL]", 16)
