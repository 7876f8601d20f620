import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitals.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a  b", "a <|endoftext|> b<|endoftext|>", "<|endoftext|>", " a ", "\n\nx\t y  ", "don't we'll 'S",
    "a b  c　　d\x85e\x1cf", "Été 你好 \U0001f600\U0001f600 x", "a" * 5000, "ab" * 3000 + " " * 700, "\0a\0 b", "1234 567,89",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(n, seed=5):
    rng = random.Random(seed)
    letters = list("abcdeth  \n\t.,'!<|>0129éß你\U0001f600 _-")
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_ids_and_texts_equal_the_library(library):
    mine = bpe.load(PATH)
    for text in ODD + random_texts(2000):
        ids = library.encode(text, add_special_tokens=False).ids
        assert mine.encode(text).tolist() == ids
        assert mine.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_code_point_of_the_first_planes(library):
    mine = bpe.load(PATH)
    points = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000] + list(range(0x3000, 0x20000, 37))
    for c in points:
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}b 1{chr(c)} {chr(c)}{chr(c)}!"
            assert mine.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_memo_that_overflows_changes_nothing(library):
    small = bpe.Bpe(PATH)
    small.words.most = small.chunks.most = 3
    for text in random_texts(100):
        assert small.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_decoding_part_of_a_character(library):
    ids = library.encode("\U0001f600", add_special_tokens=False).ids[:1]
    assert bpe.load(PATH).decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_frames_with_nulls_repeats_and_clashing_columns(spark, documents):
    docs = documents([(1, None), (2, ""), (None, "the same"), (3, "the same"), (3, "the same")]).withColumn("ids", F.lit("old"))
    coded = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert coded.columns == ["doc_id", "text", "extra", "ids", "decoded"]
    found = [(r.doc_id, len(r.ids), r.decoded) for r in coded.collect()]
    assert sorted(found, key=str) == sorted([(1, 0, ""), (2, 0, ""), (None, 2, "the same"), (3, 2, "the same"), (3, 2, "the same")], key=str)
    assert bpe.round_trip(docs, PATH).columns == ["doc_id", "extra", "ids", "decoded"]
    assert bpe.digests(documents([]), PATH).collect() == []
