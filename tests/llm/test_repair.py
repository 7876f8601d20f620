import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vitals.llm import repair

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=400), st.integers(2, 4), st.integers(1, 8))
def test_expansion_restores_any_sequence(ids, least, rounds):
    ids = np.array(ids, np.uint32)
    rules, sizes, symbols = repair.compress(ids, 10, rounds, least)
    assert (repair.expand(rules, 10, symbols) == ids).all()
    assert [len(repair.expand(rules, 10, np.array([10 + k], np.uint32))) for k in range(len(rules))] == sizes.tolist()


def test_repeats_are_compressed_and_ranges_read_alone():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    rules, sizes, symbols = repair.compress(ids, 100)
    assert len(symbols) + 3 * len(rules) < len(ids) / 8
    block = {"rules": rules.tobytes(), "lengths": sizes.astype("<u4").tobytes(), "symbols": symbols.tobytes(), "base": 100}
    for a, b in ((0, 0), (0, 1), (17, 18), (123, 4567), (19_990, 20_000), (0, 20_000)):
        assert (repair.read_range(block, a, b) == ids[a:b]).all()


@pytest.mark.parametrize("block_ids", [1, 40, 1 << 20])
def test_documents_read_from_shards(spark, documents, block_ids):
    rows = [(i, f"text {i % 7} of\n\n the, same. words" * (i % 5)) for i in range(60)] + [(70, None), (71, ""), (72, "<|endoftext|>"), (5, "twice")]
    blocks = repair.write_shards(documents(rows), PATH, block_ids=block_ids)
    found = sorted(repair.read_documents(blocks).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted(i for i, _ in rows)
    library, at, left = Tokenizer.from_file(PATH), 0, list(rows)
    for r in found:
        options = [(i, t) for i, t in left if i == r.doc_id]
        coded = [library.encode(t or "", add_special_tokens=False).ids + [2] for _, t in options]
        crc = [zlib.crc32(np.array(ids, "<u4").tobytes()) for ids in coded]
        k = crc.index(r.ids_crc32)
        left.remove(options[k])
        assert (r.start, r.n_tokens) == (at, len(coded[k]))
        at += r.n_tokens


def test_empty_table_and_null_ids(spark, documents):
    assert repair.read_documents(repair.write_shards(documents([]), PATH)).collect() == []
    found = repair.read_documents(repair.write_shards(documents([(None, "a"), (0, "b")]), PATH)).collect()
    assert sorted((r.start, r.doc_id is None) for r in found) == [(0, True), (2, False)]


def test_ids_of_odd_texts_equal_the_library():
    rng = random.Random(5)
    letters = list("abcdeth  \n\t.,'!<|>0129éß 你\U0001f600 _-")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(2000)]
    texts += ["", " ", "a <|endoftext|> b", "\n", "a.\nb, c. d", ".", ",", "x." * 200 + " y", "a" * 500 + " " + "a" * 500, "\0a\0 b"]
    mine = repair.Encoder(PATH)
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts, mine.encode(texts), strict=True):
            assert ids.tolist() == mine.library.encode(text, add_special_tokens=False).ids


def test_a_memory_that_overflows_changes_nothing(monkeypatch):
    monkeypatch.setattr(repair, "RECENT", 2)
    mine = repair.Encoder(PATH)
    for text in ["one two three", "four five. six", "one two three"]:
        assert mine.encode([text])[0].tolist() == mine.library.encode(text, add_special_tokens=False).ids


def test_rounds_go_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(4)
    copies = np.tile(rng.integers(0, 50_000, 1000).astype(np.uint32), 1000)
    rules, _, symbols = repair.compress(copies, 50_257)
    assert len(symbols) < 1200 and (repair.expand(rules, 50_257, symbols) == copies).all()
    for ids in (rng.zipf(1.3, 100_000) % 40_000, rng.integers(0, 3, 5000)):
        rules, _, symbols = repair.compress(ids.astype(np.uint32), 50_257)
        counts, last = {}, {}
        for i, pair in enumerate(zip(symbols[:-1].tolist(), symbols[1:].tolist())):
            if last.get(pair, -2) < i - 1:
                counts[pair], last[pair] = counts.get(pair, 0) + 1, i
        assert max(counts.values(), default=0) < repair.LEAST
        assert (repair.expand(rules, 50_257, symbols) == ids).all()


def test_blocks_decode_as_ranges_do_and_no_frequent_pair_is_left():
    rng = np.random.default_rng(9)
    for k in range(300):
        ids = np.tile(rng.integers(0, 1 + k % 5, rng.integers(0, 60)), 1 + k % 7).astype(np.uint32)
        if k % 3 == 0:
            ids = np.repeat(ids, rng.integers(1, 5, len(ids)))
        rules, lengths, symbols = repair.compress(ids, 10, least=3)
        assert (repair.expand_block(rules, lengths, 10, symbols) == ids).all()
        assert (repair.expand(rules, 10, symbols) == ids).all()
        held, last = {}, {}
        for at, pair in enumerate(zip(symbols.tolist(), symbols[1:].tolist())):
            if last.get(pair) != at - 1:  # occurrences that overlap count once
                held[pair], last[pair] = held.get(pair, 0) + 1, at
        assert max(held.values(), default=0) < 3


def test_chunks_asked_for_together_have_the_ids_of_each():
    mine = repair.Encoder(PATH)
    chunks = [" a", " ", "b", " \u00a0", " x\u00a0", " <|endoftext|>", " don't", "\n", " Zq9!", " \u4e2d\u6587", " e\u0301"] * 40
    order, sizes, ids = mine.ask_chunks(chunks)
    assert sorted(order) == list(range(len(chunks)))
    for i, own in zip(order, np.split(ids, np.cumsum(sizes)[:-1])):
        assert own.tolist() == mine.ask([chunks[i]])[0]


def test_a_word_is_asked_for_once_whatever_marks_follow_it():
    mine, asked = repair.Encoder(PATH), []
    ask = mine.ask
    mine.ask = lambda rows: asked.extend(rows) or ask(rows)
    words = [a + b for a in ("Bra", "sélo", "umß", "ÿka") for b in ("nt", "rè", "öl", "vet", "mos")]
    text = " ".join(w + mark for mark in ("", "###", "$$$", ";", "!", ",%%%", ".***") for w in words)
    assert mine.encode([text, text + "."])[0].tolist() == mine.library.encode(text, add_special_tokens=False).ids
    # Once after a space, the first also without one, and each string of marks.
    assert sum(map(len, asked)) <= sum(len(w) + 1 for w in words) + 30


def test_ids_around_marks_equal_the_library():
    rng = random.Random(8)
    letters = list("ab zéß×÷ªµÀÿĀж你́ … \n'\"#$%&()*+,-./:;<=>?@[]^_`{|}~!19") + ["'s", "'ll", "<|endoftext|>", "***"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += [a + b for a in letters for b in letters] + [" ".join(t.split()) for t in texts]
    mine = repair.Encoder(PATH)
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts, mine.encode(texts), strict=True):
            assert ids.tolist() == mine.library.encode(text, add_special_tokens=False).ids


def test_white_runs_are_those_of_the_pattern():
    mine = repair.Encoder(PATH)
    spaces = [c for c in map(chr, range(0x110000)) if c.isspace()]
    texts = [x for a in spaces for b in [*spaces, "x", "é"] for x in (a + b, f"y{b}{a}z", f"{a}y{b}", a)] + ["", "a ", " b"]
    expected = [i for i, t in enumerate(texts) if repair.WHITE_SPACE_RUN.search(t)]
    assert mine.white_runs(texts, [t.encode() for t in texts]) == expected
    assert mine.white_runs([], []) == []


def test_keys_depend_on_the_bytes_alone():
    rng = np.random.default_rng(3)
    chunks = [rng.integers(0, 3, n, np.uint8).tobytes() for n in rng.integers(1, 140, 3000)]
    chunks += [bytes(n) for n in range(1, 140)] + [b"a" * n for n in range(1, 140)]
    chunks += chunks[::-1]  # again at other places
    sizes = np.array([len(c) for c in chunks])
    keys = repair.chunk_keys(b"".join(chunks), np.cumsum(sizes) - sizes, sizes)
    assert len(set(zip(chunks, keys.tolist()))) == len(set(chunks)) == len(set(keys.tolist()))
