import hashlib
import random
import re
from itertools import product
from zlib import crc32

import numpy as np
import pytest

from vitals.llm import viterbi

SCHEMA = "conv_id long, turn long, role string, text string, extra string"
WHITE = " \t\n\v\f\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        h = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        bare = text.strip(WHITE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(turns):
    """(cost, audit, repaired turns) by trying all edits."""
    inserted = [()] + [(r,) for r in ("user", "assistant")] + list(product(("user", "assistant"), repeat=2))
    best = None
    for gaps in product(inserted, repeat=len(turns) + 1):
        for edits in product(("K", "Ru", "Ra", "D"), repeat=len(turns)):
            cost, audit, out = 0, "", []
            for k, gap in enumerate(gaps):
                cost, audit = cost + 5 * len(gap), audit + "I" * len(gap)
                out += [(r, "") for r in gap]
                if k < len(turns):
                    (role, text), edit, fault = turns[k], edits[k], faults(turns)[k]
                    if edit != "D" and fault in ("blank", "duplicate"):
                        break
                    cost += {"K": 0, "R": 1, "D": 2}[edit[0]] + 5 * (edit != "D" and fault == "truncated")
                    audit += edit[0]
                    if edit != "D":
                        out.append(({"K": role, "Ru": "user", "Ra": "assistant"}[edit], text))
            else:
                if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in out)):
                    best = min(best or (99, "", []), (cost, audit, out))
    return best


def solve(turns):
    """The same for conversations of any length: every state's best (cost, audit, turns)."""
    step = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    marks = faults(turns)
    now = {0: (0, "", ())}

    def put(into, state, option):
        if state not in into or option[:2] < into[state][:2]:
            into[state] = option

    def insert(into):
        for _ in range(4):
            for q, (c, a, t) in list(into.items()):
                to = 3 if q == 2 else 2
                put(into, to, (c + 5, a + "I", t + (("assistant" if to == 3 else "user", ""),)))
        return into

    for (role, text), fault in zip(turns, marks):
        after = {}
        for q, (c, a, t) in insert(now).items():
            put(after, q, (c + 2, a + "D", t))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            to = step.get(role[:1], {}).get(q)
            if to is not None:
                put(after, to, (c + extra, a + "K", t + ((role, text),)))
            to = 3 if q == 2 else 2
            put(after, to, (c + 1 + extra, a + "R", t + (("assistant" if to == 3 else "user", text),)))
        now = after
    return min(insert(now)[q] for q in (0, 3) if q in now)


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damage(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns, marks = [r[2:] for r in own], faults([r[2:] for r in own])
        numbers = {r[1] for r in own if r[1] is not None}
        initials = [r[2][:1] for r in own]
        cost, audit, fixed = solve(turns)
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            *(marks.count(m) for m in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest(),
        )
    return out


def found(spark, rows, size=viterbi.CHUNK):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    return {r[0]: tuple(r)[1:] for r in viterbi.digests(frame, size).collect()}


ROLES = ["user", "assistant", "system", "tool", "", "s", "User"]
TEXTS = ["Yes.", "No!", "Why?\n", "half", "", " \n", "other one.", "a?", "Grüße .", "x y"]


def drawn(rng, n, roles=ROLES):
    return [(rng.choice(roles), rng.choice(TEXTS) if rng.random() < 0.4 else f"t{rng.randint(0, 10**6)}" + rng.choice(".!?x")) for _ in range(n)]


def test_the_plain_solver_tries_all_edits():
    rng = random.Random(1)
    for n in (0, 1, 1, 1, 2, 2, 2, 2, 2, 2, 2, 2):
        turns = drawn(rng, n)
        cost, audit, fixed = cheapest(turns)
        assert (cost, audit, tuple(fixed)) == solve(turns)


@pytest.mark.parametrize("size", [4, 64])
def test_digests_against_brute_force(spark, size):
    rng = random.Random(size)
    rows = []
    for conv in range(40):
        n = rng.choice([1, 2, 5, 9, 40])
        for k, (role, text) in enumerate(drawn(rng, n, ROLES if conv % 2 else ROLES[:2])):
            rows.append((conv, None if rng.random() < 0.05 else k * rng.choice([1, 1, 2]), role, text))
    rows += [(None, 3, None, None), (None, None, "user", "Hm."), (None, 4, "assistant", "Ok."), (900, -(2**62), "user", "A."), (900, 5, None, "B.")]
    rows += [(901, k, "user", None) for k in range(30)] + [(902, 1, "user", "Same.")] * 70 + [(903, None, "assistant", f"{k}.") for k in range(70)]
    assert found(spark, rows, size) == expected(rows)


def test_chunks_that_start_from_wrong_vectors_are_rerun(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"text {k}.") for k in range(200)] + [(2, k, "tool", f"{k}.") for k in range(50)]
    parts = viterbi.chunks(spark.createDataFrame([(*r, "") for r in rows], SCHEMA), 4)
    steps = parts.select("conv_id", "chunk", "symbols")
    ends = {r.chunk: r for r in viterbi.settled(steps).collect()}
    # The true vectors, from the end of each conversation.
    for conv in (1, 2):
        own = sorted((r for r in ends.values() if r.conv_id == conv), key=lambda r: r.chunk)
        whole = b"".join(bytes(r.symbols) for r in own)
        true = viterbi.costs([whole], np.array([viterbi.FINAL]))[:, 0]
        at = 0
        for r in own:
            at += len(r.symbols)
            apart = true[at] - np.array(r.end)
            assert len(set(apart.tolist())) == 1
        assert [r.last for r in own] == [False] * (len(own) - 1) + [True]
    assert any(r.end != viterbi.FINAL for r in ends.values())


def test_repaired_turns_form_whole_conversations(spark):
    rng = random.Random(9)
    rows = [(conv, k, *turn) for conv in range(20) for k, turn in enumerate(drawn(rng, 12))]
    pieces = viterbi.repair(spark.createDataFrame([(*r, "") for r in rows], SCHEMA), 5)
    turns = sorted(tuple(r) for r in viterbi.repaired_turns(pieces).collect())
    for conv in range(20):
        initials = "".join(r[3][0] for r in turns if r[0] == conv)
        assert re.fullmatch("(s?(ua)+)?", initials)


def test_no_conversations_and_lost_ones(spark):
    assert found(spark, []) == {}
    lost = next(c for c in range(1000) if crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(spark, [(lost, 0, "user", "Gone.")]) == {lost: (0, 0, 0, 0, 0, 0, "", empty)}


def test_a_long_text_is_a_chunk_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(viterbi, "CHUNK_CHARS", 100)
    rows = [(7, k, "assistant" if k % 2 else "user", f"{k}" * 300 + ".") for k in range(6)]
    assert found(spark, rows) == expected(rows)
