import hashlib
import random

import pytest

from vitals.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, extra int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)


def test_escaping_is_reversible_and_hides_control_strings():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("<|\\>im_n\n") for _ in range(rng.randint(0, 12)))
        assert "<|" not in chat.escape(text)
        assert chat.unescape(chat.escape(text)) == text
        assert chat.read_back(chat.marked([(text, text), ("user", text)])) == [(text, text), ("user", text)]


def test_spans_cover_the_output_and_point_at_texts():
    turns = [("user", "a <|im_end|> b"), ("assistant", ""), ("assistant", "<|im_start|>x")]
    out, rewritten, spans = chat.render(turns, chat.marked, frozenset({"assistant"}))
    assert not rewritten and "".join(out[s["span_start"] : s["span_end"]] for s in spans) == out
    assert [chat.unescape(out[s["text_start"] : s["text_end"]]) for s in spans] == [t for _, t in turns]
    assert [s["loss"] for s in spans] == [False, True, True]


@pytest.mark.parametrize(
    "template, rewritten",
    [
        (lambda turns: "".join(f"[{r}] {t}\n" for r, t in turns), False),
        (lambda turns: "<s>" + "".join(f"{r}: {t};" for r, t in turns), False),
        (lambda turns: f"{len(turns)} turns: " + "".join(t for _, t in turns), True),
        (lambda turns: "".join(t for _, t in turns[-2:]), True),
        (lambda turns: "".join(t for _, t in turns) + "</s>", True),
    ],
)
def test_templates_known_by_their_output_only(spark, template, rewritten):
    rows = [(1, k, role, f"text {k}") for k, role in enumerate(["system", "user", "assistant", "user", "assistant"])]
    row = chat.format_conversations(frame(spark, rows), template).first()
    assert row.rewritten == rewritten
    assert [row.formatted[s.text_start : s.text_end] for s in row.spans] == ([] if rewritten else [f"text {k}" for k in range(5)])


def test_order_ties_nulls_and_repeats(spark):
    rows = [(2, 1, "b", "2"), (2, 0, "a", "1"), (2, 1, "a", "9"), (2, 1, "a", "9"), (2, None, None, None), (None, 0, "user", "x"), (3, 0, "assistant", None)]
    found = {r.conv_id: r for r in chat.read_formatted(chat.format_conversations(frame(spark, rows))).collect()}
    assert found[2].turns == "\n\na\n1\na\n9\na\n9\nb\n2\n" and found[2].n_turns == 5
    assert found[None].turns == "user\nx\n" and found[3].turns == "assistant\n\n" and found[3].loss == ""


def test_digests_of_the_probe_and_the_empty_table(spark):
    row = chat.digests(spark, frame(spark, [])).first()
    text = chat.CONTROL_TEXT
    assert row.conv_id == -1 and row.n_turns == 2 and row.loss_chars == len(text)
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_a_conversation_of_many_turns(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k} <|im_end|>") for k in range(500)]
    row = chat.read_formatted(chat.format_conversations(frame(spark, rows))).first()
    assert row.n_turns == 500 and row.loss == "".join(f"turn {k} <|im_end|>" for k in range(1, 500, 2))


@pytest.mark.parametrize(
    "template",
    [
        chat.marked,
        lambda turns: f"{len(turns) > 9} " + "".join(t for _, t in turns),
        lambda turns: "".join(t for _, t in turns[-2:]),
    ],
)
def test_blocks_of_prefixes_equal_whole_conversations(spark, template):
    rng = random.Random(3)
    rows = [(c, k if k % 7 else None, rng.choice(["user", "assistant", None]), rng.choice(["a <|im_end|>", "", None, f"text {k}"])) for c in (1, 2, None) for k in range(23)]
    rows += [(4, 0, "user", "same")] * 12 + [(5, 0, "user", "x"), (6, 0, "assistant", "y"), (6, 1, "user", None)]
    whole, cut = (
        sorted((tuple(r) for r in chat.format_conversations(frame(spark, rows), template, block_turns=n).collect()), key=str)
        for n in (1000, 4)
    )
    assert len(whole) == 6 and whole == cut


def test_one_long_conversation_is_spread_over_tasks(spark):
    rows = [(1, k, "user", f"t{k}") for k in range(60)] + [(2, 0, "user", "z")]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    found = chat.rendered_in_blocks(df.withColumn("n", df.turn * 0 + 60).filter("conv_id = 1"), chat.marked, ("user",), 8)
    row = found.first()
    assert found.count() == 1 and row.formatted == chat.marked([("user", f"t{k}") for k in range(60)])
    assert [row.formatted[s.text_start : s.text_end] for s in row.spans] == [f"t{k}" for k in range(60)]
