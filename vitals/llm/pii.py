r"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Everything is DataFrame expressions inside one pass over the rows: no shuffle, no Python. For each
kind a text is split at its pattern, which gives the matches and the pieces between them, so
offsets are sums of lengths in code points, and the words around a match are the ends of its
neighbouring pieces.

The patterns are linear in the text. They find what the plain forms find, leftmost and
non-overlapping, but with possessive loops (no recursion on long matches) and, where a match could
start anywhere in a run of characters, only at the run's start or where the last match ended: if the
start fails, so does the rest of the run.

Base kinds (email, ip, card, phone) are kept whatever their score. Additional kinds need a score of
``LEAST_SCORE``: ``iban`` is confirmed by mod-97, ``ssn`` only by its context. Null counts as
empty, empty texts have no spans; repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitals.llm.tables import text_of

LEAST_SCORE = 0.5
CONTEXT_BONUS = 0.3
BEFORE, AFTER = 40, 20
BLOCK = 64
# An account number of fewer groups is not looked for inside a longer match.
LEAST_GROUPS = 4

LOCAL = "A-Za-z0-9._%+-"
BYTE = "^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def running(values: Column) -> Column:
    """Sums of all prefixes of an array of bigint, by way of the sums of blocks."""
    first = lambda i: (F.floor(i / BLOCK) * BLOCK + 1).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
        lambda b: total(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))),
    )

    def with_blocks(sums: Column) -> Column:
        ahead = F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b)))
        return let(
            ahead,
            lambda a: F.transform(
                values,
                lambda _, i: F.get(a, F.floor(i / BLOCK).cast("int"))
                + total(F.slice(values, first(i), (i % BLOCK + 1).cast("int"))),
            ),
        )

    return F.when(F.size(values) == 0, F.array().cast("array<bigint>")).otherwise(let(blocks, with_blocks))


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of up to 19 digits has a valid check digit."""
    doubled = lambda d: F.translate(d, "0123456789", "0246813579")
    padded = F.lpad(number, 20, "0")
    # Position 20 is the check digit; every second one to its left is doubled.
    at = [F.substring(padded, i, 1) for i in range(1, 21)]
    values = [(doubled(d) if i % 2 else d).cast("int") for i, d in enumerate(at, 1)]
    return sum(values[1:], values[0]) % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether an account number leaves 1 modulo 97, letters counting from ten on."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    values = F.transform(
        F.filter(F.split(moved, ""), lambda c: c != ""),
        lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55),
    )
    rest = F.aggregate(values, F.lit(0), lambda a, v: F.when(v < 10, a * 10 + v).otherwise(a * 100 + v) % 97)
    return rest == 1


def account(match: Column) -> Column:
    """The longest beginning of a match that ends with a group and passes mod-97, else the match.

    A pattern cannot know where a number ends whose length is a multiple of four: it takes letters or
    digits of the next word, too.
    """
    groups = F.regexp_extract_all(match, F.lit(r"\x20?[A-Z0-9]{1,4}"), F.lit(0))
    shorter = F.transform(F.sequence(F.size(groups) - 1, F.lit(LEAST_GROUPS), F.lit(-1)), lambda n: F.array_join(F.slice(groups, F.lit(1), n), ""))
    forms = F.concat(F.array(match), F.when(F.size(groups) > LEAST_GROUPS, shorter).otherwise(F.array().cast("array<string>")))
    return F.coalesce(F.get(F.filter(forms, mod_97), F.lit(0)), match)


@dataclass(frozen=True)
class Kind:
    """``needs`` must occur in a text for the pattern to be tried; ``trim`` shortens a match, whose rest then belongs to
    the piece after it; ``valid`` judges a match and the pieces before and after it; ``score`` holds for a valid
    match without context words."""

    name: str
    pattern: str
    needs: str
    valid: Callable[[Column, Column, Column], Column]
    score: float
    context: str
    base: bool = True
    trim: Callable[[Column], Column] | None = None


def _length_between(text: Column, least: int, most: int) -> Column:
    return F.char_length(text).between(least, most)


def _no_digit_around(before: Column, after: Column) -> Column:
    return ~before.rlike("[0-9]$") & ~after.rlike("^[0-9]")


# The four base patterns (in linear form), in the order in which kinds are listed.
KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        lambda m, *_: F.lit(True),
        0.7,
        "mail|contact|write to|correo|kontakt",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
        ".",
        lambda m, *_: F.forall(F.split(m, r"\."), lambda part: part.rlike(BYTE)),
        0.6,
        r"\bip\b|address|host|server|adresse",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?+[0-9])++",
        "",
        lambda m, *_: let(digits(m), lambda d: _length_between(d, 14, 19) & luhn(d)),
        0.7,
        "card|visa|credit|payment|karte|carte|tarjeta",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "+",
        lambda m, *_: _length_between(digits(m), 10, 15),
        0.6,
        "phone|call|tel|mobile|fax|handy|llame",
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
        "",
        lambda m, before, after: mod_97(m) & ~before.rlike("[A-Za-z0-9]$") & ~after.rlike("^[A-Za-z0-9]"),
        0.8,
        "iban|account|bank|konto|compte|cuenta",
        base=False,
        trim=account,
    ),
    Kind(
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        "-",
        lambda m, before, after: _no_digit_around(before, after),
        0.3,
        "ssn|social security|tax id",
        base=False,
    ),
)


SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,score:double>"


def _parts(text: Column, kind: Kind) -> Column:
    """The matches of a kind and the pieces between them, of which there is one more."""
    pieces = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    if kind.trim is None:
        return F.struct(pieces.alias("pieces"), matches.alias("matches"))

    def trimmed(m: Column) -> Column:
        def with_rests(t: Column) -> Column:
            rest = lambda i: F.substr(F.get(m, i - 1), F.char_length(F.get(t, i - 1)) + 1)
            longer = F.transform(pieces, lambda piece, i: F.when(i == 0, piece).otherwise(F.concat(rest(i), piece)))
            return F.struct(longer.alias("pieces"), t.alias("matches"))

        return let(F.transform(m, kind.trim), with_rests)

    return let(matches, trimmed)


def _where_found(text: Column, kind: Kind, then: Callable[[Column], Column], otherwise: Column) -> Column:
    possible = F.contains(text, F.lit(kind.needs)) if kind.needs else F.lit(True)
    return F.when(possible & text.rlike(kind.pattern), let(_parts(text, kind), then)).otherwise(otherwise)


def _score(kind: Kind, match: Column, before: Column, after: Column) -> Column:
    """Null for a match that is no span."""
    around = F.lower(F.concat_ws(" ", F.substring(before, -BEFORE, BEFORE), F.substring(after, 1, AFTER)))
    bonus = F.when(around.rlike(kind.context), F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0))
    score = F.least(F.lit(kind.score) + bonus, F.lit(1.0))
    enough = F.lit(True) if kind.base else score >= LEAST_SCORE
    return F.when(kind.valid(match, before, after) & enough, score)


def spans_of(text: Column, kind: Kind) -> Column:
    """Spans of one kind: array of start, rank of the kind, end, kind, score."""

    def found(parts: Column) -> Column:
        pieces, matches = parts["pieces"], parts["matches"]

        def step(_: Column, i: Column) -> Column:
            """Length of a piece and of the match before it: their running sum is where a match starts."""
            previous = F.when(i > 0, F.char_length(F.get(matches, i - 1))).otherwise(0)
            return (F.char_length(F.get(pieces, i)) + previous).cast("bigint")

        def judged(starts: Column) -> Column:
            def span(m: Column, i: Column) -> Column:
                return F.struct(
                    F.get(starts, i).alias("start"),
                    F.lit(KINDS.index(kind)).alias("rank"),
                    (F.get(starts, i) + F.char_length(m)).alias("end"),
                    F.lit(kind.name).alias("kind"),
                    _score(kind, m, F.get(pieces, i), F.get(pieces, i + 1)).alias("score"),
                )

            return F.filter(F.transform(matches, span), lambda s: s["score"].isNotNull())

        return let(let(F.transform(matches, step), running), judged)

    return _where_found(text, kind, found, F.array().cast(f"array<{SPAN}>"))


def without(text: Column, kind: Kind) -> Column:
    """The text with each span of one kind replaced by the kind's name."""

    def replaced(parts: Column) -> Column:
        pieces, matches = parts["pieces"], parts["matches"]

        def shown(m: Column, i: Column) -> Column:
            before, after = F.get(pieces, i), F.get(pieces, i + 1)
            span = _score(kind, m, before, after).isNotNull()
            return F.concat(before, F.when(span, F.lit(f"[{kind.name.upper()}]")).otherwise(m))

        return F.array_join(F.concat(F.transform(matches, shown), F.slice(pieces, -1, 1)), "")

    return _where_found(text, kind, replaced, text)


def detect(docs: DataFrame, kinds: Sequence[Kind] = KINDS, name: str = "spans") -> DataFrame:
    """Adds ``spans``: start, rank, end, kind and score, by start, then in the order of the kinds."""
    text = text_of()
    return docs.withColumn(name, F.array_sort(F.concat(*(spans_of(text, k) for k in kinds))))


def redact(docs: DataFrame, kinds: Sequence[Kind] = KINDS) -> DataFrame:
    """Replaces each span in ``text`` by its kind in brackets; null texts stay null.

    Kinds are replaced one after another, those that can contain others first. Where an earlier
    kind has taken part of a span, the rest stays unless it is itself a span.
    """
    first = ("email", "phone", "iban")
    for kind in sorted(kinds, key=lambda k: first.index(k.name) if k.name in first else len(first)):
        docs = docs.withColumn("text", without(F.col("text"), kind))
    return docs


def listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def digests(docs: DataFrame) -> DataFrame:
    """Per document the counts of the base kinds, a digest of their spans, and all spans."""
    found = detect(docs.select("doc_id", "text")).select("doc_id", "spans")
    base = [k.name for k in KINDS if k.base]
    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id",
        *(_count(n) for n in base),
        F.sha2(listed(of_base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
