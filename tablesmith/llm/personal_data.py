"""Personal data in texts, in DataFrame functions only: patterns propose, checksums confirm, words
nearby adjust the score.

Each kind's pattern is looked for from the left without overlap. Proposals must pass the kind's check:
parts of an IP address up to 255, the Luhn sum of a card number, mod 97 of an IBAN, the number of
digits of a phone number. What fails is dropped. A span's score is the kind's own one, raised by a
context word within ``NEAR`` code points before or after it; a span of a kind that is not plain and
scores below ``ENOUGH`` is dropped, so a number without a checksum needs its context.

The positions come from the lengths of the matches and of the text between them, which two functions
give for one pattern, added up in blocks. What is around a span is looked up in pieces of the text, so
the work is linear in the text and its matches. Defined cases: a NULL or empty text has no spans; positions count code points;
spans of several kinds may overlap; repeated rows are searched alike; other columns are kept, but for one named like the new column, which takes its place.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

NEAR = 40
#: The score from which a span of an added kind stays.
ENOUGH = 0.5
#: Matches that are placed together, and code points in a piece of text.
BLOCK, PIECE = 256, 1024


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a text without any of these characters has no match
    score: float
    context: str


# The patterns and their order. Quantifiers are possessive where nothing that follows
# could match otherwise, and matches begin where a run of their characters does.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "[@]", 0.8, r"mail|contact|write to|kontakt|correo|courriel",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "[0-9]", 0.5, r"(?:^|[^a-z0-9])ip(?:[^a-z0-9]|$)|server|host|address|adresse"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]", 0.6, r"card|visa|credit|karte|carte|tarjeta|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "[0-9]", 0.5, r"phone|call|(?:^|[^a-z0-9])tel|mobil|fax|handy"),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{4}){2,7}(?:[\x20]?[A-Z0-9]{1,3})?",
        "[0-9]", 0.7, r"iban|bank|account|konto|compte|cuenta",
    ),
    Kind(
        "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "[0-9]", 0.4,
        r"(?:^|[^a-z0-9])ssn(?:[^a-z0-9]|$)|social|security|tax id|taxpayer",
    ),
)
#: How many of the kinds, from the first, are plain patterns; the others are what the checks add.
PLAIN = 4
_SPAN = "array<struct<start:int,kind:int,end:int,text:string>>"


def _proposals(text: Column, kind: int) -> Column:
    """Matches of one pattern with their places."""
    pattern = KINDS[kind].pattern
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(matches.alias("m"), F.slice(F.split(text, pattern, -1), 1, F.greatest(F.size(matches), F.lit(1))).alias("gap"))
    found = F.filter(both, lambda x: x["m"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def add(state, x):
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.length(x["m"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["m"].alias("text"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def moved(spans, by):
        return F.transform(
            spans,
            lambda s: F.struct(
                (s["start"] + by).alias("start"), s["kind"].alias("kind"), (s["end"] + by).alias("end"), s["text"].alias("text")
            ),
        )

    # An array grows by being copied, so places are counted within blocks and then moved.
    numbers = F.sequence(F.lit(0), F.floor(F.size(found) / BLOCK).cast("int"))
    blocks = F.transform(numbers, lambda b: F.aggregate(F.slice(found, b * BLOCK + 1, BLOCK), start, add))
    all_start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("blocks"))
    placed = F.aggregate(
        blocks,
        all_start,
        lambda state, x: F.struct(
            (state["at"] + x["at"]).alias("at"),
            F.concat(state["blocks"], F.array(moved(x["spans"], state["at"]))).alias("blocks"),
        ),
    )
    return F.flatten(placed["blocks"])


def _between(pieces: Column, begin: Column, end: Column) -> Column:
    """Code points of the text from ``begin`` up to ``end``, at most a piece's length of them."""
    first = F.floor(begin / PIECE).cast("int")
    near = F.concat(F.coalesce(F.get(pieces, first), F.lit("")), F.coalesce(F.get(pieces, first + 1), F.lit("")))
    return F.substring(near, begin - first * PIECE + 1, F.greatest(end - begin, F.lit(0)))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digit sum, every second one from the right doubled, is a multiple of ten."""
    turned = F.reverse(digits)

    def add(total, i):
        value = F.substring(turned, i + 1, F.lit(1)).cast("int") * (1 + i % 2)
        return total + F.when(value > 9, value - 9).otherwise(value)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number, its first four characters last and letters as 10 to 35, is 1 modulo 97."""
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def add(rest, c):
        value = F.ascii(c) - F.when(c >= "A", F.lit(55)).otherwise(F.lit(48))
        return (rest * F.when(value > 9, F.lit(100)).otherwise(F.lit(10)) + value) % 97

    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), add) == 1


def _confirmed(pieces: Column, kind: int, span: Column) -> Column:
    match = span["text"]
    name = KINDS[kind].name
    if name == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if name == "card":
        return F.length(_digits(match)).between(12, 19) & luhn(_digits(match))
    if name == "phone":
        return F.length(_digits(match)).between(9, 15)
    if name == "iban":
        code = F.replace(match, F.lit(" "), F.lit(""))
        before = _between(pieces, F.greatest(span["start"] - 1, F.lit(0)), span["start"])
        after = _between(pieces, span["end"], span["end"] + 1)
        alone = ~F.concat(before, after).rlike("[A-Za-z0-9]")
        return alone & F.length(code).between(15, 34) & mod97(code)
    if name == "ssn":
        return ~_between(pieces, F.greatest(span["start"] - 1, F.lit(0)), span["start"]).rlike("[0-9-]") & ~_between(
            pieces, span["end"], span["end"] + 1
        ).rlike("[0-9-]")
    return F.lit(True)


def _scored(pieces: Column, kind: int, span: Column) -> Column:
    begin = F.greatest(span["start"] - NEAR, F.lit(0))
    before, after = _between(pieces, begin, span["start"]), _between(pieces, span["end"], span["end"] + NEAR)
    around = F.concat(before, F.lit(" "), after)
    hint = F.lower(around).rlike(KINDS[kind].context)
    score = F.lit(KINDS[kind].score) + F.when(hint, F.lit(0.2)).otherwise(F.lit(0.0))
    return F.struct(
        span["start"].alias("start"), span["kind"].alias("kind"), span["end"].alias("end"), score.alias("score")
    )


def _kept(pieces: Column, kind: int, spans: Column) -> Column:
    sound = F.filter(spans, lambda s: _confirmed(pieces, kind, s))
    scored = F.transform(sound, lambda s: _scored(pieces, kind, s))
    return scored if kind < PLAIN else F.filter(scored, lambda s: s["score"] >= ENOUGH)


def personal_data(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: ``array<struct<start, kind, end, score>>`` by start, then by kind, a
    place in ``KINDS``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    made = uuid.uuid4().hex
    names, pieces = [f"{k.name}_{made}" for k in KINDS], f"pieces_{made}"
    empty = F.array().cast(_SPAN)
    proposed = docs.select(
        "*",
        F.when(text.rlike("[@0-9]"), F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))).alias(pieces),
        *[
            F.when(text.rlike(k.needs), _proposals(text, i)).otherwise(empty).alias(n)
            for i, (k, n) in enumerate(zip(KINDS, names, strict=True))
        ],
    )
    kept = [_kept(F.col(pieces), i, F.col(n)) for i, n in enumerate(names)]
    return proposed.withColumn(spans_col, F.array_sort(F.concat(*kept))).drop(pieces, *names)


def as_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    name = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def scores_as_text(spans: Column) -> Column:
    """The spans' scores in hundredths, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.round(100 * s["score"]).cast("int").cast("string")), ",")


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
