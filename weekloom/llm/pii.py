"""Personal data in texts: spans with kind, position and score.

Method: regular expressions propose spans, checks confirm them (Luhn for cards, mod-97 for IBANs, number
ranges and digit counts for the rest), words near a span raise or lower its score. Only SQL functions;
a text is handled within its row, so there is no shuffle and no group.

Positions come from the parts between the matches: a span starts after all parts and matches before it.
Patterns are possessive and anchored to the start of a run, so that long runs cost linear time and no
recursion; the results are those of the plain patterns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements of a block of the prefix sums: a start costs one block plus one sum for each block before it.
BLOCK = 256
#: Characters of context on either side, taken from the text between neighbouring matches.
CONTEXT = 48


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """The digits of ``text`` pass the Luhn check."""
    def total(d: Column) -> Column:
        n = F.length(d)

        def add(acc: Column, i: Column) -> Column:
            digit = F.substring(d, i, F.lit(1)).cast("int")
            twice = digit * 2
            return acc + F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)
        return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
    return let(digits_of(text), total) % 10 == 0


def mod97(text: Column) -> Column:
    """An IBAN's check: the first four characters at the end, letters as 10 to 35, remainder 1."""
    def rest(s: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            c = F.substring(s, i, F.lit(1))
            return F.when(c.between("0", "9"), (acc * 10 + c.cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
        return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), add)
    bare = F.regexp_replace(text, r"\x20", "")
    return let(F.concat(F.substr(bare, F.lit(5)), F.substring(bare, 1, 4)), rest) == 1


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: Callable[[Column], Column]
    gate: str                      # a text without it has no match
    score: float                   # of a confirmed span without context
    near: str                      # words that raise the score
    base: bool = True              # stays whatever its score


_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"

KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda m: F.lit(True), "@", 0.8,
         "mail|contact|kontakt|correo"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"), ".", 0.5, r"\bip\b|server|host|address"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", lambda m: F.length(digits_of(m)).between(12, 19) & luhn(m), "", 0.7, "card|visa|karte|carte|tarjeta|credit"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.length(digits_of(m)).between(9, 15), "+", 0.6, "phone|tel|call|mobil|anruf"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?", lambda m: (F.length(F.regexp_replace(m, r"\x20", "")) >= 15) & mod97(m),
         "", 0.7, "iban|bank|konto|account|cuenta|compte", base=False),
)
LOWERING = "example|sample|invoice no|order no|version"


def _prefix(lengths: Column, blocks: Column, i: Column) -> Column:
    """Sum of the elements 0 to ``i``."""
    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda x, y: x + y)
    block = F.floor(i / BLOCK).cast("int")
    return total(F.slice(blocks, F.lit(1), block)) + total(F.slice(lengths, block * BLOCK + 1, i - block * BLOCK + 1))


def _spans(text: Column, kind: Kind, order: int, threshold: float) -> Column:
    """Array of struct(start, ord, end, kind, score), in text order."""
    none = F.expr("CAST(array() AS array<struct<start:int,ord:int,end:int,kind:string,score:double>>)")

    def place(found: Column, parts: Column) -> Column:
        def length(m: Column, i: Column) -> Column:
            return F.length(F.get(parts, i)) + F.coalesce(F.length(F.get(found, i - 1)), F.lit(0))

        def starts(lengths: Column) -> Column:
            def span(blocks: Column) -> Column:
                def one(m: Column, i: Column) -> Column:
                    start = _prefix(lengths, blocks, i)
                    around = F.lower(F.concat(F.right(F.get(parts, i), F.lit(CONTEXT)), F.lit(" "), F.left(F.get(parts, i + 1), F.lit(CONTEXT))))
                    score = (F.lit(kind.score) + F.when(around.rlike(kind.near), 0.2).otherwise(0.0)
                             - F.when(around.rlike(LOWERING), 0.3).otherwise(0.0))
                    return F.when(kind.valid(m), let(start, lambda s: F.struct(
                        s.cast("int").alias("start"), F.lit(order).alias("ord"), (s + F.length(m)).cast("int").alias("end"),
                        F.lit(kind.name).alias("kind"), F.round(score, 2).alias("score"))))
                return F.filter(F.transform(found, one), lambda s: s.isNotNull() if kind.base else s.isNotNull() & (s["score"] >= threshold))
            return let(F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
                                   lambda b: F.aggregate(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), lambda x, y: x + y)), span)
        return let(F.transform(found, length), starts)

    def located(found: Column) -> Column:
        return F.when(F.exists(found, kind.valid), let(F.split(text, kind.pattern, -1), lambda parts: place(found, parts))).otherwise(none)

    all_found = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), located)
    return F.when(F.contains(text, F.lit(kind.gate)), all_found).otherwise(none) if kind.gate else all_found


def find_pii(docs: DataFrame, text_col: str = "text", out: str = "pii", threshold: float = 0.5, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with a column ``out``: array of struct(start, ord, end, kind, score) by start, then kind as listed.

    Positions count code points, the end is exclusive. Matches of a kind are leftmost and do not overlap;
    one that fails its check is dropped without another try. Spans of the base kinds stay whatever their
    score, others from ``threshold`` on. Defined results: a null or empty text gives an empty array;
    spans of different kinds may overlap; an existing column ``out`` is replaced; rows stay as they are.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    found = [_spans(text, kind, i, threshold) for i, kind in enumerate(kinds)]
    return docs.withColumn(out, F.sort_array(F.concat(*found)))


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

