"""Personal data in texts: patterns propose, validators confirm, nearby words adjust.

Everything is a column expression. A kind's matches come from one regular expression; the
pieces between them give their places, in code points. A validator confirms a match (part
sizes, digit counts, the Luhn sum, the mod-97 remainder of account numbers). A match scores by
its kind, more if its checksum holds and more if a word that belongs to the kind stands within
``CONTEXT_CHARS`` before it; matches that score ``ACCEPTED`` are spans.

Confirmed matches of the four plain kinds always score enough; the other kinds need a checksum
or a context word.

Nulls and edges: a null text is an empty one and has no span; rows are judged one by one, so
repeated rows repeat; whole texts are read. Patterns use possessive repeats, so that a long run
of letters or digits costs no more than its length. Column names must not begin with ``_pii``.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.llm.common import table

CONTEXT_CHARS, ACCEPTED, CONTEXT_BONUS = 40, 0.5, 0.3


def _count_digits(m: Column) -> Column:
    return F.length(F.regexp_replace(m, "[^0-9]", ""))


def _byte_parts(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                    & (F.coalesce(F.right(p, F.lit(9)).cast("int"), F.lit(0)) <= 255))


def _luhn(m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)


def _mod97(m: Column) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    moved = F.split(F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4)), "")
    rest = F.aggregate(moved, F.lit(0).cast("long"), lambda r, c: F.when(
        c.between("0", "9"), (r * 10 + c.cast("long")) % 97).when(
        c.between("A", "Z"), (r * 100 + F.ascii(c) - 55) % 97).otherwise(r))
    return F.length(plain).between(15, 34) & (rest == 1)


def _social(m: Column) -> Column:
    return ~F.substring(m, 1, 3).isin("000", "666") & (F.substring(m, 1, 1) != "9") & (
        F.substring(m, 5, 2) != "00") & (F.substring(m, 8, 4) != "0000")


def _letters_and_digits(m: Column) -> Column:
    return m.rlike("[0-9]") & m.rlike("[A-Za-z]")


@dataclass(frozen=True)
class Kind:
    """A pattern, what a text must contain to be worth matching, and what a match scores."""

    name: str
    pattern: str
    hint: str
    valid: object
    score: float
    words: str

    def worth(self, text: Column) -> Column:
        return text.contains(self.hint) if len(self.hint) == 1 else text.rlike(self.hint)


#: The four plain kinds, in the order that breaks ties, then those the method adds.
PLAIN = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", lambda m: F.lit(True), 0.9, r"mail|contact|write"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]", _byte_parts, 0.7,
         r"\bip\b|address|host|server"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){13}", _luhn, 0.7,
         r"card|visa|credit|debit|amex"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", lambda m: _count_digits(m).between(10, 15), 0.7,
         r"phone|tel|call|mobile|fax"),
)
ADDED = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
         r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}", _mod97, 0.6, r"iban|account|konto|bank"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]{2}-[0-9]", _social, 0.3,
         r"ssn|social|security|tax"),
    Kind("local_phone", r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
         r"[0-9]{3}[\x20.-][0-9]{4}", lambda m: F.lit(True), 0.3, r"phone|tel|call|mobile|fax"),
    Kind("secret", r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+", r"(?i)token|secret|passw|key", _letters_and_digits,
         0.3, r"token|secret|passw|key"),
)


def _matches(text: Column, kind: Kind, rank: int) -> tuple[Column, Column]:
    """Matches of a kind and the pieces around them; null where the text holds no hint."""
    worth = kind.worth(text)
    return (F.when(worth, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))),
            F.when(worth, F.split(text, kind.pattern, -1)))


SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string,score:double>>"


def _placed(found: str, around: str, kind: Kind, rank: int) -> Column:
    """Accepted spans of a kind, from its matches and the pieces around them."""
    zipped = F.arrays_zip(F.col(found).alias("m"), F.slice(F.col(around), 1, F.size(found)).alias("g"))
    begin = F.struct(F.lit(0).alias("pos"), F.array().cast(SPAN).alias("spans"))

    def step(held: Column, x: Column) -> Column:
        start = held["pos"] + F.length(x["g"])
        end = start + F.length(x["m"])
        score = F.lit(kind.score) + F.when(F.lower(F.right(x["g"], F.lit(CONTEXT_CHARS))).rlike(kind.words),
                                           CONTEXT_BONUS).otherwise(0.0)
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
                        F.lit(kind.name).alias("kind"), x["m"].alias("value"), score.alias("score"))
        good = kind.valid(x["m"]) & (score >= ACCEPTED)
        return F.struct(end.alias("pos"), F.when(good, F.concat(held["spans"], F.array(span)))
                        .otherwise(held["spans"]).alias("spans"))

    spans = F.aggregate(zipped, begin, step, lambda held: held["spans"])
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(SPAN))


def with_spans(docs: DataFrame, *, text_col: str = "text", out: str = "spans",
               kinds=PLAIN + ADDED) -> DataFrame:
    """The documents and an array of their spans, by start and kind, with value and score."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select("*", *[c.alias(f"_pii_{part}{i}") for i, kind in enumerate(kinds)
                               for part, c in zip("mg", _matches(text, kind, i))])
    placed = found.select(*docs.columns, *[
        _placed(f"_pii_m{i}", f"_pii_g{i}", kind, i).alias(f"_pii_s{i}") for i, kind in enumerate(kinds)])
    return placed.select(*docs.columns, F.array_sort(F.concat(
        *[F.col(f"_pii_s{i}") for i in range(len(kinds))])).alias(out))


def redact(docs: DataFrame, *, text_col: str = "text", kinds=PLAIN + ADDED) -> DataFrame:
    """The documents with a tag such as ``<EMAIL>`` in place of every span.

    Spans that overlap become one, under the tag of the first. A null text stays null.
    """
    text = F.col(text_col)
    begin = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("parts"))

    def step(held: Column, span: Column) -> Column:
        apart = span["start"] >= held["pos"]
        before = F.substr(text, held["pos"] + 1, span["start"] - held["pos"])
        parts = F.when(apart, F.concat(held["parts"], F.array(before, F.concat(
            F.lit("<"), F.upper(span["kind"]), F.lit(">"))))).otherwise(held["parts"])
        return F.struct(F.greatest(held["pos"], span["end"]).alias("pos"), parts.alias("parts"))

    rebuilt = F.aggregate("_pii", begin, step, lambda held: F.concat(
        F.array_join(held["parts"], ""), F.substr(text, held["pos"] + 1)))
    spans = with_spans(docs, text_col=text_col, out="_pii", kinds=kinds)
    return spans.select(*[F.when(F.size("_pii") > 0, rebuilt).otherwise(text).alias(c) if c == text_col
                          else F.col(c) for c in docs.columns])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_pii(spark, sf_dir: str) -> DataFrame:
    """Spans of personal data in every text; counts and a checksum of the plain kinds."""
    docs = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["rank"] < len(PLAIN))

    def number(rank: int) -> Column:  # a second lambda parameter would be the place in the array
        return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")

    return docs.select(
        "doc_id", *[number(i).alias(f"n_{k.name}") for i, k in enumerate(PLAIN)],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"))
