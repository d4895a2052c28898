r"""Personal data: spans that patterns propose, checksums confirm and nearby words weigh.

Native: DataFrame and SQL functions only, one projection over the texts, no
shuffle.

* A pattern runs over a whole text, leftmost matches, not overlapping within
  its kind.  Cutting the text at the matches gives the pieces between them;
  the running sum of the lengths of pieces and matches gives each match's place
  in code points.  Texts without a kind's hint aren't cut.
* Patterns can't run away on long texts: a match begins at the start of its run
  of characters or where the last match ended (``\G``), and repeats are
  possessive where nothing that follows could take a character back.
* Validators: parts of an address at most 255, Luhn's sum for cards, the
  count of digits for phones, mod 97 for bank accounts, the ranges that are
  never given out for social security numbers.
* The score is the kind's own, plus the weight of a confirming checksum, plus
  that of a context word of the kind within ``NEAR`` code points before or after, but
  not beyond the next match.  The four base kinds are reported whatever their
  score; the others from ``LEAST_SCORE``.

Defined cases: null and empty texts have no spans; repeated rows get the same
result each; an empty table gives an empty table; other columns pass through,
but for one named like the output, which it replaces.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let

NEAR = 40
LEAST_SCORE = 0.5
CONTEXT_WEIGHT = 0.3
CHECKSUM_WEIGHT = 0.4


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column, least: int, most: int) -> Column:
    return let(_digits(match), lambda d: F.length(d).between(least, most) & F.call_function("luhn_check", d))


def _mod97(match: Column) -> Column:
    """15 to 34 characters whose number, first four moved to the end and A-Z as 10 to 35, is 1 modulo 97."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 30), F.substring(plain, 1, 4))
    rest = F.aggregate(F.split(moved, "", -1), F.lit(0), lambda acc, c: F.when(c == "", acc).when(
        c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))
    return F.length(plain).between(15, 34) & (rest == 1)


@dataclass(frozen=True)
class Kind:
    """``score`` counts for a match that ``valid`` lets pass; ``context`` words add to it.

    ``hint`` is a cheaper pattern that every text with a match has.
    """
    name: str
    hint: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    checksum: bool
    context: str
    base: bool


_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_LONG, _CHAIN = r"[0-9](?:[\x20-]?[0-9]){12}", r"[0-9](?:[\x20-]?[0-9])++"
_WORD = "(?<![a-z0-9_]){}(?![a-z0-9_])"
_WHOLE = "(?<![A-Za-z0-9_])(?:{})(?![A-Za-z0-9_])"
KINDS = (
    Kind("email", r"@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda m: F.lit(True), 0.8, False, "mail|contact|write to", True),
    Kind("ip", r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda m: m.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"), 0.6, False, f"{_WORD.format('ip')}|address|host|server|login", True),
    Kind("card", _LONG, _CHAIN, lambda m: _luhn(m, 16, 19), 0.3, True, "card|visa|credit|debit|karte|tarjeta|carte", True),
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(8, 15), 0.6, False,
         r"phone|\btel|mobil|call|fax", True),
    Kind("iban", r"[A-Z]{2}[0-9]{2}", _WHOLE.replace("{}", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}"), _mod97, 0.3, True,
         r"iban|account|bank|konto|cuenta|compte", False),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-", _WHOLE.replace("{}", "[0-9]{3}-[0-9]{2}-[0-9]{4}"), lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3, False,
         f"{_WORD.format('ssn')}|social security|tax id", False),
    Kind("shortcard", _LONG, _CHAIN, lambda m: _luhn(m, 13, 15), 0.05, True, r"card|amex|credit|debit|karte|tarjeta|carte", False),
)
#: Every kind's matches have one of these.
ANY = "[0-9@]"
SPAN = "struct<kind:string,start:bigint,end:bigint,score:double>"
BLOCK = 256


def _sums(xs: Column, begin: Column) -> Column:
    """Running sums of a short array."""
    return F.aggregate(xs, F.array().cast("array<bigint>"), lambda acc, x: F.array_append(acc, F.coalesce(F.try_element_at(acc, F.lit(-1)), begin) + x))


def _place_matches(docs: DataFrame, text: Column, patterns: list[tuple[str, str]]) -> DataFrame:
    """``docs`` with ``__pd_found``: by pattern, the matches with place and what stands around them; null where there is none.

    Each step is a column of its own, so nothing is worked out twice.  The
    running sum goes by blocks; no long array is copied for each entry.
    """
    ks = range(len(patterns))
    col = lambda part, k: F.col(f"__pd_{part}")[f"k{k}"]
    def step(df: DataFrame, part: str, of: Callable[[int], Column]) -> DataFrame:
        return df.withColumn(f"__pd_{part}", F.struct(*[of(k).alias(f"k{k}") for k in ks]))

    zero = F.lit(0).cast("bigint")
    docs = step(docs, "cut", lambda k: F.when(text.rlike(ANY) & text.rlike(patterns[k][0]), F.struct(
        F.regexp_extract_all(text, F.lit(patterns[k][1]), F.lit(0)).alias("m"), F.split(text, patterns[k][1], -1).alias("p"))))
    docs = step(docs, "steps", lambda k: F.transform(col("cut", k)["m"], lambda x, i: (
        F.length(F.get(col("cut", k)["p"], i)) + F.when(i == 0, F.lit(0)).otherwise(F.length(F.get(col("cut", k)["m"], i - 1)))).cast("bigint")))
    docs = step(docs, "parts", lambda k: F.when(F.size(col("steps", k)) > 0, F.transform(
        F.sequence(F.lit(1), F.size(col("steps", k)), F.lit(BLOCK)), lambda i: F.slice(col("steps", k), i, F.lit(BLOCK)))))
    docs = step(docs, "ends", lambda k: _sums(F.transform(col("parts", k), lambda p: F.aggregate(p, zero, lambda a, x: a + x)), zero))
    docs = step(docs, "starts", lambda k: F.flatten(F.transform(col("parts", k), lambda p, i: _sums(
        p, F.when(i == 0, zero).otherwise(F.get(col("ends", k), i - 1))))))
    return step(docs, "found", lambda k: F.transform(col("cut", k)["m"], lambda m, i: F.struct(
        m.alias("m"), F.get(col("starts", k), i).alias("start"), F.lower(F.concat(
            F.right(F.get(col("cut", k)["p"], i), F.lit(NEAR)), F.lit("\n"), F.left(F.get(col("cut", k)["p"], i + 1), F.lit(NEAR)))).alias("near"))))


def _accepted(found: Column, kind: Kind) -> Column:
    """The spans of those matches that the kind's validator and score let pass."""
    own = kind.score + (CHECKSUM_WEIGHT if kind.checksum else 0.0)

    def span(x: Column) -> Column:
        score = F.when(x["near"].rlike(kind.context), F.lit(round(min(1.0, own + CONTEXT_WEIGHT), 2))).otherwise(F.lit(round(own, 2)))
        return F.struct(F.lit(kind.name).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["m"])).alias("end"), score.alias("score"))

    spans = F.transform(F.filter(found, lambda x: kind.valid(x["m"])), span)
    return spans if kind.base else F.filter(spans, lambda s: s["score"] >= LEAST_SCORE)


def find_personal_data(docs: DataFrame, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """``docs`` with an array of (kind, start, end, score) by kind as in ``KINDS``, then start; places in code points, end exclusive."""
    parts = ("cut", "steps", "parts", "ends", "starts", "found")
    docs = fresh(docs, [out_col, *[f"__pd_{p}" for p in parts]], [text_col])
    patterns = list(dict.fromkeys((k.hint, k.pattern) for k in KINDS))
    placed = _place_matches(docs, F.col(text_col), patterns)
    none = F.array().cast(f"array<{SPAN}>")
    spans = [F.coalesce(_accepted(F.col("__pd_found")[f"k{patterns.index((k.hint, k.pattern))}"], k), none) for k in KINDS]
    return placed.select(*docs.columns, F.concat(*spans).alias(out_col))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
