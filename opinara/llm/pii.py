"""Personal data: patterns propose spans, checks confirm them, nearby words adjust the score.

Per kind, ``regexp_extract_all`` gives the matches and ``split`` the text between them;
a span's start is the length of all that comes before. Checksums and ranges confirm a match.
The score starts at the kind's own, rises with a passed checksum and with a word
of the kind's context next to the span; spans of the kinds that need it are
reported from ``LEAST_SCORE`` on. Email, address, card and phone are always reported.

Column expressions only; every row is worked on where it lies.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import once, sums_before

#: Characters looked at on each side of a span for context words.
CONTEXT = 40
#: Points for a passed checksum and for a context word.
CHECKSUM, NEARBY = 0.4, 0.3
LEAST_SCORE = 0.6

Check = Callable[[Column], Column]


def digits_of(text: Column) -> Column:
    return F.translate(text, " +().-", "")


def luhn(text: Column) -> Column:
    """12 to 19 digits whose Luhn sum is divisible by 10."""

    def valid(number: Column) -> Column:
        def value(i: Column) -> Column:
            digit = F.substring(number, F.length(number) - i, F.lit(1)).cast("int") * (1 + i % 2)
            return F.when(digit > 9, digit - 9).otherwise(digit)

        total = F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), lambda s, i: s + value(i))
        return F.when(F.length(number).between(12, 19), total % 10 == 0).otherwise(F.lit(False))

    return once(digits_of(text), valid)


def mod_97(text: Column) -> Column:
    """The number of an account whose letters count from 10 and whose first four characters go last leaves 1."""

    def valid(plain: Column) -> Column:
        turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
        step = lambda s, c: F.when(c.between("0", "9"), (s * 10 + c.cast("int")) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97)
        return F.aggregate(F.split(turned, ""), F.lit(0), lambda s, c: F.when(c == "", s).otherwise(step(s, c))) == 1

    return once(F.translate(text, " ", ""), valid)


def small_parts(text: Column) -> Column:
    """Each number between dots is 255 at most."""
    part = lambda p: F.when(F.length(p) > 3, F.lit(False)).when(p == "", F.lit(True)).otherwise(p.cast("int") <= 255)
    return F.forall(F.split(text, "\\."), lambda p: part(F.ltrim(p, F.lit("0"))))


def phone_length(text: Column) -> Column:
    return F.length(digits_of(text)).between(9, 15)


def issued(text: Column) -> Column:
    """Not one of the number ranges that are never issued."""
    return ~text.rlike("^(000|666|9)") & (F.substring(text, 5, 2) != "00") & (F.substring(text, 8, 4) != "0000")


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``needs`` is a character without which a text has no match. ``bounded`` spans have
    no letter or digit next to them. ``base`` kinds are reported whatever the score.
    """

    name: str
    pattern: str
    score: float
    words: str
    check: Check | None = None
    checksum: bool = False
    needs: str | None = None
    bounded: bool = False
    base: bool = True


#: Countries by the length of their account numbers (IBAN registry).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FO FI GL NL FK SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG DJ",
    25: "LY PT ST", 26: "IS TR", 27: "BI FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: A number of a listed country, at its whole length.
LISTED = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
LISTED = rf"(?:{LISTED})(?![A-Za-z0-9])"
#: Any other run of that form, up to where a number of a listed country starts.
OTHER = rf"[A-Z]{{2}}[0-9]{{2}}(?:(?!\x20{LISTED})\x20?[A-Z0-9]){{11,30}}"

#: In the order in which spans of one start are listed. Groups that repeat are possessive:
#: nothing follows them that a shorter repetition could help, and they need no stack. The
#: email pattern starts only where a run of its characters does, or the last match ended.
KINDS = (
    Kind(
        "email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.7,
        "mail|contact|write", needs="@",
    ),
    Kind("ip", r"[0-9]++(?:\.[0-9]++){3}", 0.5, "ip|host|server|address", small_parts, needs="."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.4, "card|visa|credit|payment|pay", luhn, checksum=True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.5, "phone|call|tel|mobile|fax", phone_length, needs="+"),
    Kind(
        "iban", rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{LISTED}|{OTHER})", 0.3, "iban|account|bank|transfer|konto", mod_97,
        checksum=True, bounded=True, base=False,
    ),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3, "ssn|social|security", issued, needs="-", bounded=True, base=False),
    Kind("tel", r"[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}", 0.3, "phone|call|tel|mobile|fax", bounded=True, base=False),
)


SPAN = "array<struct<start: int, rank: int, kind: string, stop: int, score: double>>"


def spans_of(text: Column, kind: Kind, rank: int) -> Column:
    """The reported spans of one kind."""
    nothing = F.lit(None).cast(SPAN)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    if kind.needs:
        matches = F.when(F.contains(text, F.lit(kind.needs)), matches)

    def placed(found: Column, between: Column) -> Column:
        count = F.size(found)
        gaps = F.transform(F.slice(between, F.lit(1), count), lambda x: F.length(x))
        steps = F.zip_with(found, gaps, lambda m, g: F.length(m) + g)
        return once(gaps, lambda g: once(sums_before(steps), lambda before: F.zip_with(before, g, lambda b, gap: b + gap)))

    def judged(found: Column, between: Column, at: Column) -> Column:
        def span(match: Column, i: Column) -> Column:
            before, after = F.get(between, i), F.get(between, i + 1)
            near = F.lower(F.concat(F.right(before, F.lit(CONTEXT)), F.lit(" "), F.left(after, F.lit(CONTEXT))))
            passed = kind.check(match) if kind.check else F.lit(True)
            if kind.bounded:
                edges = F.concat(F.right(before, F.lit(1)), F.left(after, F.lit(1)))
                passed = passed & ~edges.rlike("[A-Za-z0-9]")
            score = F.lit(kind.score + CHECKSUM * kind.checksum) + F.when(near.rlike(kind.words), NEARBY).otherwise(0.0)
            start = F.get(at, i)
            built = lambda s: F.struct(
                start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"), (start + F.length(match)).alias("stop"), s.alias("score")
            )
            least = F.lit(True) if kind.base else score >= LEAST_SCORE
            return F.when(passed & least, built(F.round(F.least(score, F.lit(1.0)), 2)))

        return F.filter(F.transform(found, span), lambda x: x.isNotNull())

    def located(found: Column) -> Column:
        between = F.split(text, kind.pattern, -1)
        return once(between, lambda b: once(placed(found, b), lambda at: judged(found, b, at)))

    return F.coalesce(once(matches, lambda found: F.when(F.size(found) > 0, located(found)).otherwise(nothing)), F.array().cast(SPAN))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and ``found``, the reported spans in order.

    A span has ``start`` and ``stop`` (code points, end exclusive), ``kind``, ``score`` and
    ``rank``, the kind's place among those of one start. Matches of one kind don't overlap;
    spans of two kinds may. Null and empty texts have none. Rows that
    repeat are searched each. Other columns are left out. An empty table gives none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = [spans_of(F.col("_text"), kind, rank) for rank, kind in enumerate(KINDS)]
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    return rows.select(F.col("_id").alias(id_col), F.explode(F.array(F.array_sort(F.concat(*kinds)))).alias("found"))


def span_list(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")
