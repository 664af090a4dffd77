"""Scalar functions of spreadsheet formulas as total Column expressions.

A cell's value is a struct `num double, txt string`: one of the two is set, and
both are null for a blank cell or an error. None of these functions raises,
whatever its input (ANSI mode stays on); an error is null. Everything is built
from Spark's own functions, so that it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
NUMBER_PREFIX = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def null(kind: str = "double") -> Column:
    return F.lit(None).cast(kind)


# ---------------------------------------------------------------- cell values
def cell(num: Column | None = None, txt: Column | None = None) -> Column:
    """A cell value from a number or a text."""
    return F.struct((null() if num is None else num.cast("double")).alias("num"), (null("string") if txt is None else txt.cast("string")).alias("txt"))


def is_blank(v: Column) -> Column:
    return v["num"].isNull() & v["txt"].isNull()


def text_number(s: Column) -> Column:
    """A text as a number: blank text is 0, anything that isn't wholly a decimal number is null."""
    return F.when(F.trim(s) == "", 0.0).when(s.rlike(NUMBER), F.trim(s).try_cast("double"))


def number_prefix(s: Column) -> Column:
    """A text as the number that it begins with, else 0; null stays null."""
    return F.when(s.isNotNull(), F.coalesce(F.regexp_extract(s, NUMBER_PREFIX, 0).try_cast("double"), F.lit(0.0)))


def operand(v: Column) -> Column:
    """A cell as an operand: its number, or its text as one."""
    return F.coalesce(v["num"], text_number(v["txt"]))


def number_or_zero(v: Column) -> Column:
    """N(): the number, 0 for texts and blanks."""
    return F.coalesce(v["num"], F.lit(0.0))


def is_number(v: Column) -> Column:
    """ISNUMBER(): 1 for a number, 0 for anything else, also for a text that looks like one."""
    return v["num"].isNotNull().cast("double")


def truthy(v: Column) -> Column:
    """Numbers but 0 and texts but the empty one are true; blanks and errors are false."""
    return F.coalesce(v["num"] != 0, v["txt"] != "", F.lit(False))


def if_else(condition: Column, then: Column, other: Column) -> Column:
    return F.when(truthy(condition), then).otherwise(other)


def all_of(*conditions: Column) -> Column:
    """AND() as 1 or 0."""
    out = F.lit(True)
    for c in conditions:
        out = out & truthy(c)
    return out.cast("double")


def compare(a: Column, relation: str, b: Column) -> Column:
    """=, <>, <, <=, >, >= of two cells as 1 or 0: equality by text if either is one, order by numbers with 0 for the rest."""
    if relation in ("=", "<>"):
        texts = general_text(a).eqNullSafe(general_text(b))
        same = F.when(a["txt"].isNotNull() | b["txt"].isNotNull(), texts).otherwise(a["num"].eqNullSafe(b["num"]))
        return (same if relation == "=" else ~same).cast("double")
    x, y = F.coalesce(operand(a), F.lit(0.0)), F.coalesce(operand(b), F.lit(0.0))
    return {"<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y}[relation].cast("double")


# ----------------------------------------------------------------- arithmetic
#: From here on every double is a whole number, and the next ones no longer fit a long.
WHOLE = float(2**53)


def floor(x: Column) -> Column:
    """The largest whole number that isn't greater, as a double of any size."""
    return F.when(F.abs(x) < WHOLE, F.floor(x).cast("double")).otherwise(x)


def divide(a: Column, b: Column) -> Column:
    """a / b; an error (null) where b is 0."""
    return F.try_divide(a, b)


def percent(a: Column) -> Column:
    return a / F.lit(100.0)


def quotient(a: Column, b: Column) -> Column:
    """The whole part of a / b, towards zero."""
    q = F.try_divide(a, b)
    return F.when(q >= 0, floor(q)).otherwise(-floor(-q))


def modulo(a: Column, b: Column) -> Column:
    """The remainder with the divisor's sign."""
    return a - b * floor(F.try_divide(a, b))


def fifteen_digits(x: Column) -> Column:
    """x to 15 significant decimal digits, as spreadsheets compare numbers."""
    return F.format_string("%.14e", x).try_cast("double")


def round_half_away(x: Column, digits: int | Column = 0) -> Column:
    """ROUND(): halves away from zero, judged on 15 significant digits."""
    # No double has more places: beyond them, nothing is left to round, or nothing is left.
    d = F.lit(float(digits)) if isinstance(digits, int) else digits.cast("double")
    f = F.pow(F.lit(10.0), F.greatest(F.least(d, F.lit(308.0)), F.lit(-308.0)))
    n = fifteen_digits(x * f)
    rounded = F.signum(n) * F.when(F.abs(n) < WHOLE, floor(F.abs(n) + 0.5)).otherwise(F.abs(n)) / f + F.lit(0.0)
    return F.when(~F.isnan(x) & ~F.isnan(d), F.when(F.abs(x * f) == float("inf"), x).otherwise(rounded))


#: A format with more decimals is an error.
MOST_DECIMALS = 127


def text_fixed(x: Column, decimals: int | Column = 0, group: bool = False) -> Column:
    """TEXT() with a format of digits: rounded, with fixed decimals, in groups of three if asked; non-numbers count as 0; an unknown number of decimals is an error."""
    whole = "#,##0" if group else "0"
    if isinstance(decimals, int):
        pattern = F.lit(whole + ("." + "0" * decimals if decimals else ""))
    else:
        some = F.when(decimals > 0, F.least(decimals, F.lit(MOST_DECIMALS)).cast("int")).otherwise(0)
        pattern = F.when(decimals <= MOST_DECIMALS, F.when(some > 0, F.concat(F.lit(whole + "."), F.repeat(F.lit("0"), some))).otherwise(whole))
    return F.call_function("format_number", round_half_away(F.coalesce(x, F.lit(0.0)), decimals), pattern)


def number_value(s: Column) -> Column:
    """NUMBERVALUE(): without group separators, with a trailing % as hundredths; null if empty or no number."""
    bare = F.trim(F.regexp_replace(s, ",", ""))
    share = bare.endswith("%")
    digits = F.regexp_replace(bare, "%$", "")
    value = F.when(digits.rlike(NUMBER), digits.try_cast("double"))
    return F.when(share, value / 100.0).otherwise(value)


# ----------------------------------------------------------------------- texts
def general_number(x: Column) -> Column:
    """A number as text: up to 15 significant digits, no trailing zeros, whole numbers without a point; with an exponent below 1e-6 and from 1e21."""
    d, shown = fifteen_digits(x), F.format_string("%.14e", x)
    trimmed = lambda s: F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    whole = d.try_cast("decimal(22,0)").cast("string")
    part = trimmed(d.try_cast("decimal(38,21)").cast("string"))
    power = F.regexp_extract(shown, r"e([+-])0*(\d+)$", 1), F.regexp_extract(shown, r"e([+-])0*(\d+)$", 2)
    far = F.concat(trimmed(F.regexp_extract(shown, r"^(-?[\d.]+)e", 1)), F.lit("e"), *power)
    size = F.abs(d)
    return F.when(F.isnan(d) | (size == float("inf")), F.lit(None)).when(d == 0, "0").when((size >= 1e21) | (size < 1e-6), far).when(d == floor(d), whole).otherwise(part)


def general_text(v: Column) -> Column:
    return F.coalesce(v["txt"], general_number(v["num"]))


def concat(*values: Column) -> Column:
    """&: null if any part is blank or an error."""
    return F.concat(*map(general_text, values))


def substitute(s: Column, find: Column, put: Column) -> Column:
    return F.when(find == "", s).otherwise(F.replace(s, find, put))


def left(s: Column, n: Column) -> Column:
    return F.when((n >= 0) & ~F.isnan(n), F.left(s, F.least(n, F.length(s)).cast("int")))


def right(s: Column, n: Column) -> Column:
    return F.when((n >= 0) & ~F.isnan(n), F.right(s, F.least(n, F.length(s)).cast("int")))


def find(needle: Column, s: Column) -> Column:
    """FIND(): place from 1, case-sensitive, null if missing."""
    return F.nullif(F.position(needle, s), F.lit(0)).cast("double")


def ascii_fold(s: Column) -> Column:
    """Lower case of A to Z alone."""
    return F.translate(s, UPPER, LOWER)


def unescape(s: Column) -> Column:
    """~*, ~? and ~~ stand for the character itself."""
    return F.regexp_replace(s, r"~([~*?])", "$1")


def literal_needle(s: Column) -> Column:
    """What a lookup searches: escapes undone; an error (null) if that leaves a pattern, which lookups do not have."""
    plain = unescape(s)
    return F.when(~plain.rlike(r"[*?]"), plain)


def has_wildcard(s: Column) -> Column:
    return F.regexp_replace(s, r"~[~*?]", "").rlike(r"[*?]")


def if_error(v: Column, fallback: Column) -> Column:
    """IFERROR(): the fallback for blanks and errors."""
    return F.coalesce(v, fallback)


def zero_dash(v: Column) -> Column:
    """IF(x=0,"-",x): a dash for 0, blanks, errors and texts that are no number."""
    return F.when(F.coalesce(operand(v), F.lit(0.0)) == 0, cell(txt=F.lit("-"))).otherwise(v)


# ------------------------------------------------------------------ comparison
def same_value(expected: Column, got: Column) -> Column:
    """Whether a computed cell equals a published one: numbers to a relative 1e-9; texts exactly; a grouped number as text may stand for a published number."""
    e_blank, g_blank = is_blank(expected), is_blank(got)
    grouped = F.when(got["txt"].rlike(r"^-?\d{1,3}(,\d{3})*(\.\d+)?$"), F.regexp_replace(got["txt"], ",", "").try_cast("double"))
    near = lambda a, b: F.abs(a - b) <= 1e-9 * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
    return (
        F.when(e_blank | g_blank, e_blank & g_blank)
        .when(expected["txt"].isNotNull() & got["txt"].isNotNull(), expected["txt"] == got["txt"])
        .when(expected["num"].isNotNull() & got["num"].isNotNull(), near(expected["num"], got["num"]))
        .when(expected["num"].isNotNull() & grouped.isNotNull(), near(expected["num"], grouped))
        .otherwise(general_text(expected) == general_text(got))
    )


def round_half_up(x: Column, decimals: int = 0) -> Column:
    """Plain rounding of printed tables: floor(x + 1/2)."""
    p = 10.0**decimals
    return floor(x * p + 0.5) / p
