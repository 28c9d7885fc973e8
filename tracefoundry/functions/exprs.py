"""Column expressions with the results of Python's built-ins.

Spark's own ``round``, string casts, ``trim`` and ``split`` differ from
Python's in rounding of ties, number formats and white space; these
expressions agree with Python and stay inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's str.split() and str.strip() take as white space.
SPACES = r"[\s\x1c-\x1f\x85\xa0  -     　]"
_NUMBER = r"^[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"


def fixed(x: Column, digits: int) -> Column:
    """``f"{x:.{digits}f}"``: ties as the exact binary value has them."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", x.cast("double"), F.lit(pattern))


def grouped(x: Column, digits: int) -> Column:
    """``f"{x:,.{digits}f}"``."""
    return F.format_number(x.cast("double"), digits)


def signed(x: Column, digits: int) -> Column:
    """``f"{x:+.{digits}f}"``."""
    return F.concat(F.when(x >= 0, F.lit("+")).otherwise(F.lit("")), fixed(x, digits))


def rounded(x: Column, digits: int) -> Column:
    """``round(x, digits)`` of a float; null, NaN and infinities pass.

    ``format_number`` takes the shortest digits of numbers below one unit of
    the last place, so whether their tie goes up is decided here.
    """
    plain = fixed(x, digits).cast("double")
    unit, size = 10.0**-digits, F.abs(x)
    half = 0.5 * unit
    up = size >= half if round(half, digits) else size > half
    small = F.signum(x) * F.when(up, F.lit(round(unit, digits))).otherwise(F.lit(0.0))
    return F.when(F.isnan(x) | (size == float("inf")), x).when(size < unit, small).otherwise(plain)


def float_text(x: Column) -> Column:
    """``str(x)`` of a float: plain between 1e-4 and 1e16, else with a two-digit exponent."""
    text = x.cast("double").cast("string")
    mantissa, power = F.substring_index(text, "E", 1), F.substring_index(text, "E", -1)
    plain = F.regexp_replace(F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", ".0")
    digits = F.regexp_replace(power, "^-", "")
    exponent = F.concat(F.when(power.startswith("-"), F.lit("-")).otherwise(F.lit("+")), F.lpad(digits, F.greatest(F.length(digits), F.lit(2)), "0"))
    scientific = F.concat(F.regexp_replace(mantissa, r"\.0$", ""), F.lit("e"), exponent)
    size = F.abs(x.cast("double"))
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(size == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def strip(x: Column) -> Column:
    """``x.strip()``."""
    return F.regexp_replace(x, f"^{SPACES}+|{SPACES}+$", "")


def micros(x: Column) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone."""
    return F.unix_micros(x.cast("timestamp"))


def word_count(x: Column) -> Column:
    """``len(x.split())``."""
    return F.size(F.filter(F.split(x, f"{SPACES}+"), lambda w: w != F.lit("")))


def parse_float(x: Column) -> Column:
    """``float(x)``; null where Python raises."""
    text = strip(x)
    bare = F.regexp_replace(text, "_", "")
    special = F.lower(F.regexp_replace(text, r"^[+-]", ""))
    sign = F.when(text.startswith("-"), -1.0).otherwise(1.0)
    return (
        F.when(text.rlike(_NUMBER), bare.try_cast("double"))
        .when(special.isin("inf", "infinity"), sign * F.lit(float("inf")))
        .when(special == "nan", F.lit(float("nan")))
    )


def truthy(x: Column) -> Column:
    """``bool(x)`` of a number: neither null nor zero."""
    return x.isNotNull() & (x != 0)


def present(*items: Column) -> Column:
    """The items that are not null, in order."""
    return F.array_compact(F.array(*items))


def lines(*items: Column) -> Column:
    r"""``"\n".join(items)``; null counts as empty instead of going away."""
    return F.array_join(F.array(*[F.coalesce(i, F.lit("")) for i in items]), "\n")


# ISO 8601 as datetime.fromisoformat takes it: extended date, optional time, fraction and offset
_ISO = r"^(\d{4}-\d{2}-\d{2})(?:.(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?)?)?(Z|[+-]\d{2}:?\d{2}(?::?\d{2})?)?$"


def _iso(x: Column) -> dict[str, Column]:
    text = F.regexp_replace(strip(x), "Z+$", "")
    part = lambda i: F.regexp_extract(text, _ISO, i)
    two = lambda c: F.when(c == "", F.lit("00")).otherwise(c)
    offset = F.when((part(6) == "") | (part(6) == "Z"), F.lit("+00:00")).otherwise(F.regexp_replace(part(6), r"^([+-]\d{2}):?(\d{2})", "$1:$2"))
    clock = F.concat(part(1), F.lit("T"), two(part(2)), F.lit(":"), two(part(3)), F.lit(":"), two(part(4)))
    return {"ok": text.rlike(_ISO), "clock": clock, "micros": F.rpad(F.substring(part(5), 1, 6), 6, "0"), "offset": offset}


def parse_iso(x: Column) -> Column:
    """Timestamp of an ISO 8601 text; one without offset is UTC; null where Python raises."""
    p = _iso(x)
    text = F.concat(p["clock"], F.lit("."), p["micros"], p["offset"])
    return F.when(p["ok"], text.try_cast("timestamp"))


def parse_iso_or_2020(x: Column) -> Column:
    """Timestamp of an ISO 8601 text; 2020-01-01 where it cannot be read."""
    return F.coalesce(parse_iso(x), F.lit("2020-01-01T00:00:00+00:00").cast("timestamp"))


def iso_text(x: Column) -> Column:
    """``datetime.isoformat()`` of the time that ``x`` reads as, with its own offset."""
    p = _iso(x)
    fraction = F.when(p["micros"] == "000000", F.lit("")).otherwise(F.concat(F.lit("."), p["micros"]))
    return F.when(p["ok"], F.concat(p["clock"], fraction, p["offset"]))


def record_id(*parts: Column) -> Column:
    """A UUID-shaped digest of ``parts``, the same in every run."""
    h = F.md5(F.array_join(F.array(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), "\x1f"))
    s = lambda a, n: F.substring(h, a, n)
    variant = F.substring(F.lit("89ab"), F.pmod(F.conv(s(17, 1), 16, 10).cast("int"), F.lit(4)) + 1, F.lit(1))
    return F.concat(s(1, 8), F.lit("-"), s(9, 4), F.lit("-4"), s(14, 3), F.lit("-"), variant, s(18, 3), F.lit("-"), s(21, 12))
