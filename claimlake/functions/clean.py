"""Text -> typed column conversions used by the Silver loads.

Spark 4 runs with ANSI semantics, where ``cast``/``to_date`` raise on bad
input; the loads need bad values to become NULL so a rule can report them,
hence the ``try_`` variants throughout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FALSE_TOKENS, TRUE_TOKENS

# Characters Python's str.strip() removes (Unicode white space plus the
# ASCII separators); the ledger feeds strip these, the other feeds spaces only.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

OFFSET_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"
ISO_DATE_FORMAT = "yyyy-MM-dd"
# ISO-8601 instant with a mandatory zone ("Z" or +hh:mm), optional fraction.
ISO_ZONED_TS = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"
# Every other form of an instant: basic or extended date and time, minutes and seconds optional, any
# one character between them, offsets up to a day with or without colons and with seconds.
_TIME = r"(?:[0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?)?|[0-9]{4}(?:[0-9]{2}(?:[.,][0-9]+)?)?)"
_OFFSET = r"(?:Z|[+-](?:2[0-3]|[01][0-9])(?:(?::[0-5][0-9]){1,2}|(?:[0-5][0-9]){1,2})?)"
FLEXIBLE_ZONED_TS = rf"^(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{8}})[^0-9]{_TIME}{_OFFSET}$"
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
# Positive amount with at most two significant decimals (trailing zeros ok).
EXACT_MONEY = r"^[+]?([0-9]+(\.[0-9]{0,2}0*)?|\.[0-9]{1,2}0*)$"
# The same with an exponent.
SCIENTIFIC = r"^[+]?([0-9]*)(?:[.]([0-9]*))?[eE]([+-]?[0-9]{1,6})$"
POSITIVE_INT_TEXT = r"^[0-9]+$"


def c(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def trimmed(name: str | Column) -> Column:
    """Spark trim: strips the space character only."""
    return F.trim(c(name))


def stripped_or_null(name: str | Column) -> Column:
    """All-white-space strip, then empty -> NULL (ledger feeds)."""
    return F.nullif(F.btrim(c(name), F.lit(WHITE_SPACE)), F.lit(""))


def try_cast(name: str | Column, type_name: str) -> Column:
    return c(name).try_cast(type_name)


def strict_date(name: str | Column) -> Column:
    return F.try_to_date(c(name), ISO_DATE_FORMAT)


def offset_timestamp(name: str | Column) -> Column:
    """yyyy-MM-dd'T'HH:mm:ss with a +hh:mm / Z offset; anything else NULL."""
    return F.try_to_timestamp(c(name), F.lit(OFFSET_TS_FORMAT))


def zoned_timestamp(name: str | Column) -> Column:
    """ISO instant that must carry a zone; fraction allowed; NULL otherwise.  The usual form is parsed
    at once, the rarer ones by their parts."""
    v = c(name)
    usual = F.when(v.rlike(ISO_ZONED_TS), F.try_to_timestamp(v))
    return F.coalesce(usual, F.when(v.rlike(FLEXIBLE_ZONED_TS), _instant_by_parts(v)))


def _instant_by_parts(v: Column) -> Column:
    part = lambda pattern: F.regexp_extract(v, pattern, 1)
    date = F.regexp_replace(part("^([0-9]{4}-?[0-9]{2}-?[0-9]{2})"), "-", "")
    time = F.rpad(F.regexp_replace(part("^[0-9]{4}-?[0-9]{2}-?[0-9]{2}.([0-9:]+)"), ":", ""), 6, "0")
    fraction = F.rpad(part("[.,]([0-9]{1,6})"), 6, "0")
    local = F.try_to_timestamp(F.concat(date, F.lit(" "), time, F.lit("."), fraction, F.lit("Z")), F.lit("yyyyMMdd HHmmss.SSSSSSXXX"))
    offset = F.rpad(F.regexp_replace(part("[+-]([0-9:]+)$"), ":", ""), 6, "0")  # no sign before a zone of Z
    seconds = (F.substring(offset, 1, 2).cast("long") * 3600 + F.substring(offset, 3, 2).cast("long") * 60
               + F.substring(offset, 5, 2).cast("long")) * F.when(v.rlike("[+][0-9:]+$"), 1).otherwise(-1)
    return F.timestamp_micros(F.unix_micros(local) - F.when(v.endswith("Z"), 0).otherwise(seconds) * 1_000_000)


def tri_state(name: str | Column) -> Column:
    v = F.upper(F.trim(c(name)))
    return (
        F.when(v.isin(*TRUE_TOKENS), F.lit(True))
        .when(v.isin(*FALSE_TOKENS), F.lit(False))
        .otherwise(F.lit(None).cast("boolean"))
    )


def exact_money(name: str | Column) -> Column:
    """decimal(18,2) when the text is a positive amount with no more than two decimals (no rounding),
    else NULL.  Underscores between digits and exponents are allowed (``1_000.00``, ``1E+2``)."""
    v = F.regexp_replace(c(name), "_", "")
    amount = F.when(v.rlike(EXACT_MONEY), v.try_cast("decimal(18,2)")).when(v.rlike(SCIENTIFIC), _scientific(v))
    return F.when(amount > 0, amount)


def _scientific(v: Column) -> Column:
    """The value of mantissa and exponent, digit by digit: NULL if it has more than two decimals."""
    whole, decimals = F.regexp_extract(v, SCIENTIFIC, 1), F.regexp_extract(v, SCIENTIFIC, 2)
    kept = F.rtrim(F.concat(whole, decimals), F.lit("0"))
    zeros = F.length(whole) + F.length(decimals) - F.length(kept)
    scale = F.length(decimals) - F.regexp_extract(v, SCIENTIFIC, 3).cast("int") - zeros  # decimals of the bare digits
    digits = F.ltrim(kept, F.lit("0"))
    fits = (F.length(digits) > 0) & (scale <= 2) & (F.length(digits) - scale <= 16)
    padded = F.lpad(digits, F.greatest(F.length(digits), scale + 1), F.lit("0"))
    text = F.when(scale <= 0, F.concat(digits, F.repeat(F.lit("0"), F.greatest(-scale, F.lit(0))))).otherwise(
        F.concat(F.substring(padded, F.lit(1), F.length(padded) - scale), F.lit("."), F.substring(padded, F.length(padded) - scale + 1, scale)))
    return F.when(fits, text.try_cast("decimal(18,2)"))


def positive_int_text(name: str | Column) -> Column:
    """Digits only, 1..2147483647 -> int, else NULL (leading zeros dropped)."""
    v = c(name)
    big = v.try_cast("decimal(38,0)")
    return F.when(v.rlike(POSITIVE_INT_TEXT) & (big >= 1) & (big <= 2147483647), big.cast("int"))


def iso_utc_text(ts: Column) -> Column:
    """Render an instant the way Python's ``datetime.isoformat`` does for UTC:
    seconds always, microseconds only when non-zero, ``+00:00`` suffix."""
    return F.concat(F.regexp_replace(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", ""), F.lit("+00:00"))
