"""Column helpers: every scalar rule of the jobs, as native expressions (no UDFs)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes and labels of the registration logs.
REGISTER_SOURCES = {"1": "PC", "2": "Mobile", "3": "App", "4": "WeChat"}
REGISTER_SOURCE_OTHER = "other"
APP_PLATFORMS = {"1": "PC", "2": "APP"}
APP_PLATFORM_OTHER = "Other"

# Upper bounds of the score bands; each band is (previous, bound], the first one includes 0.
SCORE_BANDS = {20: "0-20", 40: "20-40", 60: "40-60", 80: "60-80", 100: "80-100"}

REDACTED = "******"
OPEN_END = "9999-12-31"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label(code: Column | str, labels: Mapping[str, str], other: str) -> Column:
    """Code to label; unknown and null codes give ``other``."""
    code = _col(code)
    out = None
    for key, text in labels.items():
        out = F.when(code == key, text) if out is None else out.when(code == key, text)
    return out.otherwise(other)


def mask_name(name: Column | str) -> Column:
    return F.concat(F.substring(_col(name), 1, 1), F.lit("xx"))


def mask_phone(phone: Column | str) -> Column:
    phone = _col(phone)
    return F.concat(F.substring(phone, 1, 3), F.lit("*****"), F.substring(phone, 8, 4))


# A failed cast raises and catches an exception inside Spark, some fifty times the price of a regex that fails. Log
# fields are therefore looked at before they are cast.
_WHOLE = r"^\s*[-+]?[0-9]+\s*$"
# three significant digits of exponent are past every decimal type: such a number is told apart before the cast, which
# would else write it out digit by digit
_MANTISSA = r"^\s*[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)"
_DECIMAL = _MANTISSA + r"([eE][-+]?0*[0-9]{1,2})?\s*$"
_VANISHING = _MANTISSA + r"[eE]-0*[1-9][0-9]{2,}\s*$"


def whole_number(text: Column | str) -> Column:
    """Integer text as int, anything else null."""
    text = _col(text)
    return F.when(text.rlike(_WHOLE), text.try_cast("int"))


def decimal_number(text: Column | str, precision: int, scale: int) -> Column:
    """Decimal text rounded half up to ``scale``, anything else (and what does not fit) null."""
    text, kind = _col(text), f"decimal({precision},{scale})"
    return F.when(text.rlike(_DECIMAL), text.try_cast(kind)).when(text.rlike(_VANISHING), F.lit(0).cast(kind))


def int_or_zero(text: Column | str) -> Column:
    """Integer field of a log: absent or malformed gives 0; a fraction is cut off."""
    text = _col(text)
    return F.coalesce(whole_number(text), decimal_number(text, 38, 10).try_cast("int"), F.lit(0))


def score_1dp(text: Column | str) -> Column:
    """Score with one decimal, rounded half up from the text (never through a double); absent gives 0.0."""
    return F.coalesce(decimal_number(text, 10, 1), F.lit(0).cast("decimal(10,1)"))


def money(text: Column | str) -> Column:
    """Amount text with four decimals."""
    return decimal_number(text, 10, 4)


def dashed_date(yyyymmdd: Column | str) -> Column:
    """``yyyyMMdd`` to ``yyyy-MM-dd``."""
    return F.date_format(F.to_date(_col(yyyymmdd), "yyyyMMdd"), "yyyy-MM-dd")


def now_text() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")


def day_of_millis(millis: Column | str) -> Column:
    """Epoch milliseconds to the ``yyyyMMdd`` day in the session time zone."""
    return F.date_format(F.timestamp_millis(_col(millis).cast("long")), "yyyyMMdd")


def score_band(score: Column | str) -> Column:
    """Band label of a score in [0, 100]; anything else gives null."""
    score = _col(score)
    out, low = None, 0
    for bound, text in SCORE_BANDS.items():
        inside = score.between(0, bound) if out is None else (score > low) & (score <= bound)
        out = F.when(inside, text) if out is None else out.when(inside, text)
        low = bound
    return out


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as decimal(4,2); null when ``whole`` is 0."""
    return (_col(part) / F.nullif(_col(whole), F.lit(0))).cast("decimal(4,2)")


def whole_div(a: Column | str, b: Column | str) -> Column:
    """Integer division cut towards zero; null for a zero or null divisor."""
    return F.call_function("div", _col(a), F.nullif(_col(b), F.lit(0)))


def watch_seconds(ts: Column | str, te: Column | str) -> Column:
    """Whole seconds between two epoch-millisecond stamps, cut towards zero."""
    return whole_div(_col(te) - _col(ts), F.lit(1000))


def percent_text(part: Column | str, whole: Column | str) -> Column:
    """Percent without decimals, half-even; a zero or missing denominator gives ``0%``."""
    part, whole = _col(part), _col(whole)
    value = F.bround(part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * 100, 0).cast("long")
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit("0%")).otherwise(
        F.concat(F.coalesce(value, F.lit(0)).cast("string"), F.lit("%"))
    )


def region_province(region: Column | str) -> Column:
    """Third field of ``country|area|province|city|isp``."""
    return F.get(F.split(_col(region), r"\|"), F.lit(2))


def clean_text(text: Column | str) -> Column:
    """Strip leading digits and every dot."""
    return F.regexp_replace(F.regexp_replace(_col(text), "^[0-9]+", ""), "[.]+", "")


def tokens(text: Column | str) -> Column:
    """Tokens between single spaces; trailing empty tokens are dropped, inner ones kept; spaces alone give none."""
    text = _col(text)
    cut = F.split(F.regexp_replace(text, " +$", ""), " ")
    return F.when(text.rlike("^ +$"), F.array().cast("array<string>")).otherwise(cut)


def ipv4_number(ip: Column | str) -> Column:
    """Dotted IPv4 to its number; null when it is not one."""
    parts = F.split(_col(ip), r"\.")
    octets = [F.get(parts, F.lit(i)).try_cast("long") for i in range(4)]
    valid = F.size(parts) == 4
    for octet in octets:
        valid = valid & octet.between(0, 255)
    return F.when(valid, octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3])
