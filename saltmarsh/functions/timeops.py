"""Time columns: several input formats, UTC shift, day numbers and ISO text. All are TIMESTAMP_NTZ expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every character that Unicode counts as white space, and U+001C to U+001F.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"
EPOCH = "1992-01-01 00:00:00"

_MONTH, _DAY, _HOUR = "(1[0-2]|0[1-9]|[1-9])", "(3[01]|[12][0-9]|0[1-9]|[1-9])", "(2[0-3]|[01][0-9]|[0-9])"
_SIXTY, _SECOND = "([0-5][0-9]|[0-9])", "(6[01]|[0-5][0-9]|[0-9])"
#: Parts of one or two digits: year-month-day or year/month/day, blanks or T, time.
_LOOSE = rf"(?is)^(\d{{4}})([-/]){_MONTH}\2{_DAY}(?:\s+|T){_HOUR}:{_SIXTY}:{_SECOND}(.*)$"
#: The same without separators: each part takes two digits where it can and leaves one for each that follows.
_DIGITS = rf"(?s)^(\d{{4}}){_MONTH}{_DAY}{_HOUR}{_SIXTY}{_SECOND}(.*)$"
#: ISO 8601: calendar or week date, with or without separators, then any one character and a time, and an offset.
_ISO = (
    r"(?s)^(\d{4})(?:-(\d\d)-(\d\d)|(\d\d)(\d\d)|-?W(\d\d)(?:-?(\d))?)"
    r"(?:.(\d\d)(?::(\d\d)(?::(\d\d))?|(\d\d)(\d\d)?)?(?:[.,](\d+))?(?: ?([+-])(\d\d)(?::?(\d\d)(?::?(\d\d))?)?)?)?$"
)


def trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def let(value: Column, use) -> Column:
    """``use(value)``, with the value made once and standing in the plan once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _groups(text: Column, pattern: str, n: int) -> Column:
    """What the first n groups matched, empty for those that took no part; null where the pattern doesn't fit.

    The pattern runs once to see and once to take all groups apart, whatever their number.
    """
    apart = F.regexp_replace(text, F.lit(pattern), F.lit("\x01".join(f"${k}" for k in range(1, n + 1))))
    return F.when(text.rlike(pattern), F.split(apart, "\x01", n))


def _number(groups: Column, *at: int) -> Column:
    """The first of the groups that isn't empty, as a number; null if all are."""
    return F.concat(*(groups[k - 1] for k in at)).try_cast("int")


def _moment(y: Column, mo: Column, d: Column, h: Column, mi: Column, s: Column) -> Column:
    return F.when(s < 60, F.try_make_timestamp_ntz(y, mo, d, h, mi, s.cast("decimal(16,6)")))


def _date_of(g: Column) -> Column:
    """The date in the groups of _ISO; a week without day starts on Monday."""
    year, week = _number(g, 1), _number(g, 6)
    first = F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4))).cast("date")
    by_week = F.date_add(first, (week - 1) * 7 + F.coalesce(_number(g, 7), F.lit(1)) - 1)
    fits = (week >= 1) & F.coalesce(_number(g, 7).between(1, 7), F.lit(True)) & (F.extract(F.lit("YEAROFWEEK"), by_week) == year)
    return F.when(week.isNotNull(), F.when(fits, by_week)).otherwise(F.try_make_timestamp_ntz(year, _number(g, 2, 4), _number(g, 3, 5), *map(F.lit, (0, 0, 0))).cast("date"))


def iso_time(text: Column) -> Column:
    """struct(parsed, tz) of an ISO 8601 text whose ``Z`` is spelled ``+00:00``; parsed is null for anything else.

    tz is ``+hh:mm`` or ``+hh:mm:ss``, or null without an offset. Digits of the second beyond the sixth are cut off.
    """
    zero = lambda c: F.coalesce(c, F.lit(0))

    def timed(p: Column) -> Column:
        g = p["g"]
        fraction = F.rpad(F.substring(g[12], 1, 6), 6, "0").try_cast("int")
        second = zero(_number(g, 10, 12)) + fraction / F.lit(1_000_000).cast("decimal(8,0)")
        h, m, s = (zero(_number(g, k)) for k in (15, 16, 17))
        d = p["date"]
        moment = _moment(F.year(d), F.month(d), F.day(d), zero(_number(g, 8)), zero(_number(g, 9, 11)), second)
        sign = F.when(h + m + s == 0, "+").otherwise(g[13])
        tz = F.concat(sign, F.format_string("%02d:%02d", h, m), F.when(s > 0, F.format_string(":%02d", s)).otherwise(""))
        parsed = F.when((F.year(d) > 0) & (h < 24) & (m < 60) & (s < 60), moment)
        return F.struct(parsed.alias("parsed"), F.when(parsed.isNotNull() & (g[13] != ""), tz).alias("tz"))

    return let(_groups(text, _ISO, 17), lambda g: let(F.struct(g.alias("g"), _date_of(g).alias("date")), timed))


def read_time(text: Column) -> Column:
    """struct(parsed, tz) of a text in any accepted layout; parsed is null for anything else.

    Layouts: year, month, day and time with ``-`` or ``/`` and parts of one or two digits; the same as digits alone
    (9 to 14); ISO 8601. Only the last carries an offset, ``Z`` or ``+hh:mm``.
    """
    t = F.replace(trimmed(text), F.lit("Z"), F.lit("+00:00"))
    loose = lambda g: F.when(g[7] == "", _moment(*(_number(g, k) for k in (1, 3, 4, 5, 6, 7))))
    digits = lambda g: F.when(g[6] == "", _moment(*(_number(g, k) for k in range(1, 7))))
    plain = F.coalesce(let(_groups(t, _LOOSE, 8), loose), let(_groups(t, _DIGITS, 7), digits))
    at = F.struct(plain.alias("parsed"), F.lit(None).cast("string").alias("tz"))
    return let(at, lambda p: F.when(p["parsed"].isNotNull(), p).otherwise(iso_time(t)))


def parse_time(text: Column) -> Column:
    """Local time of a text; see ``read_time``."""
    return read_time(text)["parsed"]


def offset_of(text: Column) -> Column:
    """The UTC offset that a time text carries; see ``read_time``."""
    return read_time(text)["tz"]


def to_utc(local: Column, hours: float) -> Column:
    return local - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600.0).cast("decimal(18,6)"))


def day_number(utc: Column) -> Column:
    """Days since EPOCH, to the microsecond."""
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), utc).cast("double") / 86_400_000_000.0


def midpoint(start: Column, end: Column) -> Column:
    """Half of the time between them after ``start``; half a microsecond rounds to even."""
    apart = F.timestamp_diff("MICROSECOND", start, end)
    half = F.floor(apart / F.lit(2)).cast("long")
    odd = F.when((F.pmod(apart, F.lit(2)) == 1) & (F.pmod(half, F.lit(2)) == 1), 1).otherwise(0)
    return F.timestamp_add("MICROSECOND", half + odd, start)


def iso_text(t: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with six digits of the second where they aren't zero."""
    whole, part = F.date_format(t, "yyyy-MM-dd HH:mm:ss"), F.date_format(t, "SSSSSS")
    return F.when(part == "000000", whole).otherwise(F.concat(whole, F.lit("."), part))
