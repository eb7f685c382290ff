"""Date functions: collection windows, local dates, dates in URLs and in free text.

Timestamps are instants and the session's time zone is UTC; LOCAL names the
zone of the news day. Only the extended ISO form counts as a date string.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL, OFFSET = "Asia/Colombo", "+05:30"

_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:\d{2})?)?$"
_AWARE = r"(?:Z|[+-]\d{2}:\d{2})$"

# Names in listing dates, and the modes of a collection window.
WEEKDAYS = "Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday"
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
MONDAY, WEEKDAY, WEEKEND = "MONDAY_WEEKEND_CATCHUP", "DAILY_WITH_LOOKBACK", "WEEKEND_MANUAL"

_TIME = r"(?:\s+\d{1,2}:\d{2})?"
#: Dates in visible text: with weekday, day first, month first.
WITH_WEEKDAY = rf"(?i)\b(?:{WEEKDAYS}),?\s+\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}}{_TIME}\b"
DAY_FIRST = rf"(?i)\b\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}}{_TIME}\b"
MONTH_FIRST = rf"(?i)\b(?:{MONTHS})\s+\d{{1,2}},\s+\d{{4}}{_TIME}\b"
_FORMATS = ["d MMMM yyyy HH:mm", "d MMMM yyyy H:mm", "d MMMM yyyy", "MMMM d, yyyy HH:mm", "MMMM d, yyyy H:mm", "MMMM d, yyyy", "d MMM yyyy", "MMM d, yyyy", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy"]


# Hours east of Greenwich of zone names, and words for small numbers.
ZONES = {
    "z": 0, "utc": 0, "gmt": 0, "wet": 0, "bst": 1, "cet": 1, "cest": 2, "eet": 2, "eest": 3, "msk": 3, "pkt": 5, "ist": 5.5, "slst": 5.5, "sgt": 8, "hkt": 8, "jst": 9, "aest": 10, "aedt": 11,
    "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7,
}
NUMBERS = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve"]

_UNIT = r"(second|sec|minute|min|hour|hr|day|week|month|year)s?"
_AGO = rf"^(?:about |around )?(\d{{1,4}}|an?|{'|'.join(NUMBERS)}) {_UNIT} ago$"
_CLOCK = r"(?:^|[ ,t])(?:at )?(\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d+)?)?(?: ?([ap])\.?m\.?)?(?=$|[ ,z+-])"
_HOUR = r"(?:^|[ ,])(?:at )?(\d{1,2}) ?([ap])\.?m\.?(?=$|[ ,+-])"
_ZONE = rf"(?:(?<=\d)|(?<=m)|[ (])({'|'.join(ZONES)}|[+-]\d{{2}}:?\d{{2}})\)?$"
_SHORT = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
_MONTH = rf"({_SHORT})[a-z]*\.?"


def local_day(ts: Column) -> Column:
    """The news day of an instant."""
    return F.to_date(F.from_utc_timestamp(ts, LOCAL))


def article_date(s: Column) -> Column:
    """The news day of an ISO string; naive ones are local; anything else is null."""
    ts = F.when(s.rlike(_ISO), s).try_cast("timestamp")
    return F.when(s.rlike(_AWARE), local_day(ts)).otherwise(F.to_date(ts))


def is_iso_date(s: Column) -> Column:
    return s.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(s, "yyyy-MM-dd").isNotNull()


def window_mode(day: Column) -> Column:
    return F.when(F.weekday(day) == 0, MONDAY).when(F.weekday(day) < 5, WEEKDAY).otherwise(WEEKEND)


def window_start(day: Column) -> Column:
    return F.date_sub(day, F.when(F.weekday(day) == 0, 3).when(F.weekday(day) < 5, 1).otherwise(0))


def window_dates(day: Column) -> Column:
    """All publication days of a run day's window, as ISO strings."""
    return F.transform(F.sequence(window_start(day), day), lambda d: d.cast("string"))


def in_window(date: Column, day: Column) -> Column:
    return date.between(window_start(day), day)


def is_late(date: Column, day: Column) -> Column:
    return date < day


def hint_from_path(path: Column) -> Column:
    """Midnight of the date in /yyyy/mm/dd/..., or null; impossible dates are null."""
    date = F.try_to_date(F.regexp_replace(F.nullif(F.regexp_extract(path, r"^/(\d{4}/\d{2}/\d{2})/", 1), F.lit("")), "/", "-"), "yyyy-MM-dd")
    return F.concat(date.cast("string"), F.lit(f"T00:00:00{OFFSET}"))


def parse_free_text(s: Column) -> Column:
    """A local ISO string for dates in words or digits, day first where both fit; else null."""
    v = F.trim(F.regexp_replace(s, r"\s+", " "))
    plain = F.initcap(F.regexp_replace(v, f"(?i)^(?:{WEEKDAYS}),? ", ""))
    naive = F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)) for f in _FORMATS])
    iso = F.when(v.rlike(_ISO), v).try_cast("timestamp")
    local = F.coalesce(F.when(v.rlike(_AWARE), F.from_utc_timestamp(iso, LOCAL)).otherwise(iso), naive)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(OFFSET))


def parse_date(s: Column, now: Column | None = None) -> Column:
    """parse_free_text with a grammar for other wordings, else null: a local ISO string.

    Times of twelve hours, zones by name or offset, short months, ordinals.
    now, an instant: also relative dates (ago, yesterday), and the latest past
    one of a weekday, of a day without year; hours of the day without a date.
    """
    plain = parse_free_text(s)
    v = F.lower(F.trim(F.regexp_replace(s, r"\s+", " ")))
    return F.coalesce(plain, _once(lambda x: _worded(x["v"], now), v=v))


def _text_at(local: Column) -> Column:
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(OFFSET))


def _part(v: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(v, pattern, group), F.lit(""))


def _once(body: Callable[[Column], Column], **parts: Column) -> Column:
    """body over a struct of parts, each computed once however often body names it."""
    return F.element_at(F.transform(F.array(F.struct(*[c.alias(k) for k, c in parts.items()])), body), 1)


def _at_seconds(day: Column, seconds: Column) -> Column:
    """A local time, kept as if the session's zone, UTC, were the local one."""
    return F.timestamp_seconds(F.unix_seconds(day.cast("timestamp")) + seconds)


def _worded(v: Column, now: Column | None) -> Column:
    zone = F.when(v.rlike(_CLOCK) | v.rlike(_HOUR), _part(v, _ZONE, 1))
    return _once(lambda x: _clocked(v, x["zone"], F.when(x["zone"].isNotNull(), F.regexp_replace(v, _ZONE, "")).otherwise(v), now), zone=zone)


def _clocked(v: Column, zone: Column, timed: Column, now: Column | None) -> Column:
    """Takes the time off, then weekday and ordinals."""

    def rested(x: Column) -> Column:
        hour24 = F.when(x["half"].isNull(), x["hour"]).when(~x["hour"].between(1, 12), F.lit(None)).otherwise(x["hour"] % 12 + F.when(x["half"] == "p", 12).otherwise(0))
        seconds = _once(lambda h: F.when((h["h"] <= 23) & (x["minute"] <= 59) & (x["second"] <= 59), h["h"] * 3600 + x["minute"] * 60 + x["second"]), h=hour24)
        in_day = F.when(x["hour"].isNull(), F.lit(0)).otherwise(seconds)
        weekday = _part(x["rest"], r"^(mon|tue|wed|thu|fri|sat|sun)(?:[a-z]*day|[a-z]{0,2})\b", 1)
        bare = F.regexp_replace(F.regexp_replace(x["rest"], r"^(?:mon|tue|wed|thu|fri|sat|sun)(?:[a-z]*day|[a-z]{0,2})\b[, ]*", ""), r"(\d)(?:st|nd|rd|th)\b", "$1")
        bare = F.trim(F.regexp_replace(F.translate(bare, ",", " "), " +", " "))
        return _once(lambda y: _dated(v, zone, y, now), in_day=in_day, has_clock=x["hour"].isNotNull(), weekday=weekday, rest=bare)

    def parts(t: Column) -> Column:
        rest = F.regexp_replace(F.regexp_replace(t["t"], _CLOCK, " "), _HOUR, " ")
        return _once(
            rested,
            half=F.coalesce(_part(t["t"], _CLOCK, 4), _part(t["t"], _HOUR, 2)),
            hour=F.coalesce(_part(t["t"], _CLOCK, 1), _part(t["t"], _HOUR, 1)).cast("int"),
            minute=F.coalesce(_part(t["t"], _CLOCK, 2).cast("int"), F.lit(0)),
            second=F.coalesce(_part(t["t"], _CLOCK, 3).cast("int"), F.lit(0)),
            rest=F.regexp_replace(rest, r"^(?:published|posted|updated|on)?:? *(?=.)", ""),
        )

    return _once(parts, t=timed)


def _dated(v: Column, zone: Column, x: Column, now: Column | None) -> Column:
    """The day that the rest names, with time and zone."""
    rest = x["rest"]
    day_first, month_first = rf"^(\d{{1,2}}) (?:of )?{_MONTH}(?: (\d{{4}}))?$", rf"^{_MONTH} (\d{{1,2}})(?: (\d{{4}}))?$"
    year_first, numbers = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$", r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})$"

    def of_parts(p: Column) -> Column:
        swapped = (p["b"] > 12) & (p["a"] <= 12)
        month = F.coalesce(F.floor((F.instr(F.lit(_SHORT), p["name"]) + 3) / 4).cast("int"), p["month"], F.when(swapped, p["a"]).otherwise(p["b"]))
        day = F.coalesce(p["day"], F.when(swapped, p["b"]).otherwise(p["a"]))
        return _once(lambda d: _timed(v, zone, x, d, now), year=p["year"], month=month, day=day)

    return _once(
        of_parts,
        name=F.coalesce(_part(rest, day_first, 2), _part(rest, month_first, 1)),
        day=F.coalesce(_part(rest, day_first, 1), _part(rest, month_first, 2), _part(rest, year_first, 3)).cast("int"),
        year=F.coalesce(_part(rest, day_first, 3), _part(rest, month_first, 3), _part(rest, year_first, 1), _part(rest, numbers, 3)).cast("int"),
        month=_part(rest, year_first, 2).cast("int"),
        a=_part(rest, numbers, 1).cast("int"),
        b=_part(rest, numbers, 2).cast("int"),
    )


def _timed(v: Column, zone: Column, x: Column, d: Column, now: Column | None) -> Column:
    rest, weekday = x["rest"], x["weekday"]
    of = lambda y: F.try_to_date(F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(d["month"].cast("string"), 2, "0"), F.lpad(d["day"].cast("string"), 2, "0")), "yyyy-MM-dd")
    named = d["month"].isNotNull() & d["day"].isNotNull()
    dated = F.when(named & d["year"].isNotNull(), of(d["year"]))
    if now is not None:
        today = F.to_date(F.from_utc_timestamp(now, OFFSET))
        back = F.pmod(F.weekday(today) - F.floor(F.instr(F.lit("mon tue wed thu fri sat sun"), weekday) / 4), F.lit(7))
        past = F.date_sub(today, F.when(back == 0, 7).otherwise(back).cast("int"))
        without_year = F.when(named & d["year"].isNull(), F.when(of(F.year(today)) <= today, of(F.year(today))).otherwise(of(F.year(today) - 1)))
        said = F.when(rest == "today", today).when(rest == "yesterday", F.date_sub(today, 1)).when(rest == "day before yesterday", F.date_sub(today, 2))
        dated = F.coalesce(dated, without_year, said, F.when((rest == "") & weekday.isNotNull(), past), F.when((rest == "") & x["has_clock"], today))
    east = F.when(zone.rlike(r"^[+-]"), F.concat(F.substring(zone, 1, 1), F.lit("1")).cast("int") * (F.substring(zone, 2, 2).cast("int") * 60 + F.substring(zone, -2, 2).cast("int"))).otherwise(F.element_at(F.create_map(*[F.lit(c) for k, h in ZONES.items() for c in (k, int(h * 60))]), zone))

    def moved(y: Column) -> Column:
        local = _at_seconds(y["day"], x["in_day"])
        plain = _text_at(F.when(zone.isNull(), local).otherwise(F.from_utc_timestamp(F.timestamp_seconds(F.unix_seconds(local) - east * 60), OFFSET)))
        return plain if now is None else _relative(v, x, y["day"], plain, now)

    return _once(moved, day=dated)


def _relative(v: Column, x: Column, day: Column, plain: Column, now: Column) -> Column:
    """Times that count back from now; today and yesterday without a time keep the time of now."""
    n, unit = F.regexp_extract(v, _AGO, 1), F.regexp_extract(v, _AGO, 2)
    word = F.array_position(F.array(*[F.lit(w) for w in NUMBERS]), n)
    many = F.when(n.rlike(r"^\d+$"), n.try_cast("int")).when(n.isin("a", "an"), 1).when(word > 0, word.cast("int"))
    seconds = F.when(unit.isin("second", "sec"), 1).when(unit.isin("minute", "min"), 60).when(unit.isin("hour", "hr"), 3600).when(unit == "day", 86400).when(unit == "week", 7 * 86400)
    months = F.when(unit == "month", 1).when(unit == "year", 12)

    def counted(c: Column) -> Column:
        at = F.from_utc_timestamp(now, OFFSET)
        of_day = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
        ago = F.coalesce(F.timestamp_seconds(F.unix_seconds(at) - c["many"].cast("long") * c["seconds"]), _at_seconds(F.add_months(F.to_date(at), -(c["many"] * c["months"])), of_day))
        kept = F.when(~x["has_clock"] & x["rest"].isin("today", "yesterday", "day before yesterday"), _at_seconds(day, of_day))
        return F.coalesce(F.when(v.isin("now", "just now"), _text_at(at)), _text_at(F.when(c["many"].isNotNull(), ago)), _text_at(kept), plain)

    return _once(counted, many=many, seconds=seconds, months=months)


def first_date_text(s: Column, patterns: tuple[str, ...] = (WITH_WEEKDAY, DAY_FIRST, MONTH_FIRST)) -> Column:
    """The first stretch that one of the patterns finds, in the patterns' order."""
    return F.coalesce(*[F.nullif(F.regexp_substr(s, F.lit(p)), F.lit("")) for p in patterns])


def age_hours(now: Column, then: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(then)) / 3.6e9


def next_fire(ts: Column) -> Column:
    """The next full hour after ts on Monday to Friday between 8 and 17, in local wall time."""
    first = F.date_trunc("hour", ts) + F.expr("INTERVAL 1 HOUR")
    grid = F.sequence(first, first + F.expr("INTERVAL 7 DAYS"), F.expr("INTERVAL 1 HOUR"))
    return F.array_min(F.filter(grid, lambda t: (F.weekday(t) < 5) & F.hour(t).between(8, 17)))


def retry_delay(attempt: Column, base: float = 1.5) -> Column:
    return F.lit(base) * F.pow(F.lit(2.0), attempt - 1)
