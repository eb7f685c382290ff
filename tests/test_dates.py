"""The grammar of dates against plain Python, wording by wording."""

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from inkwell.functions import dates

NOW = datetime(2026, 9, 14, 6, 10, 5, tzinfo=timezone.utc)  # a Monday, 11:40:05 in Colombo
HERE = (NOW + timedelta(hours=5, minutes=30)).replace(tzinfo=None)
SHORT = "jan feb mar apr may jun jul aug sep oct nov dec".split()
DAYS = "mon tue wed thu fri sat sun".split()
EAST = {"utc": 0, "gmt": 0, "est": -300, "pdt": -420, "ist": 330, "jst": 540, "cet": 60}


def plain(s):
    """The same grammar by hand; None for what it doesn't hold."""
    v = " ".join(s.lower().split())
    if v in ("now", "just now"):
        return HERE
    if m := re.fullmatch(r"(?:about |around )?(\w+) (second|sec|minute|min|hour|hr|day|week|month|year)s? ago", v):
        word, unit = m.groups()
        n = int(word) if word.isdigit() else 1 if word in ("a", "an") else dates.NUMBERS.index(word) + 1
        step = {"sec": 1, "min": 60, "hou": 3600, "hr": 3600, "day": 86400, "wee": 604800}.get(unit[:3])
        if step:
            return HERE - timedelta(seconds=n * step)
        k = HERE.year * 12 + HERE.month - 1 - n * (12 if unit == "year" else 1)
        y, mo, d = k // 12, k % 12 + 1, HERE.day
        while True:
            try:
                return HERE.replace(year=y, month=mo, day=d)
            except ValueError:
                d -= 1
    zone = None
    clock = re.search(r"(?:at )?\b(\d{1,2}):(\d{2})(?::(\d{2}))?(?: ?([ap])\.?m\.?)?|(?:at )?\b(\d{1,2}) ?([ap])\.?m\b", v)
    time = (0, 0, 0)
    if clock:
        tail = v[clock.end() :].strip(" ()")
        if tail in EAST:
            zone, v = EAST[tail], v[: clock.end()]
        elif z := re.fullmatch(r"([+-])(\d\d):?(\d\d)", tail):
            zone, v = int(z[1] + "1") * (int(z[2]) * 60 + int(z[3])), v[: clock.end()]
        h, half = int(clock[1] or clock[5]), clock[4] or clock[6]
        if half:
            if not 1 <= h <= 12:
                return None
            h = h % 12 + 12 * (half == "p")
        time = (h, int(clock[2] or 0), int(clock[3] or 0))
        if time[0] > 23 or time[1] > 59 or time[2] > 59:
            return None
        v = v[: clock.start()] + v[clock.end() :]
    v = re.sub(r"^(published|posted|updated|on):? ", "", v.strip())
    day = None
    if m := re.match(r"(mon|tue|wed|thu|fri|sat|sun)(?:[a-z]*day|[a-z]{0,2})\b[, ]*", v):
        day, v = DAYS.index(m[1]), v[m.end() :]
    v = " ".join(re.sub(r"(\d)(st|nd|rd|th)\b", r"\1", v).replace(",", " ").split())
    date = None
    try:
        if v in ("today", "yesterday", "day before yesterday"):
            date = HERE - timedelta(days=["today", "yesterday", "day before yesterday"].index(v))
            if not clock:
                return date
        elif m := re.fullmatch(r"(\d{1,2}) (?:of )?([a-z]+)\.?(?: (\d{4}))?|([a-z]+)\.? (\d{1,2})(?: (\d{4}))?", v):
            mo, d, y = SHORT.index((m[2] or m[4])[:3]) + 1, int(m[1] or m[5]), m[3] or m[6]
            date = datetime(int(y or HERE.year), mo, d)
            if not y and date.date() > HERE.date():
                date = date.replace(year=HERE.year - 1)
        elif m := re.fullmatch(r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})", v):
            date = datetime(*map(int, m.groups()))
        elif m := re.fullmatch(r"(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})", v):
            a, b, y = map(int, m.groups())
            date = datetime(y, a, b) if b > 12 and a <= 12 else datetime(y, b, a)
        elif not v and day is not None:
            back = (HERE.weekday() - day) % 7
            date = HERE - timedelta(days=back or 7)
        elif not v and clock:
            date = HERE
    except ValueError:
        return None
    if date is None:
        return None
    at = datetime(date.year, date.month, date.day, *time)
    return at if zone is None else at - timedelta(minutes=zone) + timedelta(hours=5, minutes=30)


WORDINGS = (
    ["now", "Just  now", "no date", "", "ago", "soon", "in 3 hours", "32 September 2026", "September 31, 2026", "25:00", "13:70", "14 pm", "0 am", "2026-13-01", "31/4/2026", "some 3 Sept 2026", "14 Foo 2026"]
    + [f"{n} {u}{s} ago" for n, s in (("2", "s"), ("an", ""), ("a", ""), ("Eleven", "s"), ("45", "s"), ("1", "")) for u in ("second", "min", "hour", "hr", "day", "week", "month", "year")]
    + ["about 3 hours ago", "around two days ago", "7 months ago", "19 months ago", "31 days ago"]
    + [f"{d}{t}" for d in ("today", "Yesterday", "day before yesterday") for t in ("", " at 5:30 pm", ", 23:15", " 7am", " at 12:00 AM")]
    + [d for d in ("Monday", "Tue", "Wednesday", "thurs", "Fri", "Saturday", "Sun", "Sunday 10:30", "Friday at 4 p.m", "monday, 09:00")]
    + [f"{d}{t}" for d in ("14 Sept 2026", "3rd of March 2025", "Sep. 1st, 2026", "Monday, 14 September 2026", "Fri, 11 Sep 2026", "2026/9/5", "5.9.2026", "9/25/2026", "25-12-2025", "December 31, 2025", "29 February 2024", "29 February 2025") for t in ("", " 10:30", " 10:30:59", " at 9:05 PM", " 12:30 am", " 18:00 GMT", " 6 pm EST", " 10:30 +0200", " 23:59 (JST)", " 08:00 IST")]
    + ["14 September", "15 September", "Sep 13", "March 3 at 5 pm", "30 December", "29 Feb", "1st Jan 10:00 UTC", "on 3 May 2026", "Published: 3 May 2026", "Updated 12 Aug 2026 10:30", "10:30", "7 pm", "22:10 PDT", "11:41", "5 Jun 2026, 3:04 p.m."]
)


def test_wordings_against_plain_code(spark):
    assert len(WORDINGS) >= 200
    d = spark.createDataFrame(list(enumerate(WORDINGS)), "k long, s string")
    got = [r[0] for r in d.orderBy("k").select(dates.parse_date(F.col("s"), F.lit(NOW.isoformat()).cast("timestamp"))).collect()]
    want = [p and p.strftime("%Y-%m-%dT%H:%M:%S+05:30") for p in map(plain, WORDINGS)]
    assert [(s, g, w) for s, g, w in zip(WORDINGS, got, want, strict=True) if g != w] == []


def test_without_now_nothing_is_relative(spark):
    said = ["2 hours ago", "yesterday", "Monday", "14 September", "10:30", "14 Sept 2026 6 pm EST", "Fri, 11 Sep 2026 10:30", None]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(said)), "k long, s string").orderBy("k").select(dates.parse_date(F.col("s"))).collect()]
    assert got == [None] * 5 + ["2026-09-15T04:30:00+05:30", "2026-09-11T10:30:00+05:30", None]
