import calendar
import random
import re
from collections import Counter
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from tidemark.llm import timestamps as ts

SCHEMA = "stamp_id long, source string, zone string, raw string"
DATE = r"(?P<y1>20\d\d)-(?P<m1>\d\d)-(?P<d1>\d\d)|(?P<y2>20\d\d)(?P<m2>\d\d)(?P<d2>\d\d)|(?P<d3>\d\d)[.](?P<m3>\d\d)[.](?P<y3>20\d\d)|(?P<d4>\d\d) (?P<b4>[A-Z][a-z][a-z]) (?P<y4>20\d\d)|(?P<d5>\d\d)/(?P<m5>\d\d)/(?P<y5>20\d\d)"
STAMP = re.compile(rf"(?:{DATE})(?:[T ](?P<h>\d\d):(?P<mi>\d\d)(?::(?P<s>\d\d))?(?: ?(?P<half>[AP]M))?(?: ?(?P<off>Z|[+-]\d\d:?\d\d))?)?", re.ASCII)


def parse(raw, zone):
    """epoch microseconds, or (dates possible as d/m and m/d, seconds of the day, offset in minutes or zone), or None."""
    text = (raw or "").strip(" \t\n\x0b\x0c\r")
    if re.fullmatch(r"[0-9]{10}|[0-9]{13}", text):
        return int(text) * (10**6 if len(text) == 10 else 1000)
    found = STAMP.fullmatch(text)
    if not found:
        return None
    g = {k.rstrip("12345"): v for k, v in found.groupdict().items() if v is not None}
    if "b" in g and g["b"] not in ts.MONTHS:
        return None
    h, mi, s = int(g.get("h", 0)), int(g.get("mi", 0)), int(g.get("s", 0))
    if mi > 59 or s > 59 or not (1 <= h <= 12 if "half" in g else h <= 23):
        return None
    if "half" in g:
        h = h % 12 + 12 * (g["half"] == "PM")
    place = zone
    if "off" in g:
        off = g["off"].replace(":", "")
        oh, om = (0, 0) if off == "Z" else (int(off[1:3]), int(off[3:]))
        if oh > 14 or om > 59:
            return None
        place = (oh * 60 + om) * (-1 if off[0] == "-" else 1)
    elif zone is None or zone == "Nowhere/None":
        return None
    y, d, m = int(g["y"]), int(g["d"]), ts.MONTHS.index(g["b"]) + 1 if "b" in g else int(g["m"])
    orders = [(m, d), (d, m)] if "/" in text else [(m, d), None]
    days = [datetime(y, *x) if x and 1 <= x[0] <= 12 and 1 <= x[1] <= calendar.monthrange(y, x[0])[1] else None for x in orders]
    return (days, (h * 60 + mi) * 60 + s, place, "/" in text) if any(days) else None


def brute(rows):
    read = [parse(raw, zone) for _, _, zone, raw in rows]
    votes = Counter()
    for (_, source, _, _), p in zip(rows, read):
        if isinstance(p, tuple) and p[3] and (p[0][0] is None or p[0][1] is None):
            votes[source, "d" if p[0][0] else "m"] += 1
    out = []
    for (i, source, _, _), p in zip(rows, read):
        if not isinstance(p, tuple):
            out.append((i, p, "bad" if p is None else "epoch", False))
            continue
        (first, second), clock, place, _ = p
        day, rule = first or second, "plain"
        if first and second and first != second:
            d, m = votes[source, "d"], votes[source, "m"]
            rule = "votes" if d > 3 * m or m > 3 * d else "default"
            day = first if d > 3 * m else second
        wall = day + timedelta(seconds=clock)
        odd = False
        if isinstance(place, int):
            at = (wall - timedelta(minutes=place)).replace(tzinfo=timezone.utc)
        else:
            z = ZoneInfo(place)
            at, late = (wall.replace(tzinfo=z, fold=f).astimezone(timezone.utc) for f in (0, 1))
            odd = at != late  # skipped or repeated
        out.append((i, (at - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1), rule, rule != "plain" or odd))
    return sorted(out, key=repr)


def run(spark, rows, schema=SCHEMA):
    found = ts.normalise(spark.createDataFrame(rows, schema)).select("stamp_id", "utc_us", "rule", "ambiguous")
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_layouts_have_one_shape_each():
    shapes = [row[0] for row in ts.layouts()]
    assert len(shapes) == len(set(shapes)) == 667


def test_every_layout_and_broken_stamps(spark):
    rng = random.Random(5)
    zones = ["UTC", "Europe/Berlin", "America/New_York", "Asia/Kolkata", "Australia/Lord_Howe", "Pacific/Apia", "America/St_Johns", None, "Nowhere/None"]
    rows = []
    for n, (shape, *_) in enumerate(ts.layouts() * 4):
        raw = shape.replace("Aaa", rng.choice(ts.MONTHS + ["Abc"])).replace("AA", rng.choice(["AM", "PM", "AM", "XM"]))
        raw = re.sub(r"A$", rng.choice("ZZZY"), raw)
        raw = re.sub(r"(?<=9)A(?=9)", "T", raw)
        raw = re.sub(r"9999(?=[ T/]|$)|9999(?=-)|^9999(?=9999)", "2024", raw, count=1) if len(shape) not in (10, 13) or not shape.isdigit() else raw
        raw = re.sub("99", lambda _: f"{rng.choice([0, 1, 2, 3, 4, 9, 10, 11, 12, 13, 14, 23, 24, 29, 30, 31, 59, 60]):02d}", raw)
        rows.append((n, f"s{n % 7}", rng.choice(zones), rng.choice(["", " ", "\t\x0b"]) + raw + rng.choice(["", " \r\n", "x"] if n % 9 == 0 else [""])))
    rows += [(None, None, "UTC", "03/04/2024"), (-1, None, "UTC", "13/04/2024"), (-2, "x", "UTC", None), (-3, "x", "UTC", ""), (-4, "x", "UTC", "9" * 70_000), (-5, "x", "UTC", "２０２４-01-01"), (-5, "x", "UTC", "2024-01-01")]
    assert run(spark, rows) == brute(rows)
    assert {r[2] for r in brute(rows)} == {"bad", "epoch", "votes", "default", "plain"}


def test_every_layout_can_be_read(spark):
    values = {"year": "2023", "month": "04", "day": "05", "name": "Apr", "t": "T", "hour": "07", "minute": "08", "second": "09", "half": "PM", "z": "Z", "sign": "-", "off_hour": "02", "off_minute": "30"}
    rows = []
    for n, (shape, _, unit, *at) in enumerate(ts.layouts()):
        raw = list(shape)
        for field, start in zip(ts.FIELDS, at):
            if start and not (field == "sign"):
                raw[start - 1 : start - 1 + len(values[field])] = values[field]
        rows.append((n, "s", "Asia/Kolkata", "".join(raw)))
    found = run(spark, rows)
    assert found == brute(rows) and not any(r[2] == "bad" for r in found)


@pytest.mark.parametrize("zone", ["Europe/Berlin", "America/New_York", "Australia/Lord_Howe", "Pacific/Apia", "America/Caracas", "Asia/Pyongyang", "Asia/Magadan"])
def test_changes_of_the_clock(spark, zone):
    days = [datetime(2024, 3, 31), datetime(2024, 10, 27), datetime(2024, 3, 10), datetime(2024, 11, 3), datetime(2024, 4, 7), datetime(2024, 10, 6), datetime(2011, 12, 30), datetime(2007, 12, 9), datetime(2015, 8, 15), datetime(2014, 10, 26), datetime(2016, 4, 24)]
    rows = [(n, "s", zone, (day - timedelta(hours=3) + timedelta(minutes=15 * k)).strftime("%Y-%m-%d %H:%M")) for n, (day, k) in enumerate((d, k) for d in days for k in range(28 * 4))]
    assert run(spark, rows) == brute(rows)


def test_votes_need_more_than_three_times(spark):
    def rows(d, m):
        return [(n, "s", "UTC", raw) for n, raw in enumerate(["20/01/2024"] * d + ["01/20/2024"] * m + ["02/03/2024", "05/05/2024", "24:00", "20/01/2024 24:00", "31/04/2024"])]

    for d, m in ((3, 1), (4, 1), (1, 4), (1, 3), (0, 0), (1, 0), (0, 1)):
        assert run(spark, rows(d, m)) == brute(rows(d, m)), (d, m)


def test_many_sources_meet_their_votes_by_a_shuffle(spark):
    rng = random.Random(3)
    rows = [(n, None if n % 5 == 0 else f"s{rng.randrange(700)}", "UTC", rng.choice(["02/03/2024", "20/03/2024", "03/20/2024"])) for n in range(4000)]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    rows = [(1, "s", "UTC", "01/02/2024", 5, 6, 7, 8)]
    found = ts.normalise(spark.createDataFrame(rows, SCHEMA + ", shape int, known int, n int, day int"))
    assert [r.utc_us for r in found.collect()] == [1704153600 * 10**6]
