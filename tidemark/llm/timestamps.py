"""Mixed timestamp normalisation by shape signatures.

Every stamp is stripped and its digits and letters become placeholders. The resulting shape is joined with a broadcast table
of layouts, which is built from a rule and says where each field stands. Fields are cut out by these positions and their
ranges are checked as numbers; no stamp is matched by a pattern and no Python runs per row.

Slashed dates that are possible in one order only vote for it in their source. Votes are sums by source; a source with many
contested stamps meets its votes by a broadcast of at most HOT rows (see common.hot_rows), the rest by a shuffle.

Null, impossible and unreadable stamps are bad: no instant, not ambiguous, no vote. So are stamps without an offset whose zone
is null or unknown. A null source is a source like any other. Every row gives one row: repeated rows and ids give repeated
results, ids may be null, extra columns are ignored, and an empty table gives an empty result. A stamp of any length has a
shape, so very long ones are only bad."""

from __future__ import annotations

import string
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint, hot_rows, saved

#: The other order needs more than so many times the votes.
MARGIN = 3
#: Month names as stamps write them.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
#: Characters that are stripped.
SPACE = " \t\n\x0b\x0c\r"
#: Days before each month of a common year, and from 1970 to 2000.
BEFORE, TO_2000 = [0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334], 10957
DAY_US = 86_400_000_000

#: Positions of fields (1 is the first character, 0 means absent), and the unit of epoch stamps in microseconds.
FIELDS = ["year", "month", "day", "name", "t", "hour", "minute", "second", "half", "z", "sign", "off_hour", "off_minute"]
SCHEMA = ", ".join(["shape string", "slashed boolean", "unit long", *(f"{f}_at int" for f in FIELDS)])


def shape(text: Column) -> Column:
    """Digits as 9, letters as a or A, all else as it is."""
    letters = string.ascii_lowercase + string.ascii_uppercase
    return F.translate(text, string.digits + letters, "9" * 10 + "a" * 26 + "A" * 26)


def layouts() -> list[tuple]:
    """Every layout: a row of SCHEMA. Dates by times, and two of epoch stamps."""
    dates = [
        ("9999-99-99", {"year": 1, "month": 6, "day": 9}),
        ("99999999", {"year": 1, "month": 5, "day": 7}),
        ("99.99.9999", {"day": 1, "month": 4, "year": 7}),
        ("99 Aaa 9999", {"day": 1, "name": 4, "year": 8}),
        ("99/99/9999", {"day": 1, "month": 4, "year": 7}),
    ]
    zones = ["", *(gap + zone for gap in ("", " ") for zone in ("A", *(sign + off for sign in "+-" for off in ("99:99", "9999"))))]
    times = [
        (("t" if between == "A" else "", between), ("hour", "99"), ("", ":"), ("minute", "99"), ("", ":" if second else ""), ("second", second), ("", gap), ("half", half), ("zone", zone))
        for between, second, (gap, half), zone in product("A ", ("", "99"), (("", ""), ("", "AA"), (" ", "AA")), zones)
    ]
    out = []
    for date, at in dates:
        for parts in [(), *times]:
            text, where = date, dict(at)
            for field, part in parts:
                if field == "zone" and part:
                    start = len(text) + 1 + part.startswith(" ")
                    if part.endswith("A"):
                        where["z"] = start
                    else:
                        where |= {"sign": start, "off_hour": start + 1, "off_minute": len(text + part) - 1}
                elif field and part:
                    where[field] = len(text) + 1
                text += part
            out.append((text, date == "99/99/9999", None, *(where.get(f, 0) for f in FIELDS)))
    epochs = [("9" * 10, False, 1_000_000), ("9" * 13, False, 1000)]
    return out + [(*e, *[0] * len(FIELDS)) for e in epochs]


def _days(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970 of a date from 2000 to 2099, where every fourth year is a leap year; null if there is none."""
    leap = (y % 4 == 0).cast("int")
    length = F.when(m == 2, 28 + leap).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    since = (y - 2000) * 365 + F.floor((y - 1997) / 4).cast("int") + F.get(F.array(*map(F.lit, BEFORE)), m - 1) + F.when(m > 2, leap).otherwise(0) + d - 1
    return F.when(m.between(1, 12) & d.between(1, length) & y.between(2000, 2099), since + TO_2000)


def read(stamps: DataFrame, id_col: str, source_col: str, zone_col: str, raw_col: str) -> DataFrame:
    """Per stamp: stamp_id, source, epoch_us (epoch stamps), day and other_day (days since 1970 as day first, and month first, of
    slashed ones that differ), order (d or m: a vote), clock_us, off_us, zone (of stamps without an offset). Bad stamps have
    neither epoch_us nor day."""
    spark = stamps.sparkSession
    table = F.broadcast(spark.createDataFrame(layouts(), SCHEMA))
    known = F.broadcast(known_zones(spark))
    s = F.btrim(F.col(raw_col).cast("string"), F.lit(SPACE))
    rows = stamps.select(F.col(id_col).alias("stamp_id"), F.col(source_col).alias("source"), F.col(zone_col).cast("string").alias("zone"), s.alias("s")).withColumn("shape", shape(F.col("s")))
    rows = rows.join(table, "shape", "left").join(known, "zone", "left")

    def text(field: str, length: int) -> Column:
        return F.when(F.col(f"{field}_at") > 0, F.substr("s", F.col(f"{field}_at"), F.lit(length)))

    def number(field: str, length: int = 2) -> Column:
        return text(field, length).try_cast("int")

    def absent_or(field: str, test: Column) -> Column:
        return (F.col(f"{field}_at") == 0) | test

    name = F.array_position(F.array(*map(F.lit, MONTHS)), text("name", 3)).cast("int")
    rows = rows.select(
        "stamp_id", "source", "zone", "known", "slashed", "s", "unit", "sign_at", "z_at", "t_at", "half_at", "hour_at", "off_hour_at",
        number("year", 4).alias("y"), F.when(F.col("name_at") > 0, name).otherwise(number("month")).alias("m"), number("day").alias("d"),
        number("hour").alias("hour"), number("minute").alias("minute"), number("second").alias("second"), text("half", 2).alias("half"),
        text("t", 1).alias("t"), text("z", 1).alias("z"), text("sign", 1).alias("sign"), number("off_hour").alias("off_hour"), number("off_minute").alias("off_minute"),
    )
    c = F.col
    hours = F.when(c("half_at") > 0, c("half").isin("AM", "PM") & c("hour").between(1, 12)).otherwise(c("hour").between(0, 23))
    clock = absent_or("hour", hours & c("minute").between(0, 59) & (c("second").isNull() | c("second").between(0, 59))) & absent_or("t", c("t") == "T")
    has_offset = (c("z_at") > 0) | (c("sign_at") > 0)
    offset = absent_or("z", c("z") == "Z") & absent_or("off_hour", c("off_hour").between(0, 14) & c("off_minute").between(0, 59))
    fine = c("unit").isNull() & clock & offset & (has_offset | c("known"))
    hour = F.when(c("half_at") > 0, c("hour") % 12 + F.when(c("half") == "PM", 12).otherwise(0)).otherwise(c("hour"))
    clock_us = ((F.coalesce(hour, F.lit(0)) * 60 + F.coalesce("minute", F.lit(0))) * 60 + F.coalesce("second", F.lit(0))).cast("long") * 1_000_000
    off_us = F.when(c("sign_at") > 0, (c("off_hour") * 60 + c("off_minute")).cast("long") * 60_000_000 * F.when(c("sign") == "-", -1).otherwise(1)).when(c("z_at") > 0, F.lit(0).cast("long"))
    rows = rows.select(
        "stamp_id", "source", "slashed",
        F.when(c("unit").isNotNull(), c("s").try_cast("long") * c("unit")).alias("epoch_us"),
        F.when(fine, _days(c("y"), c("m"), c("d"))).alias("day_first"),
        F.when(fine & c("slashed"), _days(c("y"), c("d"), c("m"))).alias("month_first"),
        clock_us.alias("clock_us"), off_us.alias("off_us"), F.when(~has_offset, c("zone")).alias("zone"),
    )
    first, second = c("day_first"), c("month_first")
    order = F.when(c("slashed") & first.isNotNull() & second.isNull(), "d").when(c("slashed") & first.isNull() & second.isNotNull(), "m")
    return rows.select("stamp_id", "source", "epoch_us", F.coalesce(first, second).alias("day"), F.when(first != second, second).alias("other_day"), order.alias("order"), "clock_us", "off_us", "zone")


def known_zones(spark: SparkSession) -> DataFrame:
    """(zone, known) of the zones that the session's time zone rules name, some 600."""
    ids = spark.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds()
    return spark.createDataFrame([(z, True) for z in sorted(ids)], "zone string, known boolean")


def votes(rows: DataFrame) -> DataFrame:
    """Per source that has contested stamps: voted (whether votes decide), day_first, and n contested stamps."""
    d, m, n = (F.count_if(test).alias(a) for a, test in (("d", F.col("order") == "d"), ("m", F.col("order") == "m"), ("n", F.col("other_day").isNotNull())))
    sums = rows.where(F.col("order").isNotNull() | F.col("other_day").isNotNull()).groupBy("source").agg(d, m, n).where("n > 0")
    days, months = F.col("d") > MARGIN * F.col("m"), F.col("m") > MARGIN * F.col("d")
    return sums.select("source", (days | months).alias("voted"), days.alias("day_first"), "n")


def normalise(stamps: DataFrame, id_col: str = "stamp_id", source_col: str = "source", zone_col: str = "zone", raw_col: str = "raw") -> DataFrame:
    """Per row: stamp_id, utc_us, rule (bad, epoch, votes, default, plain), ambiguous, and skipped and repeated: whether the zone
    skips or repeats the wall time."""
    rows = saved(read(stamps, id_col, source_col, zone_col, raw_col))  # read three times below, and no filter is pushed into the parsing
    hot, others = (t.drop("n").withColumnRenamed("source", "voter") for t in hot_rows(checkpoint(votes(rows)), "n"))
    same = F.col("source").eqNullSafe(F.col("voter"))
    met = rows.join(F.broadcast(hot), same & F.col("other_day").isNotNull(), "left")
    waits = F.col("other_day").isNotNull() & F.col("voted").isNull()
    late = met.where(waits).drop("voter", "voted", "day_first").join(others, same)
    met = met.where(~waits).unionByName(late).drop("voter")

    c = F.col
    day = F.when(c("other_day").isNotNull() & ~c("day_first"), c("other_day")).otherwise(c("day"))
    met = met.withColumn("wall", F.timestamp_micros(day.cast("long") * DAY_US + c("clock_us")))
    met = met.withColumn("utc", F.when(c("zone").isNotNull(), F.to_utc_timestamp("wall", c("zone"))))  # skipped and repeated times take the offset before
    # a day later the offset after the change holds; if it leads back to the same wall time, that is the second one
    later = c("utc") + F.expr("INTERVAL 24 HOURS")
    met = met.withColumn("again", c("wall") - (F.from_utc_timestamp(later, c("zone")) - later))
    skipped = F.coalesce(F.from_utc_timestamp("utc", c("zone")) != c("wall"), F.lit(False))
    repeated = F.coalesce((c("again") != c("utc")) & (F.from_utc_timestamp("again", c("zone")) == c("wall")), F.lit(False))
    utc_us = F.coalesce(c("epoch_us"), F.when(c("zone").isNull(), F.unix_micros("wall") - c("off_us")).otherwise(F.unix_micros("utc")))
    rule = F.when(c("epoch_us").isNotNull(), "epoch").when(c("day").isNull(), "bad").when(c("other_day").isNull(), "plain").when(c("voted"), "votes").otherwise("default")
    out = met.select("stamp_id", utc_us.alias("utc_us"), rule.alias("rule"), skipped.alias("skipped"), repeated.alias("repeated"))
    return out.withColumn("ambiguous", c("rule").isin("votes", "default") | c("skipped") | c("repeated"))


#: RE2 patterns for the SQL: dates, and times with groups for hour, minute, second, half and offset.
_DATE = "20[0-9]{2}-[0-9]{2}-[0-9]{2}|20[0-9]{2}[0-9]{2}[0-9]{2}|[0-9]{2}[.][0-9]{2}[.]20[0-9]{2}|[0-9]{2} (?:" + "|".join(MONTHS) + ") 20[0-9]{2}|[0-9]{2}/[0-9]{2}/20[0-9]{2}"
_TIME = "[T ]([0-9]{2}):([0-9]{2})(:[0-9]{2})?(?: ?([AP]M))?(?: ?(Z|[+-][0-9]{2}:?[0-9]{2}))?"
ORACLE = rf"""
WITH s AS (
  SELECT row_number() OVER () AS row_no, stamp_id, source, zone, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM stamps
), f AS (
  SELECT *, coalesce(regexp_full_match(t, '[0-9]{{10}}|[0-9]{{13}}'), false) AS epoch, coalesce(regexp_full_match(t, '(?:{_DATE})(?:{_TIME})?'), false) AS dated,
    {", ".join(f"nullif(regexp_extract(t, '{_TIME}$', {i}), '') AS g{i}" for i in range(1, 6))}
  FROM s
), p AS (
  SELECT row_no, stamp_id, source, zone, t, epoch, dated, dated AND t[3] = '/' AS slashed,
    CASE WHEN dated THEN CAST(CASE WHEN t[3] = ' ' THEN t[8:11] WHEN t[3] IN ('.', '/') THEN t[7:10] ELSE t[1:4] END AS INT) END AS y,
    CASE WHEN dated THEN CASE WHEN t[3] = ' ' THEN list_position({MONTHS!r}, t[4:6]) ELSE CAST(CASE WHEN t[3] IN ('.', '/') THEN t[4:5] WHEN t[5] = '-' THEN t[6:7] ELSE t[5:6] END AS INT) END END AS m,
    CASE WHEN dated THEN CAST(CASE WHEN t[3] IN (' ', '.', '/') THEN t[1:2] WHEN t[5] = '-' THEN t[9:10] ELSE t[7:8] END AS INT) END AS d,
    CASE WHEN dated THEN CAST(g1 AS INT) END AS h, CASE WHEN dated THEN CAST(g2 AS INT) END AS mi, CASE WHEN dated THEN CAST(substr(g3, 2) AS INT) END AS se, g4 AS half,
    CASE g5 WHEN 'Z' THEN '+00:00' ELSE g5 END AS off, CAST(substr(CASE g5 WHEN 'Z' THEN '+00:00' ELSE g5 END, 2, 2) AS INT) AS oh, CAST(right(CASE g5 WHEN 'Z' THEN '+00:00' ELSE g5 END, 2) AS INT) AS om
  FROM f
), v AS (
  SELECT *, try_cast(printf('%04d-%02d-%02d', y, m, d) AS DATE) AS a, CASE WHEN slashed THEN try_cast(printf('%04d-%02d-%02d', y, d, m) AS DATE) END AS b,
    dated AND (h IS NULL OR (CASE WHEN half IS NULL THEN h <= 23 ELSE h BETWEEN 1 AND 12 END AND mi <= 59 AND coalesce(se, 0) <= 59))
      AND (off IS NULL OR (oh <= 14 AND om <= 59)) AND (off IS NOT NULL OR zone IN (SELECT name FROM pg_timezone_names())) AS fine,
    (coalesce(CASE WHEN half IS NULL THEN h ELSE h % 12 + CASE WHEN half = 'PM' THEN 12 ELSE 0 END END, 0) * 3600 + coalesce(mi, 0) * 60 + coalesce(se, 0))::BIGINT * 1000000 AS clock
  FROM p
), r AS (
  SELECT *, fine AND (a IS NOT NULL OR b IS NOT NULL) AS good, coalesce(fine AND a <> b, false) AS contested FROM v
), n AS (
  SELECT source, count(*) FILTER (good AND slashed AND b IS NULL) AS vd, count(*) FILTER (good AND slashed AND a IS NULL) AS vm FROM r GROUP BY source
), w AS (
  SELECT r.*, vd > {MARGIN} * vm OR vm > {MARGIN} * vd AS voted,
    CASE WHEN good THEN epoch_us(CAST(CASE WHEN contested AND NOT vd > {MARGIN} * vm THEN b ELSE coalesce(a, b) END AS TIMESTAMP)) + clock END AS wall
  FROM r JOIN n ON r.source IS NOT DISTINCT FROM n.source
), o AS (
  SELECT *, CASE WHEN good AND off IS NULL THEN zone END AS place,
    epoch_us(timezone(CASE WHEN good AND off IS NULL THEN zone END, make_timestamp(wall - {DAY_US}))) + {DAY_US} AS before_us,
    epoch_us(timezone(CASE WHEN good AND off IS NULL THEN zone END, make_timestamp(wall + {DAY_US}))) - {DAY_US} AS after_us
  FROM w
), q AS (
  SELECT *, epoch_us(timezone(place, to_timestamp(before_us / 1000000))) = wall AS is_before, epoch_us(timezone(place, to_timestamp(after_us / 1000000))) = wall AS is_after FROM o
)
SELECT stamp_id,
  CASE WHEN epoch THEN CAST(t AS BIGINT) * CASE length(t) WHEN 10 THEN 1000000 ELSE 1000 END
    WHEN NOT good THEN NULL
    WHEN off IS NOT NULL THEN wall - (CASE left(off, 1) WHEN '-' THEN -1 ELSE 1 END) * (oh * 60 + om)::BIGINT * 60000000
    WHEN is_before OR NOT is_after THEN before_us ELSE after_us END AS utc_us,
  CASE WHEN epoch THEN 'epoch' WHEN good THEN CASE WHEN NOT contested THEN 'plain' WHEN voted THEN 'votes' ELSE 'default' END ELSE 'bad' END AS rule,
  coalesce(NOT coalesce(epoch, false) AND good AND (contested OR (off IS NULL AND ((is_before AND is_after AND before_us <> after_us) OR (NOT is_before AND NOT is_after)))), false) AS ambiguous
FROM q
"""
