"""Timestamps in many notations to one instant in UTC.

An ordered cascade of anchored patterns rewrites a text to one row of named parts; strict constructors then turn the
parts into an instant or into null. The first pattern that matches decides: if its parts form no date, no later pattern
is tried. Everything is built from JVM expressions, so the scan, the cascade and the arithmetic are one codegen stage.

Policies
  * a numeric offset or an abbreviation decides over any default zone;
  * a wall time that occurs twice is its first occurrence (the earlier offset);
  * a wall time that is skipped moves forward by the length of the gap;
  * numbers alone count seconds, milliseconds or microseconds, told apart by magnitude;
  * day and month both in figures with the year last follow the source's order; a date alone starts its day;
  * seconds run to 59, hours to 23 (1 to 12 with am or pm), offsets to 18:00; everything else is no instant (null).
"""

from __future__ import annotations

import datetime as dt
import functools
import zoneinfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Month names by number, in the languages of the outlets.
MONTHS = {
    1: "january jan janvier janv januar enero ene",
    2: "february feb février fevrier févr fevr februar febrero",
    3: "march mar mars märz maerz mrz marzo",
    4: "april apr avril avr abril abr",
    5: "may mai mayo",
    6: "june jun juin juni junio",
    7: "july jul juillet juil juli julio",
    8: "august aug août aout agosto ago",
    9: "september sep sept septembre septiembre",
    10: "october oct octobre oktober okt octubre",
    11: "november nov novembre noviembre",
    12: "december dec décembre decembre déc dezember dez diciembre dic",
}
# Minutes east of UTC of abbreviations where the zone's own records don't say.
ABBREVIATIONS = {
    "UTC": 0, "GMT": 0, "UT": 0, "Z": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "GST": 240, "PKT": 300, "IST": 330, "NPT": 345, "ICT": 420, "WIB": 420, "WITA": 480,
    "WIT": 540, "SGT": 480, "MYT": 480, "HKT": 480, "PHT": 480, "AWST": 480, "JST": 540, "KST": 540, "ACST": 570, "ACDT": 630,
    "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420,
    "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600, "AST": -240, "ADT": -180, "NST": -210,
    "NDT": -150, "BRT": -180, "ART": -180,
}
# Abbreviations in local use that zone records don't carry, by zone.
LOCAL_ABBREVIATIONS = {
    ("Asia/Dubai", "GST"): 240, ("Asia/Singapore", "SGT"): 480, ("Asia/Kuala_Lumpur", "MYT"): 480, ("Asia/Dhaka", "BST"): 360,
    ("Asia/Bangkok", "ICT"): 420, ("Asia/Ho_Chi_Minh", "ICT"): 420, ("Atlantic/South_Georgia", "GST"): -120,
    ("Asia/Kathmandu", "NPT"): 345, ("Pacific/Bougainville", "BST"): 660, ("Asia/Riyadh", "AST"): 180,
    ("Australia/Sydney", "EST"): 600, ("Australia/Sydney", "EDT"): 660, ("Australia/Melbourne", "EST"): 600,
    ("Australia/Melbourne", "EDT"): 660, ("Australia/Brisbane", "EST"): 600, ("Australia/Adelaide", "CST"): 570,
}

PARTS = ["form", "year", "month", "day", "hour", "minute", "second", "fraction", "half", "offset", "zone"]
_DAY = r"(?:mon|tue|wed|thu|fri|sat|sun|lun|mar|mer|jeu|ven|sam|dim|mo|di|mi|do|fr|sa|so)[\p{L}]*\.?,?\s+"
_MONTH = r"(\p{L}{3,10})\.?"
_CLOCK = r"(\d{1,2})[:.](\d{2})(?:[:.](\d{2})(?:[.,](\d{1,9}))?)?\s*(?:([ap])\.?m\.?)?"
_ZONE = r"\s*([+-]\d{2}:?\d{2}|[+-]\d{2})?\s*(?:\[?([\p{L}][\p{L}0-9_+/-]*)\]?)?"
#: (name, pattern, replacement). The replacement names the parts in the order of PARTS, from the second on.
CASCADE = [
    ("number", r"^(-?\d{9,17})(?:\.(\d{1,6}))?$", "$1|||||" + "|$2|||"),
    ("iso", rf"^(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}})(?:(?:\s*t|\s+)(\d{{1,2}}):(\d{{2}})(?::(\d{{2}})(?:[.,](\d{{1,9}}))?)?()?{_ZONE})?$", "$1|$3|$4|$5|$6|$7|$8|$9|$10|$11"),
    ("compact", rf"^(\d{{4}})(\d{{2}})(\d{{2}})t(\d{{2}})(\d{{2}})(\d{{2}})?(?:[.,](\d{{1,9}}))?{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7||$8|$9"),
    ("day_first", rf"^(?:{_DAY})?(\d{{1,2}})(?:st|nd|rd|th|\.)?[\s-]+(?:de\s+)?{_MONTH}[\s-]+(?:de\s+)?(\d{{4}}|\d{{2}})(?:,?(?:\s+at)?\s+{_CLOCK}{_ZONE})?$", "$3|$2|$1|$4|$5|$6|$7|$8|$9|$10"),
    ("month_first", rf"^(?:{_DAY})?{_MONTH}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?:,?(?:\s+at)?\s+{_CLOCK}{_ZONE})?$", "$3|$1|$2|$4|$5|$6|$7|$8|$9|$10"),
    ("year_last", rf"^(\d{{1,2}})([/.-])(\d{{1,2}})\2(\d{{4}})(?:,?\s+{_CLOCK}{_ZONE})?$", "$4|$1|$3|$5|$6|$7|$8|$9|$10|$11"),
    ("cjk", rf"^(\d{{4}})年(\d{{1,2}})月(\d{{1,2}})日(?:\s*{_CLOCK}{_ZONE})?$", "$1|$2|$3|$4|$5|$6|$7|$8|$9|$10"),
]


@functools.lru_cache(maxsize=1)
def zone_abbreviations() -> list[tuple[str, str, int]]:
    """(zone, abbreviation, minutes east of UTC): the latest meaning of every alphabetic abbreviation a zone has used."""
    found: dict[tuple[str, str], int] = {}
    days = [dt.datetime(year, month, 1, 12, tzinfo=dt.timezone.utc) for year in range(1990, 2038) for month in (1, 7)]
    for name in sorted(zoneinfo.available_timezones()):
        zone = zoneinfo.ZoneInfo(name)
        for day in days:
            local = day.astimezone(zone)
            if (short := local.tzname() or "").isalpha():
                found[name, short.upper()] = int(local.utcoffset().total_seconds() // 60)
    found.update(LOCAL_ABBREVIATIONS)
    return [(zone, short, minutes) for (zone, short), minutes in sorted(found.items())]


def abbreviation_table(spark: SparkSession) -> DataFrame:
    """The zones' own abbreviations (about 2,000 rows, fixed by the zone records)."""
    return spark.createDataFrame(zone_abbreviations(), "abbr_zone string, abbr string, abbr_minutes int")


def _literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def trimmed(text: Column) -> Column:
    """Outer white space of any kind removed, inner runs collapsed to one space."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\u200b\ufeff]+", " "))


def timestamp_parts(text: Column) -> Column:
    """The cascade: array of PARTS as strings ('' where absent), or null where no pattern matches."""
    line = trimmed(text)
    picked = None
    for name, pattern, replacement in CASCADE:
        groups = F.concat(F.lit(name + "|"), F.regexp_replace(line, "(?iu)" + pattern, replacement))
        hit = line.rlike("(?iu)" + pattern)
        picked = F.when(hit, groups) if picked is None else picked.when(hit, groups)
    return F.split(picked, r"\|", -1)


def normalise_timestamps(frame: DataFrame, text: str, zone: Column, date_order: Column, out: str = "utc_micros") -> DataFrame:
    """``frame`` with the column ``out``: microseconds since 1970 UTC of the instant that column ``text`` denotes.

    ``zone`` is the default time zone (null or unknown: UTC), ``date_order`` is DMY or MDY (null: DMY). Null, blank and
    impossible texts give null. Columns of ``frame`` are kept; a column already called ``out`` is replaced.
    """
    spark = frame.sparkSession
    months = _literal_map({name: number for number, names in MONTHS.items() for name in names.split()})
    generic = _literal_map(ABBREVIATIONS)
    work = frame.withColumn("__p", timestamp_parts(F.col(text))).withColumn("__z", F.coalesce(zone, F.lit("UTC"))).withColumn("__o", F.upper(F.coalesce(date_order, F.lit("DMY"))))
    part = {name: F.get(F.col("__p"), F.lit(i)) for i, name in enumerate(PARTS)}
    number = lambda c: c.try_cast("int")
    order = part["form"] == "year_last"
    swap = order & (F.col("__o") == "MDY")
    # For year_last, 'month' holds the first figure and 'day' the second.
    first, second = part["month"], part["day"]
    day = F.when(swap, number(second)).when(order, number(first)).otherwise(number(second))
    named = part["form"].isin("day_first", "month_first")
    month = F.when(swap, number(first)).when(order, number(second)).when(named, F.element_at(months, F.lower(first))).otherwise(number(first))
    year = number(part["year"])
    year = F.when(F.length(part["year"]) == 2, year + F.when(year < 70, 2000).otherwise(1900)).otherwise(year)
    hour, half = number(part["hour"]), F.lower(part["half"])
    hour = (
        F.when(part["hour"] == "", F.lit(0))
        .when(half == "", hour)
        .when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    )
    minute = F.when(part["minute"] == "", F.lit(0)).otherwise(number(part["minute"]))
    second_ = F.when(part["second"] == "", F.lit(0)).otherwise(number(part["second"]))
    micros = F.rpad(F.substring(part["fraction"], 1, 6), 6, "0").try_cast("int")
    zone_word = part["zone"]
    work = work.select(
        *[c for c in frame.columns if c != out], "__z",
        part["form"].alias("__form"),
        F.regexp_extract(part["year"], r"^-?\d+$", 0).try_cast("long").alias("__count"), micros.alias("__us"),
        F.when(second_.between(0, 59) & minute.between(0, 59) & hour.between(0, 23), F.struct(year.alias("y"), month.alias("mo"), day.alias("d"), hour.alias("h"), minute.alias("mi"), second_.alias("s"))).alias("__t"),
        part["offset"].alias("__off"),
        F.when(zone_word.contains("/"), zone_word).alias("__named"),
        F.when((zone_word != "") & ~zone_word.contains("/"), F.upper(zone_word)).alias("__abbr"),
    )
    known = abbreviation_table(spark)
    work = work.join(F.broadcast(known), (F.col("__z") == F.col("abbr_zone")) & (F.col("__abbr") == F.col("abbr")), "left")
    sign = F.when(F.col("__off").startswith("-"), -1).otherwise(1)
    digits = F.rpad(F.regexp_replace("__off", "[^0-9]", ""), 4, "0")
    off_hours, off_minutes = number(F.substring(digits, 1, 2)), number(F.substring(digits, 3, 2))
    offset = F.when((off_minutes < 60) & (off_hours * 60 + off_minutes <= 18 * 60), sign * (off_hours * 60 + off_minutes))
    generic_minutes = F.element_at(generic, F.col("__abbr"))
    fixed = F.when(F.col("__off") != "", offset).otherwise(F.coalesce(F.when(generic_minutes == 0, generic_minutes), F.col("abbr_minutes"), generic_minutes))
    settled = (F.col("__off") != "") | F.col("__abbr").isNotNull()
    clock = "try_make_timestamp(__t.y, __t.mo, __t.d, __t.h, __t.mi, cast(__t.s as decimal(8,6)), {zone})"
    utc = F.expr(f"unix_micros({clock.format(zone=repr('UTC'))})")
    local = F.expr(f"unix_micros(coalesce({clock.format(zone='__named')}, if(__named is null, {clock.format(zone='__z')}, null)))")
    fallback = F.when(F.col("__named").isNull() & F.expr(f"{clock.format(zone='__z')} is null"), utc)
    magnitude = F.abs("__count")
    count = (
        F.when(magnitude < 10**11, F.col("__count") * 1000000 + F.coalesce("__us", F.lit(0)))
        .when(magnitude < 10**14, F.col("__count") * 1000)
        .otherwise(F.col("__count"))
    )
    value = (
        F.when(F.col("__form") == "number", count)
        .when(settled, utc + F.coalesce("__us", F.lit(0)) - fixed.cast("long") * 60000000)
        .otherwise(F.coalesce(local, fallback) + F.coalesce("__us", F.lit(0)))
    )
    return work.select(*[c for c in frame.columns if c != out], value.alias(out))


def source_settings(sources: DataFrame) -> DataFrame:
    """slug, zone, date_order of each source: the settings of its highest register_version."""
    return (
        sources.filter(F.col("config.slug").isNotNull())
        .groupBy(F.col("config.slug").alias("slug"))
        .agg(F.max_by(F.struct(F.col("config.options")["time_zone"].alias("zone"), F.col("config.options")["date_order"].alias("date_order")), F.struct(F.col("register_version"), F.col("notes"))).alias("s"))
        .select("slug", "s.zone", "s.date_order")
    )


def normalised_instants(sources: DataFrame, raw_items: DataFrame, fetches: DataFrame) -> DataFrame:
    """(record_kind, record_id, utc_micros) of every published_at and fetched_at that denotes an instant.

    Items of no or an unregistered source are read in UTC with the day first; empty tables give no rows.
    """
    settings = source_settings(sources)
    items = raw_items.filter(F.col("published_at").isNotNull()).select(F.lit("item").alias("record_kind"), F.col("item_id").alias("record_id"), F.col("published_at").alias("text"), F.col("source_slug").alias("slug"), F.lit(None).cast("string").alias("clock"))
    nodes = fetches.filter(F.col("fetched_at").isNotNull()).select(F.lit("fetch").alias("record_kind"), F.col("fetch_id").alias("record_id"), F.col("fetched_at").alias("text"), F.col("source_slug").alias("slug"), F.coalesce("clock_zone", F.lit("UTC")).alias("clock"))
    rows = items.unionByName(nodes).join(settings, "slug", "left")
    zoned = rows.select("record_kind", "record_id", "text", F.coalesce("clock", "zone").alias("zone"), "date_order")
    return normalise_timestamps(zoned, "text", F.col("zone"), F.col("date_order")).filter("utc_micros is not null").select("record_kind", "record_id", "utc_micros")
