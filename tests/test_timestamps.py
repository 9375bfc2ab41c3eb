import datetime as dt
import zoneinfo

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from movelane.operators.timestamps import normalise_timestamps, normalised_instants

UTC = dt.timezone.utc


def micros(y, mo, d, h=0, mi=0, s=0, us=0, offset=0):
    return int((dt.datetime(y, mo, d, h, mi, s, us, UTC) - dt.datetime(1970, 1, 1, tzinfo=UTC)) / dt.timedelta(microseconds=1)) - offset * 60_000_000


CASES = [
    ("2025-04-20T18:41:27Z", None, None, micros(2025, 4, 20, 18, 41, 27)), ("2026-03-28T17:15:42+08:00", None, None, micros(2026, 3, 28, 17, 15, 42, 0, 480)), ("2025-04-18T08:54+12:45", None, None, micros(2025, 4, 18, 8, 54, 0, 0, 765)),
    ("2026-01-20T13:09-03:30", None, None, micros(2026, 1, 20, 13, 9, 0, 0, -210)), ("2025-04-25T19:03:08,230+0800", None, None, micros(2025, 4, 25, 19, 3, 8, 230000, 480)), ("2026-03-28T05:32:13-04:00[America/New_York]", "UTC", None, micros(2026, 3, 28, 5, 32, 13, 0, -240)),
    ("2026-01-26 18:36:15 Australia/Sydney", "Asia/Tokyo", None, micros(2026, 1, 26, 18, 36, 15, 0, 660)), ("20260126T160726Z", None, None, micros(2026, 1, 26, 16, 7, 26)), ("  2025-04-24T17:01:26.316Z \n", None, None, micros(2025, 4, 24, 17, 1, 26, 316000)),
    ("Sat, 28 Mar 2026 11:31:47 +0800", None, None, micros(2026, 3, 28, 11, 31, 47, 0, 480)), ("Fri 04-Apr-25 21:16:24", "Europe/Paris", None, micros(2025, 4, 4, 21, 16, 24, 0, 120)), ("13 April 2025", "Asia/Tokyo", None, micros(2025, 4, 13, 0, 0, 0, 0, 540)), ("Apr 24, 2025", None, None, micros(2025, 4, 24)),
    ("March 12, 2023 3:59 AM EDT", "America/New_York", None, micros(2023, 3, 12, 3, 59, 0, 0, -240)), ("20 January 2026, 9.54am IST", "Asia/Kolkata", None, micros(2026, 1, 20, 9, 54, 0, 0, 330)), ("20 January 2026, 9.54am IST", "Asia/Jerusalem", None, micros(2026, 1, 20, 9, 54, 0, 0, 120)),
    ("Mon, 26 Jan 2026 14:42:19 CST", "Asia/Shanghai", None, micros(2026, 1, 26, 14, 42, 19, 0, 480)), ("Mon, 26 Jan 2026 14:42:19 CST", "America/Chicago", None, micros(2026, 1, 26, 14, 42, 19, 0, -360)), ("July 16, 2024 6:22 AM EST", "America/New_York", None, micros(2024, 7, 16, 6, 22, 0, 0, -300)),
    ("Wed, 16 Apr 2025 14:54:10 SGT", "Europe/Paris", None, micros(2025, 4, 16, 14, 54, 10, 0, 480)), ("1 Feb 2025 12:00 GMT", "Europe/Dublin", None, micros(2025, 2, 1, 12)), ("1 Jul 2025 12:00 BST", "Asia/Tokyo", None, micros(2025, 7, 1, 12, 0, 0, 0, 60)),
    ("03/04/2025 10:00", None, "DMY", micros(2025, 4, 3, 10)), ("03/04/2025 10:00", None, "MDY", micros(2025, 3, 4, 10)), ("4/25/2025 1:33:20 PM", None, "MDY", micros(2025, 4, 25, 13, 33, 20)), ("23/4/2025 12:20:07 AM", None, "DMY", micros(2025, 4, 23, 0, 20, 7)), ("12-04-2025 09:34", None, "DMY", micros(2025, 4, 12, 9, 34)), ("29.3.2026 21:30", None, None, micros(2026, 3, 29, 21, 30)),
    ("1744995840", None, None, 1744995840_000000), ("1774752102475", None, None, 1774752102475_000), ("1769930792259620", None, None, 1769930792259620), ("2026年1月20日 9:30", "Asia/Tokyo", None, micros(2026, 1, 20, 9, 30, 0, 0, 540)), ("3 avril 2025", None, None, micros(2025, 4, 3)),
    # twice and never: the first occurrence, and forward by the gap
    ("2025-11-02 01:30", "America/New_York", None, micros(2025, 11, 2, 1, 30, 0, 0, -240)), ("2025-03-09 02:30", "America/New_York", None, micros(2025, 3, 9, 3, 30, 0, 0, -240)), ("2025-11-02 01:30:00 EST", "America/New_York", None, micros(2025, 11, 2, 1, 30, 0, 0, -300)), ("2025-10-05 02:15", "Australia/Sydney", None, micros(2025, 10, 5, 3, 15, 0, 0, 660)),
    ("2025-06-01 10:00", "Mars/Olympus", None, micros(2025, 6, 1, 10)), ("2025-06-01 10:00", None, None, micros(2025, 6, 1, 10)), ("2024-02-29", None, None, micros(2024, 2, 29)),
] + [(t, "Europe/Paris", o, None) for t in (None, "", " ", "yesterday", "n.d.", "null", "Spring edition", "25:61", "0000-00-00 00:00:00", "2024-13-01T00:00:00Z", "2023-02-30 10:00", "2023-02-29", "31/04/2024 09:15", "2025-01-01 24:00", "2025-01-01 10:60", "2025-01-01 10:00:60", "5 Foo 2025", "2025-01-01T10:00+19:00", "1/1/2025 13:00 PM", "12/2025", "x" * 100_000) for o in ("DMY",)]


def run(spark, rows):
    frame = spark.createDataFrame(rows, "id long, text string, zone string, ord string")
    return {r.id: r.utc_micros for r in normalise_timestamps(frame, "text", F.col("zone"), F.col("ord")).collect()}


def test_cases(spark):
    got = run(spark, [(i, t, z, o) for i, (t, z, o, _) in enumerate(CASES)])
    wrong = [(CASES[i][:3], got[i], want) for i, (*_, want) in enumerate(CASES) if got[i] != want]
    assert not wrong


ZONES = ["Europe/London", "America/New_York", "Australia/Sydney", "Asia/Kolkata", "Pacific/Auckland", "America/Sao_Paulo"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.datetimes(dt.datetime(1975, 1, 1), dt.datetime(2035, 1, 1)), st.sampled_from(ZONES), st.integers(0, 4)), min_size=50, max_size=120))
def test_wall_times_agree_with_the_zone_records(spark, draws):
    formats = ["%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%d %H:%M:%S", "%a, %d %b %Y %H:%M:%S", "%B %d, %Y %I:%M:%S %p", "%d/%m/%Y %H:%M:%S"]
    rows, want = [], {}
    for i, (wall, zone, f) in enumerate(draws):
        wall = wall if f == 0 else wall.replace(microsecond=0)
        rows.append((i, wall.strftime(formats[f]), zone, "DMY"))
        # fold=0 is the first of two and, in a gap, the offset before it: forward by the gap.
        want[i] = round((wall.replace(tzinfo=zoneinfo.ZoneInfo(zone), fold=0).astimezone(UTC) - dt.datetime(1970, 1, 1, tzinfo=UTC)) / dt.timedelta(microseconds=1))
    assert run(spark, rows) == want


@pytest.fixture
def tables(spark):
    sources = spark.createDataFrame([(1, ("a", {"time_zone": "Asia/Tokyo", "date_order": "DMY"}), "x"), (2, ("a", {"time_zone": "America/Chicago", "date_order": "MDY"}), None), (1, ("b", None), None), (1, (None, None), None)], "register_version int, config struct<slug string, options map<string,string>>, notes string")
    items = spark.createDataFrame([(1, "a", "04/17/2025 05:00"), (2, "b", "17/04/2025"), (3, "unlisted", "2025-04-17"), (4, None, "2025-04-17"), (5, "a", None), (5, "a", "soon"), (6, "a", "2025-04-17"), (6, "a", "2025-04-17")], "item_id long, source_slug string, published_at string")
    fetches = spark.createDataFrame([(1, "a", "2025-04-17 10:00", None), (2, None, "2025-04-17 10:00", "Asia/Singapore"), (None, "a", "x", None)], "fetch_id long, source_slug string, fetched_at string, clock_zone string")
    return sources, items, fetches


def test_zone_of_source_and_node(spark, tables):
    sources, items, fetches = tables
    clash = items.selectExpr("*", "1 as zone", "2 as text", "3 as slug", "4 as utc_micros", "5 as clock")
    got = sorted((r.record_kind, r.record_id, r.utc_micros) for r in normalised_instants(sources, clash, fetches).collect())
    assert got == sorted([
        ("item", 1, micros(2025, 4, 17, 5, 0, 0, 0, -300)), ("item", 2, micros(2025, 4, 17)), ("item", 3, micros(2025, 4, 17)), ("item", 4, micros(2025, 4, 17)), ("item", 6, micros(2025, 4, 17, 0, 0, 0, 0, -300)), ("item", 6, micros(2025, 4, 17, 0, 0, 0, 0, -300)),
        ("fetch", 1, micros(2025, 4, 17, 10)), ("fetch", 2, micros(2025, 4, 17, 10, 0, 0, 0, 480)),
    ])
    assert normalised_instants(sources.limit(0), items.limit(0), fetches.limit(0)).count() == 0
    assert normalised_instants(sources.limit(0), items, fetches).count() == 7
