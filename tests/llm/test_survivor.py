import datetime as dt

from pyspark.sql import functions as F

from movelane.llm import survivor

MOVES = "move_id long, source_slug string, fields map<string, struct<value string, span_start int, span_end int, quality string>>, self_confidence double, extracted_at timestamp, group_ref long"
SOURCES = "register_version int, config struct<slug string, reliability_tier int>, notes string"


def field(value, quality="exact"):
    return (value, 0, 1, quality)


def at(day):
    return dt.datetime(2025, 1, day) if day else None


def run(spark, moves, sources=((1, ("good", 1), "x"), (1, ("old", 1), None), (2, ("old", 3), None), (1, ("none", None), None))):
    frame = spark.createDataFrame(moves, MOVES)
    return {(r.group_ref, r.field_name): r.move_id for r in survivor.surviving_values(frame, spark.createDataFrame(list(sources), SOURCES)).collect()}


def test_order_of_authority(spark):
    got = run(spark, [
        (1, "old", {"tier": field("a")}, 0.9, at(1), 1), (2, "good", {"tier": field("b")}, 0.1, at(1), 1),
        (3, "good", {"conf": field("a")}, 80.0, at(1), 1), (4, "good", {"conf": field("b")}, 0.79, at(9), 1), (5, "good", {"conf": field("c")}, None, at(9), 1),
        (6, "good", {"time": field("a")}, 0.5, at(1), 1), (7, "good", {"time": field("b")}, 0.5, at(2), 1), (8, "good", {"time": field("b")}, 0.5, at(2), 1),
        (9, "none", {"last": field("a")}, 0.5, at(1), 1), (10, "unlisted", {"last": field("b")}, 0.6, at(1), 1), (11, None, {"last": field("b")}, 0.6, at(1), 1),
    ])
    assert got == {(1, "tier"): 2, (1, "conf"): 3, (1, "time"): 7, (1, "last"): 10}


def test_only_stated_values_survive(spark):
    unstated = [None, "", "  ", " ", "-", "--", "?", "n/a", "N/A ", "Not stated", "UNKNOWN", "undisclosed", "(none given)", "tbc."]
    moves = [(i, "good", {"f": field(v)}, 0.9, at(1), 5) for i, v in enumerate(unstated)]
    moves += [(90, "good", {"f": field("Partner", "dropped")}, 0.9, at(1), 5), (91, "old", {"f": field("None Taken LLP")}, 0.1, at(1), 5), (92, "good", {"f": None}, 0.9, at(1), 5), (93, "good", None, 0.9, at(1), 5)]
    assert run(spark, moves) == {(5, "f"): 91}
    assert run(spark, moves[:-3]) == {}


def test_groups_and_empty_tables(spark):
    assert run(spark, [(1, "good", {"f": field("a")}, 0.9, at(1), None)]) == {}
    assert run(spark, []) == {}
    assert run(spark, [(1, "good", {"f": field("x" * 100_000)}, 0.9, at(1), 1)], sources=()) == {(1, "f"): 1}


def test_currency_is_reasoned_without_timestamps(spark):
    # Elsewhere Counsel became Partner again and again; here nothing is dated.
    moves = [(100 + 2 * g, "good", {"title": field("Counsel")}, 0.5, at(1), 10 + g) for g in range(4)] + [(101 + 2 * g, "good", {"title": field("Partner")}, 0.5, at(5), 10 + g) for g in range(4)]
    moves += [(1, "good", {"title": field("Counsel")}, 0.5, None, 1), (2, "good", {"title": field("Partner")}, 0.5, None, 1)]
    got = run(spark, moves)
    assert got[1, "title"] == 2 and got[10, "title"] == 101
    frame = spark.createDataFrame(moves, MOVES).withColumn("tier", F.lit(5)).withColumn("value", F.lit("x")).withColumn("slug", F.lit(1))
    assert survivor.surviving_values(frame, spark.createDataFrame([(1, ("good", 1), None)], SOURCES)).filter("group_ref = 1").first().value == "Partner"
