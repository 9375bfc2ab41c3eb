"""Queries that once did less than the whole job."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from movelane import plans
from movelane.functions import gazetteer
from movelane.session import table
from movelane.streaming import ingest


def test_practice_is_read_from_sentences_about_the_person(spark, small, tmp_path):
    practice, other = [r.name for r in table(spark, small, "ref_values").filter("kind = 'practice'").orderBy("ref_code").limit(2).collect()]
    bodies = {
        1: f"The firm grows.\nJane O’Brien's practice is {practice}. Tom Field leads {other}.", 2: f"Tom Field leads {other}. Jane O'Brien has joined.", 3: None,
        4: f"Smith’s team does {other}", 5: f"Smithson heads {other}.",
    }
    people = {1: "Jane O'Brien", 2: "Jane O'Brien", 3: "Jane O'Brien", 4: "Dr John Smith", 5: "John Smith"}
    pick = lambda values: F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col("n")]
    first = lambda name, key: table(spark, small, name).orderBy(key).limit(5).withColumn("n", F.row_number().over(Window.orderBy(key)))
    moves = first("extracted_moves", "move_id").withColumns({"move_id": F.col("n").cast("long"), "item_id": F.col("n").cast("long"), "person_name": pick(people), "fields": F.filter(F.map_entries("fields"), lambda x: F.lit(False))})
    moves.withColumn("fields", F.map_from_entries("fields")).drop("n").write.parquet(f"{tmp_path}/extracted_moves.parquet")
    items = first("raw_items", "item_id").withColumns({"item_id": F.col("n").cast("long"), "headline": F.lit("A new arrival"), "body_text": pick(bodies)})
    items.drop("n").write.parquet(f"{tmp_path}/raw_items.parquet")
    table(spark, small, "ref_values").write.parquet(f"{tmp_path}/ref_values.parquet")
    got = {r.move_id: (r.rule_key.split(":")[0], r.rule_key.split(":")[-1], float(r.confidence)) for r in plans.queries()["t22_classify_with_body"](spark, str(tmp_path)).collect()}
    none = ("no_mapping_matched", "no_mapping_matched", 0.0)
    index = {r.name: r.n for r in table(spark, small, "ref_values").select("name", F.lower("name").alias("n")).collect()}
    assert got[1][0] == "body" and got[1][2] == 0.48 and got[1][1][:4] == index[practice][:4]
    assert got[4][0] == "body" and got[4][1][:4] == index[other][:4]
    assert got[2] == got[3] == got[5] == none


def test_windows_have_all_rows(spark, small):
    rows = table(spark, small, "raw_items")
    expected = rows.groupBy(F.window("arrived_at", "7 days"), "source_slug").agg(F.count("*").alias("items")).filter("window is not null").select("window.start", "source_slug", "items")
    got = plans.queries()["stream_windows"](spark, small)
    assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str)
    assert got.agg(F.sum("items")).first()[0] == rows.filter("arrived_at is not null").count()


def test_windows_over_several_batches(spark, tmp_path):
    folder, rows = str(tmp_path / "in"), [("a", "2025-01-01"), ("b", "2025-01-09"), (None, "2025-01-09"), ("a", "2025-01-02"), ("a", "2020-01-01"), (None, "2025-01-09")]
    frame = spark.createDataFrame(rows, "k string, at string").withColumn("at", F.col("at").cast("timestamp"))
    for part in (frame.limit(3), frame.exceptAll(frame.limit(3))):
        part.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    counts = ingest.open_counts(stream, "at", "7 days", "k").select("window.start", "k", "items")
    sink = ingest.upsert_into(spark, f"{tmp_path}/out", ["start", "k"])
    counts.writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/state").outputMode("update").trigger(availableNow=True).start().awaitTermination()
    expected = frame.groupBy(F.window("at", "7 days"), "k").agg(F.count("*").alias("items")).select("window.start", "k", "items")
    assert sorted(spark.read.parquet(ingest.latest(spark, f"{tmp_path}/out")).collect(), key=str) == sorted(expected.collect(), key=str)


def test_sorts_have_all_rows_in_order(spark, small):
    moves = [(r.source_slug, r.move_id) for r in table(spark, small, "extracted_moves").select("source_slug", "move_id").collect()]
    got = [(r.source_slug, r.move_id) for r in plans.queries()["o02_nulls_first_all"](spark, small).collect()]
    assert got == sorted(moves, key=lambda x: (x[0] is not None, x[0] or "", x[1])) and len(got) > 40
    surfaces = [r.surface for r in plans.queries()["o04_longest_first_all"](spark, small).collect()]
    assert surfaces == sorted({r.s for r in table(spark, small, "firms").select(gazetteer.normal(F.col("canonical_name")).alias("s")).collect()}, key=lambda s: (-len(s), s)) and len(surfaces) > 20
