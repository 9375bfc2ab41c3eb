import pytest
from pyspark.sql import functions as F

from movelane.sources import articles, feed, mailbox, register, sitemap
from movelane.streaming import ingest

RSS = """<?xml version="1.0"?><rss xmlns:content="http://x/"><channel><title>c</title>
<item><title>Alder hires &amp;amp; more</title><link>https://x.example/a</link><pubDate>Sat, 29 Mar 2025 10:00:00 +0000</pubDate><description>&lt;p&gt;One  two&lt;/p&gt;</description></item>
<item><title>Old</title><link>https://x.example/old</link><pubDate>Sat, 01 Jan 2000 10:00:00 GMT</pubDate></item>
<item><title>No link</title></item><item><link>https://x.example/untitled</link></item><item><title>Undated</title><guid>https://x.example/u</guid></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Alder again</title><link rel="alternate" href="https://x.example/a"/><updated>2025-04-01T00:00:00Z</updated><summary>s</summary></entry></feed>"""


def test_feeds(spark, tmp_path):
    (tmp_path / "1.xml").write_text(RSS)
    (tmp_path / "2.xml").write_text(ATOM)
    (tmp_path / "3.xml").write_text("not xml <")
    got = {r.url: r for r in feed.read_feeds(spark, str(tmp_path), since="2024-01-01").collect()}
    assert set(got) == {"https://x.example/a", "https://x.example/u"}
    assert got["https://x.example/a"].headline == "Alder hires & more" and got["https://x.example/a"].body_text == "One two" and not got["https://x.example/a"].published_at_is_estimated
    assert got["https://x.example/u"].published_at_is_estimated
    assert feed.broken_files(spark, str(tmp_path)).count() == 1
    assert all(r.body_text is None for r in feed.read_feeds(spark, str(tmp_path), access="headline_only").collect())


def test_pages_stop_when_older(spark, tmp_path):
    entry = "<item><title>T {n}</title><link>https://x.example/{n}</link><pubDate>{d} Mar 2025 10:00:00 GMT</pubDate></item>"
    for page, days in enumerate([(20, 19), (18, 10), (9, 8), (30,)], 1):
        (tmp_path / f"p{page}.xml").write_text("<rss><channel>" + "".join(entry.format(n=f"{page}{d}", d=d) for d in days) + "</channel></rss>")
    pages = [str(tmp_path / f"p{i}.xml") for i in range(1, 5)]
    got = {r.url.rsplit("/", 1)[-1] for r in feed.read_pages(spark, pages, since="2025-03-15").collect()}
    assert got == {"120", "119", "218"}
    assert feed.read_pages(spark, pages).count() == 2


def test_sitemaps(spark, tmp_path):
    urls = "".join(f"<url><loc>https://x.example/2023/firm-hires-partner-{i}</loc><lastmod>2025-01-01</lastmod></url>" for i in range(12))
    (tmp_path / "bulk.xml").write_text(f"<urlset>{urls}</urlset>")
    (tmp_path / "fine.xml").write_text("<urlset><url><loc>https://x.example/news/alder-opens-office</loc><lastmod>2024-05-06T10:00:00Z</lastmod></url><url><loc>https://x.example/tag/x</loc></url></urlset>")
    (tmp_path / "bad.xml").write_text("nothing")
    got = {r.url: r for r in sitemap.read_sitemaps(spark, [str(tmp_path / n) for n in ("bulk.xml", "fine.xml", "bad.xml")], exclude="/tag/").collect()}
    assert len(got) == 13
    fine = got["https://x.example/news/alder-opens-office"]
    assert str(fine.published_on) == "2024-05-06" and not fine.date_is_estimated and fine.headline == "Alder opens office"
    assert {str(r.published_on) for u, r in got.items() if "/2023/" in u} == {"2023-07-01"}


def test_mailbox(spark, tmp_path):
    body = '<a href="https://x.example/a?utm_source=n&id=1">Alder hires a partner today</a><a href="https://x.example/unsubscribe">click here to unsubscribe now</a><a href="https://x.example/b">too short</a>'
    (tmp_path / "m.eml").write_text(f"From: News <n@outlet.example>\nDate: Sat, 29 Mar 2025 10:00:00 +0000\nContent-Type: text/html\n\n{body}")
    (tmp_path / "s.eml").write_text(f"From: spam@other.example\nContent-Type: text/html\n\n{body}")
    got = mailbox.read_mailbox(spark, str(tmp_path), ["outlet.example"]).collect()
    assert [(r.url, r.headline) for r in got] == [("https://x.example/a?id=1", "Alder hires a partner today")]
    with pytest.raises(ValueError):
        mailbox.read_mailbox(spark, str(tmp_path), [])


def test_article_cache(spark, tmp_path):
    cache = articles.ArticleCache(spark, str(tmp_path / "cache"))
    pages = spark.createDataFrame([("u1", "<h1>A firm hires people</h1><p>" + "words and more " * 20 + "</p>"), ("u2", "")], "url string, html string")
    assert cache.read().count() == 0
    assert cache.add(pages).count() == 2
    assert cache.add(pages).count() == 2 and cache.read().count() == 2
    assert cache.read().filter("url = 'u1'").first().title == "A firm hires people"


def test_register(spark):
    schema = "register_version int, config struct<slug string, adapter string, reliability_tier int, feed_url string, firm_name string>"
    good = spark.createDataFrame([(1, ("a", "feed", 2, "u", None)), (2, ("a", "feed", 3, "u", None))], schema)
    assert register.load_register(good).first().config.reliability_tier == 3
    with pytest.raises(ValueError, match="known_adapter"):
        register.load_register(good.unionByName(spark.createDataFrame([(1, ("b", "telex", 2, None, None))], schema)))


def test_stream_sink_and_streaks(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "url string, n int").coalesce(1).write.parquet(str(source))
    write = ingest.store(spark, str(out))
    batch = spark.read.parquet(str(source))
    write(batch, 0)
    write(batch, 0)
    assert spark.read.parquet(str(out)).count() == 2
    polls = tmp_path / "polls"
    rows = [("s", f"2025-01-0{d} 00:00:00", n) for d, n in ((1, 0), (2, 0), (3, 5), (4, 0))]
    spark.createDataFrame(rows, "source string, at string, new_items int").selectExpr("source", "cast(at as timestamp) at", "new_items").coalesce(1).write.parquet(str(polls))
    stream = ingest.empty_streaks(spark.readStream.schema("source string, at timestamp, new_items int").parquet(str(polls)))
    stream.writeStream.format("memory").queryName("streaks").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert [r.streak for r in spark.table("streaks").orderBy("at").collect()] == [1, 2, 0, 1]


def test_publication_date(spark):
    rows = spark.createDataFrame([("2025-02-03", "https://x/2020/a"), (None, "https://x/2020/a"), (None, "https://x/a")], "d string, u string").withColumn("d", F.to_date("d"))
    date, estimated = sitemap.publication_date(F.col("d"), F.col("u"))
    got = rows.select(date.alias("x"), estimated.alias("e")).collect()
    assert [str(r.x) for r in got[:2]] == ["2025-02-03", "2020-07-01"] and [r.e for r in got] == [False, True, True]
