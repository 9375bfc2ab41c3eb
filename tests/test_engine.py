import datetime as dt

import pytest
from pyspark.sql import functions as F

from movelane.functions import confidence, gazetteer, html, names, spans, taxonomy
from movelane.operators import dedupe, extraction, gate, integrity, slots, upkeep


def test_name_keys(spark):
    cases = {
        "Tan Wei Ming": ("tan", "weiming"), "Wei Ming Tan": ("tan", "weiming"), "Jan van der Berg": ("vanderberg", "jan"), "Min-jun Kim": ("kim", "minjun"), "Lim Tan": ("tan", "lim"), "Wei Ming (Kevin) Tan SC": ("tan", "weiming"),
        "Mr Ma": ("ma", None), "Dr Ada O'Brien": ("obrien", "ada"), "Zoë Brönte": ("bronte", "zoe"), "陈伟明": ("陈", "伟明"), "": ("", None), None: ("", None), "Thanh Le": ("le", "thanh"),
    }
    frame = spark.createDataFrame([(k,) for k in cases], "name string")
    got = {r.name: (r.surname_key, r.given_key) for r in names.with_name_keys(frame, "name").collect()}
    assert got == cases


def test_name_variants_and_hash(spark):
    frame = spark.createDataFrame([("Min-jun (Leo) Kim",), ("Kim",)], "name string")
    got = [r.variants for r in names.with_name_variants(frame, "name").orderBy(F.length("name").desc()).collect()]
    assert got == [["Kim Min-Jun", "Leo Kim", "Min-Jun Kim", "Min-jun (Leo) Kim", "Minjun Kim"], ["Kim"]]
    rows = spark.createDataFrame([("Dr. Zoë  Brönte KC",), ("zoe bronte",)], "name string").select(names.name_hash(F.col("name"), "s").alias("h")).collect()
    assert rows[0].h == rows[1].h


def test_language_gate(spark):
    cases = [
        ("Northgate LLP welcomes Ada Example as partner", None, 2, True, "relevant"), ("Firm strengthens its tax practice", None, 1, True, "relevant"), ("Firm strengthens its tax practice", None, 2, False, "no seniority"), ("Partner wins award", None, 2, False, "disqualifier"),
        ("Ada Example named chief justice", None, 1, False, "judicial"), ("Results are out", None, 1, False, "no movement"), (None, None, None, False, "no movement"), ("News", "He joined the firm as a partner after the webinar", 3, True, "relevant"), ("Firm joins the green alliance", None, 1, False, "disqualifier"),
    ]
    frame = spark.createDataFrame([(i, h, b, t) for i, (h, b, t, *_) in enumerate(cases)], "id int, h string, b string, t int")
    got = {r.id: (r.g.passed, r.g.reason) for r in frame.select("id", gate.language_gate(F.col("h"), F.col("b"), F.col("t")).alias("g")).collect()}
    assert got == {i: (p, r) for i, (*_, p, r) in enumerate(cases)}


def test_gazetteer_is_leftmost_longest_without_overlap(spark):
    index = spark.createDataFrame([("ey", 1), ("new york", 2), ("york place", 3), ("allen overy", 4), ("allen", 5)], "surface string, code int")
    texts = spark.createDataFrame([(1, "They moved to New York Place"), (2, "Allen & Overy and Allen hire in EY"), (3, ""), (4, None)], "id int, t string")
    got = {}
    for r in gazetteer.hits(texts, index, "id", "t").orderBy("place").collect():
        got.setdefault(r.id, []).append(r.code)
    assert got == {1: [2], 2: [4, 5, 1]}
    assert {r.id: r.code for r in gazetteer.first_hit(texts, index, "id", "t").collect()} == {1: 2, 2: 4}


def test_taxonomy_evidence_order(spark):
    index = spark.createDataFrame([("family law", "g1.a"), ("tax", "g2.b"), ("business", None)], "surface string, code string")
    texts = spark.createDataFrame([(1, "Family Law", "tax"), (2, None, "head of tax joins"), (3, "x", "y"), (4, "business", "tax")], "id int, stated string, headline string")
    got = {r.id: (r.code, r.rule_key, float(r.confidence)) for r in taxonomy.classify_by_evidence(texts, index, "id", {"stated": "stated", "headline": "headline"}).collect()}
    assert got == {1: ("g1.a", "stated:family law", 0.95), 2: ("g2.b", "headline:tax", 0.6), 3: ("unclassified", "no_mapping_matched", 0.0), 4: ("unclassified", "stated:business", 0.9)}


def test_html_and_urls(spark):
    page = "<html><head><title>A firm hires a partner | Site</title></head><body><!-- x --><nav>Home</nav><h1>A firm hires a partner</h1><p>One &amp; two.</p><script>var x</script><p>Three<br>four</p></body></html>"
    row = spark.createDataFrame([(page, "https://x.example/2024/a-firm-hires-12345/?utm_source=y&id=3")], "p string, u string").select(html.html_to_text(F.col("p")).alias("t"), html.title_of(F.col("p")).alias("h"), html.headline_from_slug(F.col("u")).alias("s"), html.strip_tracking(F.col("u")).alias("c")).first()
    assert row.t.split("\n")[-3:] == ["One & two.", "Three", "four"] and "Home" not in row.t and "var x" not in row.t
    assert (row.h, row.s, row.c) == ("A firm hires a partner", "A firm hires", "https://x.example/2024/a-firm-hires-12345/?id=3")
    body = "word " * 40 + "Subscribe to our letters. More."
    out = spark.createDataFrame([(body,)], "b string").select(html.trim_tail(F.col("b")).alias("x")).withColumn("y", html.trim_tail(F.col("x"))).first()
    assert out.x == out.y == ("word " * 40).strip()


def test_spans(spark):
    rows = [("Ada", 0, 3, "Ada joins"), ("ADA", 0, 3, "Ada joins"), ("joins", 0, 3, "Ada joins"), ("Bo", 0, 3, "Ada joins"), ("", 0, 3, "Ada"), (None, 0, 3, "Ada")]
    got = [r.q.quality for r in spark.createDataFrame(rows, "v string, a int, b int, t string").select(spans.verify(F.col("v"), F.col("a"), F.col("b"), F.col("t")).alias("q")).collect()]
    assert got == ["exact", "exact", "recovered", "dropped", "dropped", "dropped"]


def test_confidence_bounds(spark):
    frame = spark.createDataFrame([(3, "full_public"), (2, "headline_only"), (1, "full_public"), (None, None)], "tier int, access string")
    full = F.lit(1.0).cast("decimal(10,6)")
    got = [float(r.t) for r in frame.select(confidence.total(confidence.tier_base(F.col("tier")), confidence.access_factor(F.col("access")), full, full, F.lit(0), F.lit(1)).alias("t")).collect()]
    assert got == [0.75, 0.824, 1.0, 0.59]
    assert all(x < confidence.ACCEPT for x in got[:2])


def move(i, name, day, firm=1, origin=None, office=None, title=None, source="a", conf=0.5):
    return (i, name, firm, dt.date(2025, 1, 1) + dt.timedelta(days=day), origin, office, title, source, conf)


SCHEMA = "move_id long, person_name string, to_firm_id long, announced_date date, from_firm string, office string, title_to string, source_slug string, confidence double"


def test_pair_scores(spark):
    rows = [move(1, "Ada Tan", 0), move(2, "Tan Ada", 10), move(3, "Bo Tan", 5), move(4, "Tan", 5), move(5, "A. Tan", 3), move(6, "Ada Tan", 61), move(7, "Ada Tan", 0, firm=2), move(8, "Ada Mei Tan", 2, origin="x", office="SG")]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {(r.move_id_a, r.move_id_b): r.decision for r in dedupe.score_pairs(dedupe.candidate_pairs(dedupe.candidates(frame))).collect()}
    assert got[1, 2] == "merge" and got[1, 3] == "distinct" and got[1, 4] == "ambiguous" and got[1, 5] == "ambiguous"
    assert (1, 6) not in got and (1, 7) not in got and (2, 6) in got
    parts = {r.move_id: r.component for r in dedupe.block_components(spark.createDataFrame([(1, 2), (2, 5), (7, 8)], "move_id_a long, move_id_b long")).collect()}
    assert parts == {1: 1, 2: 1, 5: 1, 7: 7, 8: 7}
    chain = [(i, i + 1) for i in range(0, 3000)] + [(5, 5)]
    assert dedupe.block_components(spark.createDataFrame(chain, "move_id_a long, move_id_b long")).filter("component <> 0").count() == 0
    assert dedupe.block_components(spark.createDataFrame([], "move_id_a long, move_id_b long")).count() == 0


def test_merge_keeps_what_loses(spark):
    rows = [move(1, "A", 3, origin="x", title="Partner", source="low"), move(2, "A", 1, origin="y", source="high"), move(3, "A", 2, title="Head", source=None)]
    frame, parts = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "move_id long, component long")
    got = dedupe.merged_records(frame, parts, spark.createDataFrame([("low", 3), ("high", 1)], "slug string, tier int"), ["from_firm", "title_to"]).first()
    assert (got.winner, got.from_firm, got.title_to, got.members, got.pending) == (2, "y", "Partner", 3, True)
    assert got.conflicts == {"from_firm": ["x"], "title_to": ["Head"]} and got.announced_date == dt.date(2025, 1, 2)


def test_group_moves_are_anchored_at_their_first_day(spark):
    days = [(0, "p"), (40, "q"), (61, "r"), (100, "s"), (300, "t")]
    frame = spark.createDataFrame([("T", "F", dt.date(2025, 1, 1) + dt.timedelta(days=d), p, "SG") for d, p in days] + [("T", "T", dt.date(2025, 1, 1), "z", "SG")], "to_firm string, from_firm string, announced_date date, person string, office string")
    got = sorted((r.first_day, r.people, r.office) for r in dedupe.group_moves(frame).collect())
    assert got == [(dt.date(2025, 1, 1), 2, "SG"), (dt.date(2025, 3, 3), 2, "SG")]


def test_long_surfaces_match(spark):
    long = "one two three four five six seven eight nine ten eleven"
    index = spark.createDataFrame([(long, 1), ("two three", 2)], "surface string, code int")
    texts = spark.createDataFrame([(1, "At " + long.title() + " today")], "id int, t string")
    assert [(r.place, r.words, r.code) for r in gazetteer.hits(texts, index, "id", "t").collect()] == [(2, 11, 1)]
    assert gazetteer.all_hits(texts, index.limit(0), "id", "t").count() == 0
    look = gazetteer.fixed_lookup({"hong kong": "HK", "asia": None, "asia minor": "TR", "kong": "X"})
    got = {r.t: r.c for r in spark.createDataFrame([("Hong Kong Kong",), ("Asia Asia Minor",), ("Asia",), (None,)], "t string").select("t", look(F.col("t")).alias("c")).collect()}
    assert got == {"Hong Kong Kong": ["HK", "X"], "Asia Asia Minor": ["TR"], "Asia": [], None: []}


def test_role_clauses(spark):
    cases = {
        "partner": ("partner", None, None), "co-head of its white-collar defence and investigations practice": ("co-head", "white-collar defence and investigations", None), "a partner in Sydney": ("partner", None, "AU"), "Managing Partner": ("managing partner", None, None),
        "partner in charge of the firm's energy group to boost its bench": ("partner in charge", "energy", None), "head of South Asia practice": ("head", None, None), "senior equity partner in investment funds": ("senior equity partner", "investment funds", None), "advisor to the privacy practice": (None, "privacy", None), None: (None, None, None), "": (None, None, None),
    }
    rows = spark.createDataFrame([(k,) for k in cases], "k string")
    got = {r.k: (r.title, r.practice, r.place) for r in spans.parse_roles(rows, "k", F.col("k"), {"sydney": "AU"}).collect()}
    assert got == cases
    senior = {"partner": True, "of counsel": False, "General Counsel": True, "special counsel and partner": True, "senior associate": False, "associate partner": True, "director of licensing": False, "director": True, "executive director": False, "co-head": True, "KC": True, "trainee": False, "": False, None: False, "chief operating officer": False}
    assert {r.k: r.s for r in spark.createDataFrame([(k,) for k in senior], "k string").select("k", spans.is_senior(F.col("k")).alias("s")).collect()} == senior


def test_person_slots(spark):
    firms = spark.createDataFrame([("alder birchwood", 1), ("cedar", 2)], "surface string, code long")
    fits = {"Ada Example": True, "Ada": False, "Alder Birchwood": False, "Alder Birchwood Tokyo Team": False, "Cedar Law": True, "Ada Tokyo": False, "Even Dozen": False, "Most Popular": False, "Ada 2 Example": False, "Private Equity": False, "Ada B C D E": False}
    frame = spark.createDataFrame([(k,) for k in [*fits, None]], "p string")
    assert {r.p for r in slots.fitting(frame, "p", firms, {"tokyo": "JP"}, ["private", "equity"]).collect()} == {k for k, v in fits.items() if v}
    clean = {"Dr Ada Example": "Ada Example", "Share Ada Example": "Ada Example", "Tokyo Ada Example": "Ada Example", "Ada Example ada example": "Ada Example", "Share Ada": "Share Ada", "": "", "Tokyo": "Tokyo"}
    got = {r.p: r.c for r in spark.createDataFrame([(k,) for k in clean], "p string").select("p", slots.cleaned(F.col("p"), {"tokyo": "JP"}).alias("c")).collect()}
    assert got == clean


FIRMS = [("alder birchwood", 1), ("cedar law", 2), ("elm", 3), ("elm fir", 4), ("the very long name of a firm that has many words", 5)]


def extracted(spark, rows, entity=False):
    items = spark.createDataFrame([(i, h, b, u, 2, "full_public", entity) for i, (h, b, u) in enumerate(rows)], "item_id long, headline string, body string, url string, tier int, access_level string, entity_slug boolean")
    firms = spark.createDataFrame(FIRMS, "surface string, code long")
    found = extraction.extract_moves(items, firms, {"tokyo": "JP", "hong kong": "HK"}, ["disputes", "private", "equity"]).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r.item_id, r.slot)):
        out.setdefault(r.item_id, []).append((r.person, r.to_firm, r.from_firm, r.title, r.practice, r.place, r.move_type))
    return out


def test_headline_moves(spark):
    cases = [
        ("Alder & Birchwood hires Ada Example from Cedar Law", [("Ada Example", 1, 2, None, None, None, "lateral")]),
        ("ada example and bo sample join cedar law as partners", [("ada example", 2, None, "partners", None, None, "lateral"), ("bo sample", 2, None, "partners", None, None, "lateral")]),
        ("Cedar Law promotes Ada Example to partner", [("Ada Example", 2, 2, "partner", None, None, "promotion")]),
        ("Ada Example steps up as Cedar Law's new managing partner", [("Ada Example", 2, 2, "managing partner", None, None, "promotion")]),
        ("Cedar Law hires disputes partner Ada Example in Tokyo", []),
        ("Cedar Law hires disputes partner Ada Example", [("Ada Example", 2, None, None, None, None, "lateral")]),
        ("Cedar Law appoints Dr Ada Example as co-head of its energy practice in Hong Kong", [("Ada Example", 2, None, "co-head", "energy", "HK", "lateral")]),
        ("Cedar Law names Ada Example senior partner", [("Ada Example", 2, None, "senior partner", None, None, "lateral")]),
        ("Cedar Law names Ada Example senior associate", []), ("Cedar Law appoints Ada Example as advisor to the board", []),
        ("Ada Example, a veteran of the bar, jumps to Elm Fir", [("Ada Example", 4, None, None, None, None, "lateral")]),
        ("Ada Example rejoins Elm from Nowhere LLP", []), ("Unknown Firm hires Ada Example from Cedar Law", []),
        ("Cedar Law hires New Partner from Alder & Birchwood", []), ("Cedar Law opens with new partners Ada Example and Bo Sample", [("Ada Example", 2, None, None, None, None, "lateral"), ("Bo Sample", 2, None, None, None, None, "lateral")]),
        ("Ada Example joins The Very Long Name of a Firm That Has Many Words", [("Ada Example", 5, None, None, None, None, "lateral")]), ("", []), (None, []),
    ]
    got = extracted(spark, [(h, None, None) for h, _ in cases])
    assert {cases[i][0]: got.get(i, []) for i in range(len(cases))} == dict(cases)


def test_body_moves(spark):
    body = "The team grows. Ada Example arrives from Alder & Birchwood, where Example spent 3 years. She leads the disputes practice."
    cases = [
        ("Cedar Law grows", body, [("Ada Example", 2, 1, None, None, None, "lateral")]),
        ("Cedar Law grows", "Former Elm Fir's partner Bo Sample starts today. Sample heads the tax team.", [("Bo Sample", 2, 4, None, "tax", None, "lateral")]),
        ("Cedar Law grows", "It has appointed Bo Sample as partner in its Tokyo office.", [("Bo Sample", 2, None, "partner", None, None, "lateral")]),
        ("Cedar Law grows", "It has appointed Bo Sample as senior associate.", []), ("Cedar Law grows", "The arrival of Bo Sample as special counsel was welcomed.", []),
        ("Cedar Law grows", "This follows the arrival of Bo Sample.", []), ("Cedar Law grows", "Ada Example, Bo Sample and Cy Third have become the firm's newest partners.", [("Ada Example", 2, None, "partner", None, None, "lateral"), ("Bo Sample", 2, None, "partner", None, None, "lateral"), ("Cy Third", 2, None, "partner", None, None, "lateral")]),
        ("Cedar Law grows", "The group is led by Bo Sample from Cedar Law.", [("Bo Sample", 2, 2, None, None, None, "promotion")]), ("Blow for Cedar Law as two exit", body, []), ("Nobody grows", body, []), ("Cedar Law grows", None, []),
        ("Cedar Law takes Elm team in Hong Kong", "Bo Sample will join the firm.", [("Bo Sample", 2, 3, None, None, "HK", "lateral")]),
    ]
    got = extracted(spark, [(h, b, None) for h, b, _ in cases])
    assert [got.get(i, []) for i in range(len(cases))] == [m for *_, m in cases]


def test_headline_moves_are_completed_from_the_body(spark):
    got = extracted(spark, [("Cedar Law hires Ada Example", "Example joins from Elm, where she heads its tax team. Bo Sample joins from Alder Birchwood.", None), ("Cedar Law hires Ada Example from Elm", "Ada Example joins from Alder Birchwood.", None)])
    assert got == {0: [("Ada Example", 2, 3, None, "tax", None, "lateral")], 1: [("Ada Example", 2, 3, None, None, None, "lateral")]}


def test_a_slug_that_names_someone_else(spark):
    body = "Cedar Law said Bo Sample will join the firm. Ada Example joined the firm as partner."
    url = "https://x.example/news/cedar-law-ada-example-tokyo"
    assert [m[0] for m in extracted(spark, [("Cedar Law grows", body, url)], entity=True)[0]] == ["Ada Example"]
    assert len(extracted(spark, [("Cedar Law grows", body, url)])[0]) == 2
    assert len(extracted(spark, [("Cedar Law grows", body, "https://x.example/news/cedar-law-hires-in-tokyo")], entity=True)[0]) == 2


def test_direction_of_firms(spark):
    cases = {
        "Alder Birchwood recruits 6 Cedar Law partners": (1, 2), "Cedar Law's chair jumps to Elm Fir": (4, 2), "Alder Birchwood adds trio from rival Cedar Law": (1, 2), "Former Elm practice head rejoins Cedar Law": (2, 3),
        "Blow for Cedar Law as two partners exit": (None, 2), "Nobody moves": None, "Cedar Law hires": (2, None),
    }
    texts = spark.createDataFrame([(k,) for k in cases], "h string")
    got = {r.h: (r.destination, r.origin) for r in extraction.firm_direction(texts, spark.createDataFrame(FIRMS, "surface string, code long"), "h", "h").collect()}
    assert got == {k: v for k, v in cases.items() if v}


def test_spans_recover_over_white_space_and_signs(spark):
    rows = [("Bo (x) Y+", 0, 2, "see Bo\n(x)  Y+ there"), ("a\\Eb", 0, 1, "z a\\Eb"), ("SG", 0, 3, "x")]
    got = [(r.q.quality, r.q.span_start, r.q.span_end) for r in spark.createDataFrame(rows, "v string, a int, b int, t string").select(spans.verify(F.col("v"), F.col("a"), F.col("b"), F.col("t")).alias("q")).collect()]
    assert got == [("recovered", 4, 14), ("recovered", 2, 6), ("dropped", 0, 0)]


def test_evaluation(spark):
    schema = "k int, f string"
    p, e = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (4, "x")], schema), spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], schema)
    row = extraction.evaluate(p, e, ["k"], ["f"]).first()
    assert (row.tp, row.fp, row.fn, row.precision, row.recall, row.f1, row.agree_f) == (2, 1, 1, 0.6667, 0.6667, 0.6667, 0.5)
    assert extraction.evaluate(p.limit(0), e.limit(0), ["k"], ["f"]).first().precision is None


def test_integrity_and_upkeep(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, x int")
    assert [(r.rule, r.id) for r in integrity.violations(rows, "id", {"small": F.col("x") < 10}).collect()] == [("small", "3")]
    current, batch = spark.createDataFrame([("a", 1)], "url string, n int"), spark.createDataFrame([("a", 2), ("b", 4), ("b", 3), (None, 1)], "url string, n int")
    new = upkeep.insert_absent(current, batch, "url", ["n"])
    assert [(r.url, r.n) for r in new.collect()] == [("b", 3)]
    assert upkeep.insert_absent(current.unionByName(new), batch, "url", ["n"]).count() == 0
    both = upkeep.upsert(spark.createDataFrame([("a", 1, None), ("c", 3, "y")], "k string, r int, s string"), spark.createDataFrame([("a", 9, "x"), ("b", 2, "z")], "k string, r int, s string"), "k", ["r"], ["s"])
    assert sorted(map(tuple, both.collect())) == [("a", 9, "x"), ("b", 2, "z"), ("c", 3, "y")]
    after, log = upkeep.erase({"t": rows}, rows.filter("id = 1"), "id", {"t": "id"})
    assert after["t"].count() == 2 and log.first().erased == 1


def test_erasure_leaves_hashes_and_counts(spark):
    people = spark.createDataFrame([(1, "Ada Example", ["Example Ada", " "]), (2, "Bo Sample", None)], "person_id long, canonical_name string, name_variants array<string>")
    moves = spark.createDataFrame([(10, 1, None, None, "open"), (11, 2, 10, dt.date(2025, 1, 1), "merged"), (12, 2, None, None, "open")], "move_id long, person_id long, superseded_by long, merged_at date, review_state string")
    evidence, links = spark.createDataFrame([(10,), (10,), (11,)], "move_id long"), spark.createDataFrame([(10,), (12,)], "move_id long")
    none = spark.createDataFrame([], "name_hash string, reason string, actor string")
    state = upkeep.erase_person(people.filter("person_id = 1"), people, moves, evidence, links, none, "s", "asked", "desk")
    assert [r.person_id for r in state["people"].collect()] == [2]
    assert sorted((r.move_id, r.superseded_by, r.merged_at, r.review_state) for r in state["moves"].collect()) == [(11, None, None, "rejected"), (12, None, None, "open")]
    log = state["log"].first()
    assert (log.moves_deleted, log.evidence_deleted, log.sources_unlinked) == (1, 2, 1) and state["tombstones"].count() == 2
    again = spark.createDataFrame([("Dr Ada Example",), ("Bo Sample",)], "n string").select(names.name_hash(F.col("n"), "s").alias("name_hash"))
    assert again.join(state["tombstones"], "name_hash", "left_semi").count() == 1
    assert upkeep.erase_person(people.limit(0), people, moves, evidence, links, none, "s", "x", "y")["log"].first().moves_deleted == 0


def test_taxonomy_versions_do_not_change(spark):
    none, nodes = spark.createDataFrame([], "version string, checksum string, is_current boolean"), spark.createDataFrame([("a", "A"), ("b", "B")], "code string, name string")
    one = upkeep.load_taxonomy(none, nodes, "1.0")
    assert upkeep.load_taxonomy(one, nodes.orderBy("name"), "1.0").count() == 1
    two = upkeep.load_taxonomy(one, nodes.limit(1), "1.1")
    assert {r.version: r.is_current for r in two.collect()} == {"1.0": False, "1.1": True}
    with pytest.raises(ValueError):
        upkeep.load_taxonomy(two, nodes.limit(1), "1.0")


def test_the_ledger_always_closes_a_run(spark, tmp_path):
    ledger = upkeep.RunLedger(spark, str(tmp_path / "runs"))
    with ledger.run("ingest", 7) as counts:
        counts["items_fetched"] = 3
    with pytest.raises(KeyError), ledger.run("extract"):
        raise KeyError
    last = {r.stage: (r.status, r.items_fetched, r.errors) for r in spark.read.parquet(str(tmp_path / "runs")).filter("status <> 'running'").collect()}
    assert last == {"ingest": ("succeeded", 3, 0), "extract": ("failed", 0, 1)}


def test_integrity_of_states(spark):
    moves = spark.createDataFrame([(1, "classified", "v1", False, False), (2, "classified", "v1", False, False), (3, "pending", "v1", True, False)], "move_id long, state string, version string, superseded boolean, rejected boolean")
    given = spark.createDataFrame([(1, True, "v1"), (1, True, "v1"), (1, False, "v2"), (1, False, "v1"), (1, False, "v1")], "move_id long, is_primary boolean, version string")
    rules = lambda frame: sorted((r.rule, r.id) for r in frame.collect())
    assert rules(integrity.classification(moves, given)) == [("exactly_one_primary", "1"), ("exactly_one_primary", "2"), ("few_secondary", "1"), ("one_version", "1")]
    teams, links = spark.createDataFrame([(5, 1), (6, 2)], "team_id long, partner_count long"), spark.createDataFrame([(1, True), (1, True)], "move_id long, is_primary boolean")
    assert rules(integrity.monitored(moves, given, links, teams)) == [("canonical_without_source", "2"), ("classified_without_primary", "2"), ("several_primary_sources", "1"), ("team_of_fewer_than_two", "5")]
    queue = spark.createDataFrame([("a", 1, "dedupe_ambiguous", None, None, None, "me"), ("b", 1, "x", 1, None, None, None)], "id string, move_id long, reason string, related_move_id long, resolved_at date, resolution string, resolver string")
    assert rules(integrity.queue_items(queue)) == [("not_self_paired", "b"), ("pair_has_counterpart", "a"), ("resolution_is_complete", "a")]
    kinds = spark.createDataFrame([(1, "in_house_exit", 1, None), (2, "in_house_exit", 2, None), (3, "in_house_entry", 2, 9), (4, "in_house_exit", None, None)], "move_id long, move_type string, to_firm_id long, from_firm_id long")
    firms = spark.createDataFrame([(1, "in_house"), (2, "global")], "firm_id long, firm_type string")
    assert rules(integrity.firm_kinds(kinds, firms)) == [("entry_comes_from_in_house", "3"), ("exit_leads_in_house", "2"), ("exit_leads_in_house", "4")]
