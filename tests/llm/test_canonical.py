from movelane.llm import canonical

REF = [("PR01", "practice", "Mergers and Acquisitions"), ("PR02", "practice", "Family Law"), ("PR03", "practice", "Public Law"), ("PR04", "practice", "Asset Finance"), ("PR05", "practice", "Project Finance"), ("TI01", "title", "Partner"), ("TI02", "title", "Equity Partner"), ("TI03", "title", "Practice Head"), ("TI04", "title", "Practice Co-Head"), ("TI05", "title", "Of Counsel"), ("TI06", "title", "Salaried Partner"), (None, "title", "X"), ("TI07", "title", None)]
TITLES = {
    "Partner": "TI01", " PARTNER ": "TI01", "Partner (Tokyo)": "TI01", "new partner": "TI01", "Equity Partner - Kuala Lumpur": "TI02", "Partner, Equity": "TI02", "Equi. Partn.": "TI02", "Equity Pratner": "TI02", "Head, Practice": "TI03", "heads the practice": "TI03",
    "Practice-Co-Head": "TI04", "coleads practice": "TI04", "OC": "TI05", "Of Coun.": "TI05", "nonn-equity partner": "TI06", "pastry chef": "unmatched", "???": "unmatched", "n/a": "unmatched", "award winner": "unmatched",
}
PRACTICES = {"M&A": "PR01", "mergers + acquisitions": "PR01", "Merg. and Acquis.": "PR01", "divorce": "PR02", "the family law team": "PR02", "Law, Family": "PR02", "publ. law": "PR03", "judicial review": "PR03", "Proj. Finan.": "PR05", "ship finance": "PR04", "Asset Fiance": "PR04", "brisk stapler": "unmatched", "x" * 5000: "unmatched"}


def run(spark, rows, ref=REF):
    roles = spark.createDataFrame(rows, "role_id long, title string, practice string").selectExpr("*", "1 as kind", "2 as value", "3 as token", "4 as term", "5 as ref_code", "6 as score")
    return sorted((r.role_id or -1, r.part, r.ref_code) for r in canonical.map_values(roles, spark.createDataFrame(ref, "ref_code string, kind string, name string")).collect())


def test_known_values(spark):
    values = [(v, c, "title") for v, c in TITLES.items()] + [(v, c, "practice") for v, c in PRACTICES.items()]
    rows = [(i, v if part == "title" else None, v if part == "practice" else None) for i, (v, _, part) in enumerate(values, 1)]
    got = {(i, part): code for i, part, code in run(spark, rows)}
    wrong = [(v[:40], got[i, part], code) for i, (v, code, part) in enumerate(values, 1) if got[i, part] != code]
    assert not wrong


def test_nulls_blanks_repeats_and_empty_tables(spark):
    rows = [(1, None, None), (2, "", "  "), (3, " ", "\t"), (4, "Partner", "divorce"), (4, "Partner", "divorce"), (None, "Partner", None)]
    assert run(spark, rows) == [(-1, "title", "TI01")] + [(4, "practice", "PR02")] * 2 + [(4, "title", "TI01")] * 2
    assert run(spark, []) == []
    assert run(spark, rows, ref=[]) == [(-1, "title", "unmatched")] + [(4, "practice", "unmatched")] * 2 + [(4, "title", "unmatched")] * 2


def test_repairs_agree_with_brute_force(spark):
    words, terms = ["partnr", "pratner", "finnace", "acquisitons", "law", "asett", "publc", "mergres"], ["partner", "finance", "acquisitions", "law", "asset", "public", "mergers", "family"]

    def edits(a, b):
        d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    got = {(r.token, r.term) for r in canonical.repairs(spark.createDataFrame([("k", w) for w in words], "kind string, token string"), spark.createDataFrame([("k", t) for t in terms], "kind string, term string")).collect()}
    want = {(w, t) for w in words for t in terms if (d := edits(w, t)) == 0 or (d == 1 and max(len(w), len(t)) >= 4 and min(len(w), len(t)) >= 3) or (d == 2 and max(len(w), len(t)) >= 9)}
    assert got == want


def test_short_words_are_repaired_beside_sound_ones_only(spark):
    ref = [*REF, ("PR06", "practice", "Corporate Tax")]
    assert run(spark, [(1, None, "Corprate Tx"), (2, None, "tx"), (3, None, "tx desk")], ref) == [(1, "practice", "PR06"), (2, "practice", "unmatched"), (3, "practice", "unmatched")]


def test_other_names_can_be_left_out(spark):
    roles = spark.createDataFrame([(1, None, "divorce"), (2, None, "family law")], "role_id long, title string, practice string")
    ref = spark.createDataFrame(REF, "ref_code string, kind string, name string")
    assert sorted((r.role_id, r.ref_code) for r in canonical.map_values(roles, ref, other_names={}).collect()) == [(1, "unmatched"), (2, "PR02")]
    assert sorted((r.role_id, r.ref_code) for r in canonical.map_values(roles, ref, other_names={"Public Law": "divorce"}).collect()) == [(1, "PR03"), (2, "PR02")]


def test_order_of_rows_plays_no_part(spark):
    rows = [(i, t, None) for i, t in enumerate(["eqity partnr", "salried partner", "partner equity salaried", "head co", "practise", "Law family public"] * 3)]
    assert run(spark, rows) == run(spark, rows[::-1], REF[::-1])
