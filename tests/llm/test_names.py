from movelane.llm import names

FIRMS = "firm_id long, canonical_name string, firm_type string, hq_jurisdiction string, aliases array<string>"
MOVES = "move_id long, person_name string, to_firm_id long"


def firm_pairs(spark, rows):
    return {(r.left_id, r.right_id) for r in names.linked_firms(spark.createDataFrame(rows, FIRMS)).collect()}


def test_one_edit_means_one_edit():
    same = [("samantha", "samatha"), ("leonard", "leoanrd"), ("abc", "abc"), ("piya", "priya"), ("voblutic", "vobutic"), ("rotvela", "rorvela")]
    assert all(names._one_edit(a, b) and names._one_edit(b, a) for a, b in same)
    assert not any(names._one_edit(a, b) for a, b in [("abcd", "badc"), ("kai", "kailo"), ("edward", "wanda"), ("abc", "cba")])


def test_firms_link_across_spellings(spark):
    rows = [
        (1, "Alder & Birchwood LLP", "global", "SG", ["AB"]), (2, "  alder & birchwood llp ", "other", None, []), (3, "Birchwood & Alder Law Firm", "global", "SG", None), (4, "Alder+Birchwod LLP", "global", None, []),
        (5, "Alder B LLP", "global", "SG", []), (6, "Cedarholm, Dogwood & Elmstead", "local", "HK", ["CDE", "Cedarholms"]), (7, "CDE Legal", "local", "HK", ["Cedarholm, Dogwood & Elmstead Tokyo"]), (8, "Chambers of Cédarholm, Dogwood & Elmstead", "local", "HK", []),
        (9, "Alder & Brookside LLP", "local", "GB", ["AB", "Alders"]), (10, "Alder Chambers", "local", "GB", ["Alders"]), (11, "Alder & Birchwood LLP", "boutique", "NZ", []), (12, None, None, None, None), (13, "Law", "local", None, ["", None]), (14, "", "local", None, []),
    ]
    got = firm_pairs(spark, rows)
    assert got == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4), (1, 5), (2, 5), (3, 5), (4, 5), (6, 7), (6, 8), (7, 8)} or got - {(2, 11), (4, 11)} == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4), (1, 5), (2, 5), (3, 5), (4, 5), (6, 7), (6, 8), (7, 8)}
    assert firm_pairs(spark, []) == set()


def crowd():
    """Given names that many firms share, as a corpus has them."""
    rows, given = [], ["Samantha", "Edward", "Kai Hui", "Kai Ming", "Wei Jun", "Farid", "Sunniva", "Wanda"]
    for i in range(160):
        rows.append((1000 + i, f"{given[i % 8]} Q{chr(97 + i % 26)}rth{chr(97 + i // 26)}wick", 500 + i // 8))
    return rows


def person_pairs(spark, rows):
    frame = spark.createDataFrame(crowd() + rows, MOVES).selectExpr("*", "1 as firm", "'x' as name", "2 as form", "3 as word", "4 as key", "5 as a")
    return {(r.left_id, r.right_id) for r in names.linked_moves(frame).collect() if r.left_id < 1000}


def test_persons_link_across_spellings(spark):
    same = ["Samantha Körkugrek", "Samatha Körkugrek", "samantha korkugrek", "KÖRKUGREK Samantha", "Körkugrek, Samantha", "Körkugrek Samantha", "S. Körkugrek", "Sam Körkugrek", "Ms Samantha Körkugrek, LLM", "Samantha Ida Körkugrek", "Samantha  Körkugrek ", "Samantha Körkurgek"]
    got = person_pairs(spark, [(i, n, 1) for i, n in enumerate(same)] + [(50, "Samantha Körkugrek", 1)])
    assert got == {(i, j) for i in range(12) for j in range(i + 1, 12)} | {(i, 50) for i in range(1, 12)}


def test_strangers_stay_apart(spark):
    rows = [(1, "Edward Mubulish", 1), (2, "Wanda Mubulish", 1), (3, "Edward Mubulish", 2), (4, "Kai Hui Zickaken", 1), (5, "Kai Ming Zickaken", 1), (6, None, 1), (7, "Edward Mubulish", None), (8, "", 1), (9, "Edward Lomyrorn", 1)]
    assert person_pairs(spark, rows) == set()


def test_initials_need_to_be_unambiguous(spark):
    assert person_pairs(spark, [(1, "Samantha Vunylen", 1), (2, "Sunniva Vunylen", 1), (3, "S. Vunylen", 1)]) == set()
    assert person_pairs(spark, [(1, "Wei Jun Torbetash", 1), (2, "W. J. Torbetash", 1), (3, "Wei-Jun Torbetash", 1), (4, "Weijun Torbetash", 1)]) == {(i, j) for i in range(1, 5) for j in range(i + 1, 5)}


def test_chosen_name_in_brackets(spark):
    assert person_pairs(spark, [(1, "Wei Jun (Kevin) Torbetash", 1), (2, "Kevin Torbetash", 1), (3, "Wei Jun Torbetash", 1)]) == {(1, 2), (1, 3), (2, 3)}


def test_empty(spark):
    empty = spark.createDataFrame([], MOVES)
    assert names.linked_moves(empty).count() == 0
    assert names.links(spark.createDataFrame([], FIRMS), empty).columns == ["kind", "left_id", "right_id"]


def test_names_in_another_order_and_middle_names_are_the_loosest_match():
    match = lambda a, b, **k: names.given_match(a, b, [False] * len(a), [False] * len(b), k.get("half", False), k.get("half", False))[0]
    assert match(["michael"], ["j", "m", "michael"]) == match(["anna", "maria"], ["maria", "anna"]) == names.LOOSE
    assert match(["michael"], ["michael", "peter"]) == names.SURE
    assert match(["j"], ["m", "j"]) == match(["jun"], ["wei", "jun"], half=True) == 0
    assert match(["john"], ["peter", "paul"]) == 0


def test_slips_of_short_surnames():
    form = lambda surname, *givens: {"surname": surname, "givens": list(givens), "known": [False] * len(givens), "alias": None, "half": False, "chosen": False}
    pairs = {("wong", "wogn"): 4, ("chan", "chann"): 4, ("lim", "lmi"): 4, ("lim", "lin"): 0, ("chan", "chen"): 0, ("le", "lee"): 0, ("ho", "hoo"): 0, ("ng", "gn"): 0}
    assert {k: names.person_match(form(k[0], "wei", "jun"), form(k[1], "wei", "jun"))[0] for k in pairs} == pairs
    assert names.person_match(form("wong", "wei"), form("wogn", "j"))[0] == 0


def test_entries_of_one_spelling_that_contradict_the_first_still_meet(spark):
    rows = [(1, "Alder & Birch LLP", "boutique", "SG", None), (2, "Alder Birch", "boutique", "HK", None), (3, "Alder and Birch", "boutique", "HK", None), (4, "Alder Birch Law", "boutique", "SG", None)]
    firms = spark.createDataFrame(rows, "firm_id long, canonical_name string, firm_type string, hq_jurisdiction string, aliases array<string>")
    assert sorted((r.left_id, r.right_id) for r in names.linked_firms(firms).collect()) == [(1, 4), (2, 3)]


def test_given_names_may_be_learned_elsewhere(spark):
    moves = spark.createDataFrame([(1, "Ada Quill", 7), (2, "Quill Ada", 7), (3, None, 7), (4, "Ada Quill", None)], "move_id long, person_name string, to_firm_id long")
    given = spark.createDataFrame([("ada", 50)], "word string, n long")
    assert [(r.left_id, r.right_id) for r in names.linked_moves(moves, given).collect()] == [(1, 2)]
    assert {(r.move_id, r.person) for r in names.person_membership(moves, given).collect()} == {(1, 1), (2, 1)}
