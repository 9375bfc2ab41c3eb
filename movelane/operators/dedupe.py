"""Duplicate events: blocked candidate pairs, scores, merge components, merged records, group moves.

Pairs are an equi-join on the block and on a window of dates, so a block that holds a third of all rows is still cut
into windows; scores are column arithmetic in integers (ten-thousandths).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from movelane.functions.names import bracketed_alias, with_name_keys
from movelane.session import cut_lineage, release

# The published weights, in ten-thousandths, and the window in days.
MERGE, AMBIGUOUS, BASE = 8500, 6000, 8500
ORIGIN, OFFICE, TITLE, NEAR = (1000, -1500), (500, -1000), (500, 0), 500
WINDOW_DAYS = 60
GIVEN = {"shared": 10000, "unknown": 5000, "equal": 10000, "first": 9000, "initial": 7500, "disagree": 0}


def candidates(moves: DataFrame) -> DataFrame:
    """The moves that can be compared, with a name, destination and date: what scoring needs of them, and their name keys."""
    rows = moves.filter("to_firm_id is not null and announced_date is not null and person_name is not null")
    keyed = with_name_keys(rows, "person_name").filter("surname_key <> ''")
    alias = F.lower(F.regexp_replace(bracketed_alias(F.col("person_name")), r"[\s-]+", ""))
    keys = F.filter(F.array("given_key", alias), lambda k: k.isNotNull())
    first = F.get("given_tokens", F.lit(0))
    return keyed.select("move_id", "to_firm_id", "announced_date", F.lower("from_firm").alias("from_firm"), F.lower("office").alias("office"), F.lower("title_to").alias("title_to"), "surname_key", "given_key", first.alias("first"), keys.alias("keys"))


def candidate_pairs(keyed: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Pairs (columns of both sides suffixed _a and _b, days_apart) of one surname and destination within the window.

    The smaller move_id is the left side. Each date meets its own window and the next, which covers every pair once.
    """
    slot = F.floor(F.datediff("announced_date", F.lit("1970-01-01").cast("date")) / (days + 1))
    sides = keyed.withColumn("slot", slot)
    right = sides.select(*[F.col(c).alias(f"{c}_b") for c in keyed.columns], F.explode(F.array(F.col("slot") - 1, F.col("slot"), F.col("slot") + 1)).alias("slot_b"))
    left = sides.select(*[F.col(c).alias(f"{c}_a") for c in keyed.columns], F.col("slot").alias("slot_a"))
    apart = F.abs(F.datediff("announced_date_a", "announced_date_b"))
    on = (F.col("surname_key_a") == F.col("surname_key_b")) & (F.col("to_firm_id_a") == F.col("to_firm_id_b")) & (F.col("slot_a") == F.col("slot_b"))
    return left.join(right, on).filter("move_id_a < move_id_b").withColumn("days_apart", apart).filter(F.col("days_apart") <= days).drop("slot_a", "slot_b")


def score_pairs(pairs: DataFrame) -> DataFrame:
    """(move_id_a, move_id_b, to_firm_id, days_apart, given_label, total, decision).

    Given names that disagree end a pair; a missing one is for a person to judge. A field that one side leaves out is
    no conflict. Totals are cut to 0..1.
    """
    first_a, first_b = F.col("first_a"), F.col("first_b")
    initial = ((F.length(first_a) == 1) & first_b.startswith(first_a)) | ((F.length(first_b) == 1) & first_a.startswith(first_b))
    label = (
        F.when(F.arrays_overlap("keys_a", "keys_b"), "shared").when(F.col("given_key_a").isNull() | F.col("given_key_b").isNull(), "unknown")
        .when(first_a == first_b, "first").when(initial, "initial").otherwise("disagree")
    )
    rows = pairs.withColumn("given_label", label)
    points = F.element_at(F.create_map(*[F.lit(x) for kv in GIVEN.items() for x in kv]), F.col("given_label"))
    agree = lambda c, w: F.when(F.col(f"{c}_a").isNull() | F.col(f"{c}_b").isNull(), 0).when(F.col(f"{c}_a") == F.col(f"{c}_b"), w[0]).otherwise(w[1])
    near = F.round(F.lit(NEAR) * (1 - F.col("days_apart") / WINDOW_DAYS)).cast("int")
    raw = F.round(points * BASE / 10000).cast("int") + agree("from_firm", ORIGIN) + agree("office", OFFICE) + agree("title_to", TITLE) + F.greatest(F.lit(0), near)
    total = F.when(F.col("given_label") == "disagree", 0).when(F.col("given_label") == "unknown", BASE // 2).otherwise(F.greatest(F.lit(0), F.least(F.lit(10000), raw)))
    rows = rows.withColumn("points", total)
    decision = F.when(F.col("given_label") == "disagree", "distinct").when(F.col("given_label") == "unknown", "ambiguous").when(F.col("points") >= MERGE, "merge").when(F.col("points") >= AMBIGUOUS, "ambiguous").otherwise("distinct")
    return rows.select("move_id_a", "move_id_b", F.col("to_firm_id_a").alias("to_firm_id"), "days_apart", "given_label", (F.col("points").cast("decimal(9,4)") / 10000).cast("decimal(5,4)").alias("total"), decision.alias("decision"))


def _roots(parents: DataFrame) -> DataFrame:
    """(x, p) with every pointer moved on to the end of its chain: the length of chains halves at each turn."""
    while True:
        ahead = parents.select(F.col("x").alias("p"), F.col("p").alias("q"))
        jumped = cut_lineage(parents.join(ahead, "p").select("x", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")))
        release(parents)
        parents = jumped.select("x", "p")
        if jumped.filter("moved").isEmpty():
            return parents


def block_components(edges: DataFrame) -> DataFrame:
    """(move_id, component) of the merge edges (move_id_a, move_id_b): the smallest id reached.

    Each node points to its smallest neighbour or itself, pointers are moved to their roots, and edges are contracted to
    the roots; every round leaves fewer nodes, and it ends when no edge is left. An empty table has no components.
    """
    pairs = edges.filter("move_id_a <> move_id_b").select(F.col("move_id_a").alias("x"), F.col("move_id_b").alias("y"))
    pairs = cut_lineage(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    found = None
    while not pairs.isEmpty():
        roots = _roots(cut_lineage(pairs.groupBy("x").agg(F.least("x", F.min("y")).alias("p"))))
        if found is None:
            found = roots
        else:
            found = cut_lineage(found.join(roots.select(F.col("x").alias("p"), F.col("p").alias("q")), "p", "left").select("x", F.coalesce("q", "p").alias("p")))
        left = pairs.join(roots.select("x", F.col("p").alias("px")), "x").join(roots.select(F.col("x").alias("y"), F.col("p").alias("py")), "y")
        smaller = cut_lineage(left.filter("px <> py").select(F.col("px").alias("x"), F.col("py").alias("y")).distinct())
        release(pairs)
        pairs = smaller
    found = pairs.select("x", F.col("y").alias("p")) if found is None else found
    return found.select(F.col("x").alias("move_id"), F.col("p").alias("component"))


def merged_records(moves: DataFrame, components: DataFrame, tiers: DataFrame, fields: list[str]) -> DataFrame:
    """One record per component: the most trusted stated value of each field, the earliest date, and what lost.

    Authority is the lowest tier (none last), then the highest confidence, then the smallest id. ``conflicts`` maps each
    field to the other stated values, sorted; ``pending`` tells that a field conflicts.
    """
    rows = moves.join(components, "move_id").join(tiers.select(F.col("slug").alias("source_slug"), "tier"), "source_slug", "left")
    rank = F.struct(F.coalesce("tier", F.lit(99)), -F.coalesce("confidence", F.lit(-1.0)), F.col("move_id"))
    best = [F.min_by(F.when(F.col(f).isNotNull(), F.col(f)), F.when(F.col(f).isNotNull(), rank)).alias(f) for f in fields]
    seen = [F.array_sort(F.collect_set(f)).alias(f"_{f}") for f in fields]
    out = rows.groupBy("component").agg(F.min_by("move_id", rank).alias("winner"), F.count("*").alias("members"), F.min("announced_date").alias("announced_date"), F.count_distinct("source_slug").alias("sources"), *best, *seen)
    conflicts = [F.array_remove(F.col(f"_{f}"), F.col(f)) for f in fields]
    pending = F.greatest(*[F.size(F.col(f"_{f}")) for f in fields]) > 1
    return out.select("component", "winner", "members", "announced_date", "sources", *fields, F.map_from_arrays(F.array(*[F.lit(f) for f in fields]), F.array(*conflicts)).alias("conflicts"), pending.alias("pending"))


def group_moves(moves: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """(to_firm, from_firm, first_day, last_day, people, office): several people between one pair of firms in a window.

    A window is anchored at its first day and spans ``days``. Days are aggregated first, so the fold that sets the
    anchors runs over the distinct days of a pair of firms, not over its moves. Office only if all agree.
    """
    rows = moves.filter("to_firm is not null and from_firm is not null and to_firm <> from_firm and announced_date is not null and person is not null")
    by_day = rows.select("to_firm", "from_firm", "announced_date").distinct().groupBy("to_firm", "from_firm").agg(F.array_sort(F.collect_set("announced_date")).alias("days"))
    step = lambda acc, d: F.when(F.size(acc) == 0, F.array(d)).when(F.datediff(d, F.element_at(acc, -1)) > days, F.array_append(acc, d)).otherwise(acc)
    anchors = by_day.select("to_firm", "from_firm", F.explode(F.aggregate("days", F.array().cast("array<date>"), step)).alias("first_day"))
    next_day = F.lead("first_day").over(Window.partitionBy("to_firm", "from_firm").orderBy("first_day"))
    spans = anchors.withColumn("next_day", next_day)
    inside = rows.join(spans, ["to_firm", "from_firm"]).filter("announced_date >= first_day and (next_day is null or announced_date < next_day)")
    groups = inside.groupBy("to_firm", "from_firm", "first_day").agg(F.max("announced_date").alias("last_day"), F.count_distinct("person").alias("people"), F.min("office").alias("lo"), F.max("office").alias("hi"), F.count("*").alias("n"), F.count("office").alias("k"))
    return groups.filter("people >= 2").select("to_firm", "from_firm", "first_day", "last_day", "people", F.when((F.col("lo") == F.col("hi")) & (F.col("n") == F.col("k")), F.col("lo")).alias("office"))
