"""Integrity rules as queries for violations: a rule is a name and a condition that a good row meets.

A row violates a rule if the condition is false; a null condition is no violation, as in a check constraint. All rules
of a table are evaluated in one scan and come out as (rule, id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(table: DataFrame, ident: str, rules: dict[str, Column]) -> DataFrame:
    """(rule, id) of every rule that a row of ``table`` breaks."""
    broken = F.filter(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]), lambda r: r.isNotNull())
    return table.select(F.col(ident).cast("string").alias("id"), F.explode(broken).alias("rule")).select("rule", "id")


def duplicates(table: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """(rule, id) of every key that more than one row has."""
    return table.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(F.lit(rule).alias("rule"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("id"))


def dangling(table: DataFrame, ident: str, key: str, target: DataFrame, target_key: str, rule: str) -> DataFrame:
    """(rule, id) of the rows whose stated key the target lacks."""
    known = target.select(F.col(target_key).alias("_k")).distinct()
    return table.filter(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_k"), "left_anti").select(F.lit(rule).alias("rule"), F.col(ident).cast("string").alias("id"))


def only_one(table: DataFrame, keys: list[str], flag: Column, rule: str) -> DataFrame:
    """(rule, id) of every key for which not exactly one row has ``flag``."""
    return table.groupBy(*keys).agg(F.count_if(flag).alias("n")).filter("n <> 1").select(F.lit(rule).alias("rule"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("id"))


def classification(moves: DataFrame, assignments: DataFrame, most_secondary: int = 2) -> DataFrame:
    """(rule, id) of classified moves whose practice groups are not one primary, a few secondary, all of the move's version.

    ``moves`` is (move_id, state, version), ``assignments`` (move_id, is_primary, version). Other states may be partial.
    """
    count = assignments.join(moves.filter("state = 'classified'").select("move_id", F.col("version").alias("_v")), "move_id").groupBy("move_id").agg(
        F.count_if("is_primary").alias("primary"), F.count_if(~F.col("is_primary")).alias("secondary"), F.count_if(~F.col("version").eqNullSafe(F.col("_v"))).alias("strange")
    )
    rows = moves.filter("state = 'classified'").select("move_id").join(count, "move_id", "left").na.fill(0, ["primary", "secondary", "strange"])
    return violations(rows, "move_id", {"exactly_one_primary": F.col("primary") == 1, "few_secondary": F.col("secondary") <= most_secondary, "one_version": F.col("strange") == 0})


def firm_kinds(moves: DataFrame, firms: DataFrame, in_house: str = "in_house") -> DataFrame:
    """(rule, id) of in-house exits that lead to, and entries that come from, a firm of another kind or an unknown one.

    ``moves`` is (move_id, move_type, to_firm_id, from_firm_id), ``firms`` (firm_id, firm_type).
    """
    kind = lambda side: firms.select(F.col("firm_id").alias(f"{side}_firm_id"), F.col("firm_type").alias(f"{side}_kind"))
    rows = moves.filter("move_type in ('in_house_exit', 'in_house_entry')").join(kind("to"), "to_firm_id", "left").join(kind("from"), "from_firm_id", "left")
    exits = (F.col("move_type") != "in_house_exit") | F.col("to_kind").eqNullSafe(in_house)
    entries = (F.col("move_type") != "in_house_entry") | F.col("from_firm_id").isNull() | F.col("from_kind").eqNullSafe(in_house)
    return violations(rows, "move_id", {"exit_leads_in_house": exits, "entry_comes_from_in_house": entries})


def team_membership(moves: DataFrame, teams: DataFrame) -> DataFrame:
    """(rule, id) of moves that don't fit the firms or window of their team, and of teams whose count is not their members'.

    ``moves`` is (move_id, team_id, to_firm, from_firm, announced_date, superseded), ``teams`` (team_id, to_firm, from_firm,
    window_start, window_end, partner_count). A team without an origin takes any.
    """
    theirs = teams.select("team_id", F.col("to_firm").alias("t_to"), F.col("from_firm").alias("t_from"), "window_start", "window_end")
    rows = moves.join(theirs, "team_id")
    fits = violations(rows, "move_id", {
        "same_destination": F.col("to_firm").eqNullSafe(F.col("t_to")), "same_origin": F.col("t_from").isNull() | F.col("from_firm").eqNullSafe(F.col("t_from")), "inside_window": F.col("announced_date").between(F.col("window_start"), F.col("window_end")),
    })
    members = moves.filter("not superseded").groupBy("team_id").agg(F.count("*").alias("members"))
    counted = teams.join(members, "team_id", "left").select("team_id", "partner_count", F.coalesce("members", F.lit(0)).alias("members"))
    return fits.unionByName(violations(counted, "team_id", {"count_is_kept": F.col("partner_count") == F.col("members")}))


def queue_items(queue: DataFrame) -> DataFrame:
    """(rule, id) of review items (id, move_id, reason, related_move_id, resolved_at, resolution, resolver) that are not sound.

    A resolution is all there or not at all, an ambiguous pair has a counterpart, and none is its own.
    """
    absent = sum((F.col(c).isNull().cast("int") for c in ("resolved_at", "resolution", "resolver")), F.lit(0))
    return violations(queue, "id", {
        "resolution_is_complete": absent.isin(0, 3), "pair_has_counterpart": (F.col("reason") != "dedupe_ambiguous") | F.col("related_move_id").isNotNull(), "not_self_paired": ~F.col("related_move_id").eqNullSafe(F.col("move_id")),
    })


def monitored(moves: DataFrame, assignments: DataFrame, links: DataFrame, teams: DataFrame) -> DataFrame:
    """(rule, id) of the four things that must never be: a classified move without a primary practice, a move with several
    primary sources, a canonical move (neither superseded nor rejected) without any source, a team of fewer than two.

    ``links`` is (move_id, is_primary), ``moves`` (move_id, state, superseded, rejected), ``teams`` (team_id, partner_count).
    """
    out = lambda rows, ident, rule: rows.select(F.lit(rule).alias("rule"), F.col(ident).cast("string").alias("id"))
    bare = moves.filter("state = 'classified'").join(assignments.filter("is_primary"), "move_id", "left_anti")
    several = links.groupBy("move_id").agg(F.count_if("is_primary").alias("n")).filter("n > 1")
    lone = moves.filter("not superseded and not rejected").join(links, "move_id", "left_anti")
    small = teams.filter("partner_count < 2")
    return out(bare, "move_id", "classified_without_primary").unionByName(out(several, "move_id", "several_primary_sources")).unionByName(out(lone, "move_id", "canonical_without_source")).unionByName(out(small, "team_id", "team_of_fewer_than_two"))
