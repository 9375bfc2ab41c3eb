"""Confidence of a record from its source, access, spans, completeness and corroboration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published weights.
TIER_BASE, OTHER_TIER = {1: 0.95, 2: 0.88, 3: 0.70}, 0.60
ACCESS, OTHER_ACCESS = {"full_public": 1.00, "summary": 0.98, "headline_only": 0.88}, 0.90
SPAN_SCORE, SPAN_FLOOR = {"exact": 1.0, "recovered": 0.90}, 0.90
COMPLETENESS, COMPLETENESS_BONUS = {"from_firm": 0.30, "title_to": 0.15, "office": 0.25, "practice_text": 0.25, "partner_tier": 0.05}, 0.05
DROPPED_PENALTY, DROPPED_REVIEW = 0.06, 2
SELF_REPORTED_FLOOR, ACCEPT = 0.60, 0.85
CORROBORATION_STEP, CORROBORATION_CAP = 0.04, 0.10


def _decimal(x: float) -> Column:
    return F.lit(x).cast("decimal(10,6)")


def _lookup(key: Column, values: dict, other: float) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(key == k, _decimal(v)) if out is None else out.when(key == k, _decimal(v))
    return out.otherwise(_decimal(other))


def tier_base(tier: Column) -> Column:
    return _lookup(tier, TIER_BASE, OTHER_TIER)


def access_factor(access: Column) -> Column:
    return _lookup(access, ACCESS, OTHER_ACCESS)


def completeness(present: dict[str, Column]) -> Column:
    """Earned share of the weights; ``present`` maps field names to boolean columns."""
    total = sum(COMPLETENESS.values())
    return sum((F.when(test, _decimal(COMPLETENESS[name] / total)).otherwise(_decimal(0)) for name, test in present.items()), _decimal(0))


def span_quality(qualities: Column) -> Column:
    """Mean score of the kept fields' qualities; 0 without any."""
    score = lambda q: F.when(q == "exact", 1000000).when(q == "recovered", 900000).otherwise(0)
    total = F.aggregate(qualities, F.lit(0).cast("long"), lambda a, q: a + score(q).cast("long"))
    return F.when(F.coalesce(F.size(qualities), F.lit(0)) > 0, (total.cast("decimal(20,6)") / F.size(qualities) / 1000000).cast("decimal(10,6)")).otherwise(_decimal(0))


def corroboration_bonus(sources: Column) -> Column:
    return F.least(_decimal(CORROBORATION_CAP), _decimal(CORROBORATION_STEP) * F.greatest(F.lit(0), sources - 1)).cast("decimal(10,6)")


def total(tier: Column, access: Column, present: Column, spans: Column, dropped: Column, sources: Column) -> Column:
    """The score, between 0 and 1, to three decimals; arguments are the components above."""
    factor = (_decimal(SPAN_FLOOR) + _decimal(1 - SPAN_FLOOR) * spans).cast("decimal(12,8)")
    base = ((tier * access).cast("decimal(14,8)") * factor).cast("decimal(22,14)")
    raw = base + _decimal(COMPLETENESS_BONUS) * present + corroboration_bonus(sources) - _decimal(DROPPED_PENALTY) * F.greatest(F.lit(0), dropped)
    return F.round(F.greatest(_decimal(0), F.least(_decimal(1), raw)), 3).cast("decimal(4,3)")


def needs_review(score: Column, dropped: Column, self_reported: Column) -> Column:
    return (score < ACCEPT) | (F.coalesce(dropped, F.lit(0)) >= DROPPED_REVIEW) | (F.coalesce(self_reported, F.lit(0.0)) < SELF_REPORTED_FLOOR)
