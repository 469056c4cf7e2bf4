"""Alerts that fire when a condition has held for a while: gaps and islands over status samples."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AlertRule:
    """An alert: its condition over a sample's columns, and the seconds that it must hold."""

    name: str
    condition: str
    seconds: int


#: Limits and holding times of the health alerts.
RULES = (
    AlertRule("lag_high", "lag > 10000", 120), AlertRule("publication_stalled", "publication_age > 600", 120), AlertRule("rejected_boundary", "rejected = 1", 30), AlertRule("lease_stalled", "active_lease = 1 and publication_age > 600", 120),
)


def episodes(samples: DataFrame, rules: Sequence[AlertRule] = RULES, series: Sequence[str] = ("series",), at: str = "at", open_: DataFrame | None = None) -> DataFrame:
    """(rule, series, since, fired_at, until): every stretch of samples in which a rule's condition holds.

    ``since`` is the stretch's first sample, ``fired_at`` the first one by which it has lasted the rule's
    time (null: not yet), ``until`` the first sample after it in which the condition does not hold (null:
    open). A null condition does not hold; of samples of one time all must hold. ``open_`` are the open
    episodes of earlier samples: they go on, so samples may come in batches of any size, in order of time.
    """
    judged = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(r.seconds).alias("_for"), F.coalesce(F.expr(r.condition), F.lit(False)).alias("_on")) for r in rules))).alias("j")
    rows = samples.select(*series, F.col(at).alias("_at"), judged).select(*series, "_at", "j.*").groupBy(*series, "rule", "_for", "_at").agg(F.bool_and("_on").alias("_on"))
    none = F.lit(None).cast(samples.schema[at].dataType)
    rows = rows.select(*series, "rule", "_for", "_at", "_on", none.alias("_fired"))
    if open_ is not None:
        seconds = F.create_map(*(F.lit(x) for r in rules for x in (r.name, r.seconds)))
        held = open_.where("until is null").select(*series, "rule", seconds[F.col("rule")].alias("_for"), F.col("since").alias("_at"), F.lit(True).alias("_on"), F.col("fired_at").alias("_fired"))
        rows = rows.unionByName(held)
    per = Window.partitionBy(*series, "rule").orderBy("_at")
    turn = (~F.col("_on")).cast("int")
    rows = rows.withColumn("_island", F.sum(turn).over(per)).withColumn("_next", F.lead("_at").over(per)).withColumn("_ends", F.lead("_on").over(per) == F.lit(False))
    on = rows.where("_on")
    start = F.min("_at").over(Window.partitionBy(*series, "rule", "_island"))
    lasted = F.expr("timestampdiff(second, _since, _at)") >= F.col("_for")
    found = on.withColumn("_since", start).groupBy(*series, "rule", "_island").agg(F.min("_since").alias("since"), F.coalesce(F.min("_fired"), F.min(F.when(lasted, F.col("_at")))).alias("fired_at"), F.max(F.when(F.col("_ends"), F.col("_next"))).alias("until"))
    return found.select("rule", *series, "since", "fired_at", "until")


def firing(found: DataFrame) -> DataFrame:
    """Open episodes that have fired."""
    return found.where("fired_at is not null and until is null")
