"""Event rows to entity-by-period panels: rates, drives, situations, rolling windows, ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.columns import bucket, conditional_rate, indicator, ratio


@dataclass(frozen=True)
class EventSpec:
    """Names of an event table's columns."""

    entity: str = "team"
    opponent: str = "opp"
    season: str = "season"
    period: str = "week"
    group: str = "game_id"
    subgroup: str = "drive"
    order: tuple[str, ...] = ("play_id",)
    value: str = "epa"
    gain: str = "yards"

    @property
    def keys(self) -> list[str]:
        return [self.entity, self.season, self.period]


def cleaned(events: DataFrame, kinds_out: Sequence[str], kind: str, season: str, first_season: int, dropped_flags: Sequence[str] = ()) -> DataFrame:
    """Rows of real events: a known kind that isn't administrative, from `first_season` on."""
    ok = F.col(kind).isNotNull() & ~F.col(kind).isin(*kinds_out) & (F.col(season) >= first_season)
    for f in dropped_flags:
        ok = ok & (F.col(f) == 0)
    return events.filter(ok)


def classified(events: DataFrame, s: EventSpec) -> DataFrame:
    """Success, explosiveness, scoring, field zone, distance and margin labels of each event.

    Comparisons with null fail, so a null value is no success and a null yardline falls to the last label.
    """
    return events.withColumns({
        "is_success": indicator(F.col(s.value) > 0),
        "is_explosive": indicator(((F.col("is_pass") == 1) & (F.col(s.gain) >= 15)) | ((F.col("is_rush") == 1) & (F.col(s.gain) >= 10))),
        "is_scoring": indicator((F.col("touchdown") == 1) | (F.col("field_goal") == 1)),
        "field_zone": bucket("yardline", ((10, "Goal Line"), (20, "Red Zone"), (50, "Opponent Territory"), (80, "Own Territory")), "Deep Own Territory"),
        "down_distance": F.when((F.col("down") == 3) & (F.col("togo") <= 3), "Third and Short").when((F.col("down") == 3) & F.col("togo").between(4, 7), "Third and Medium").when((F.col("down") == 3) & (F.col("togo") > 7), "Third and Long").when(F.col("down") == 4, "Fourth Down").otherwise("Early Down"),
        "score_situation": bucket(F.abs("margin"), ((7, "One Score"), (14, "Two Score")), "Blowout"),
        "progress": F.abs(F.col("start_yardline") - F.col("yardline")),
    })


def situation_labels(events: DataFrame) -> DataFrame:
    """Five context labels; score_situation takes the place of an earlier one."""
    return events.withColumns({
        "zone_situation": bucket("yardline", ((20, "red_zone"), (50, "scoring_range"), (80, "midfield")), "own_territory"),
        "down_situation": F.when(F.col("down") == 1, "first").when(F.col("down") == 2, "second").when(F.col("down") == 3, "third").when(F.col("down") == 4, "fourth").otherwise("other"),
        "distance_situation": bucket("togo", ((2, "short"), (7, "medium"), (15, "long")), "very_long"),
        "score_situation": bucket(F.abs("margin"), ((3, "close"), (8, "one_score"), (14, "two_score")), "blowout"),
        "clock_situation": F.when(F.col("half_seconds") <= 120, "two_minute").when(F.col("half_seconds") <= 300, "late_half").otherwise("normal"),
    })


def numbered_in_group(events: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "number_in_group") -> DataFrame:
    return events.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def weekly_panel(events: DataFrame, s: EventSpec, by: str | None = None) -> DataFrame:
    """One row per entity and period: counts, totals and rates, with what happens near the goal and per subgroup.

    All aggregates come from one pass over the events; those of narrower row sets have conditions
    of their own. Subgroups are counted by their first events: a distinct count would hold all sums of every subgroup. Rates of one kind of event over all events and over that kind both occur: the
    former end in `_rate`, the latter average the value within the kind. `by`: the grouping entity
    (the opponent gives the defensive panel).
    """
    me = by or s.entity
    attempt = (F.col("is_pass") == 1) | (F.col("is_rush") == 1)
    live = attempt & F.col(s.entity).isNotNull() & F.col(s.opponent).isNotNull()
    near, value = live & (F.col("yardline") <= 20), F.col(s.value)
    on = lambda test: F.sum(F.when(live & test, 1).otherwise(0)).cast("long")
    rate = lambda test: conditional_rate(test, live)
    drive = Window.partitionBy(me, s.season, s.period, s.group, s.subgroup).orderBy(s.group)
    first = (F.row_number().over(drive) == 1) & F.col(s.subgroup).isNotNull()
    panel = events.filter(F.col(me).isNotNull()).withColumn("_first", first).groupBy(F.col(me).alias(s.entity), s.season, s.period).agg(
        F.sum(F.when(live, 1).otherwise(0)).cast("long").alias("plays"),
        F.sum(F.when(live, value)).alias("total_value"), F.avg(F.when(live, value)).alias("value_per_play"),
        rate(F.col("is_success") == 1).alias("success_rate"), rate(F.col("is_explosive") == 1).alias("explosive_rate"),
        on(F.col("is_pass") == 1).alias("pass_plays"), on(F.col("is_rush") == 1).alias("rush_plays"),
        F.avg(F.when(live & (F.col("is_pass") == 1), value)).alias("pass_value"), F.avg(F.when(live & (F.col("is_rush") == 1), value)).alias("rush_value"),
        rate((F.col("is_pass") == 1) & (F.col("is_success") == 1)).alias("pass_success_rate"), rate((F.col("is_rush") == 1) & (F.col("is_success") == 1)).alias("rush_success_rate"),
        on(F.col("touchdown") == 1).alias("touchdowns"), on(F.col("turnover") == 1).alias("turnovers"), rate(F.col("turnover") == 1).alias("turnover_rate"),
        F.sum(F.when(live, F.col(s.gain))).alias("total_gain"), F.avg(F.when(live, F.col(s.gain))).alias("gain_per_play"),
        on(F.col("yardline") <= 20).alias("near_plays"), F.avg(F.when(near, F.when(F.col("touchdown") == 1, 1.0).otherwise(0.0))).alias("near_td_rate"),
        F.avg(F.when(near, value)).alias("near_value"),
        rate((F.col("is_pass") == 1) & (F.col(s.gain) >= 15)).alias("explosive_pass_rate"), rate((F.col("is_rush") == 1) & (F.col(s.gain) >= 10)).alias("explosive_rush_rate"),
        F.avg(F.when(live & (F.col("is_pass") == 1), F.col(s.gain))).alias("gain_per_pass"), F.avg(F.when(live & (F.col("is_rush") == 1), F.col(s.gain))).alias("gain_per_rush"),
        on(F.col("down") == 3).alias("third_downs"), on(F.col("third_conv") == 1).alias("third_conversions"), F.avg(F.when(live & (F.col("down") == 3), F.col("third_conv").cast("double"))).alias("third_rate"),
        on((F.col("is_pass") == 1) & (F.col("touchdown") == 1)).alias("pass_touchdowns"), on((F.col("is_rush") == 1) & (F.col("touchdown") == 1)).alias("rush_touchdowns"),
        on(F.col("sack") == 1).alias("sacks"), F.avg(F.when(live & ((F.col("is_pass") == 1) | (F.col("sack") == 1)), F.col("sack").cast("double"))).alias("sack_rate"),
        F.count_if("_first").alias("drives"),
        F.sum(F.when(F.col(s.subgroup).isNotNull(), 6 * F.col("touchdown") + 3 * F.col("field_goal"))).alias("_points"),
        F.sum(F.when(F.col(s.subgroup).isNotNull(), F.col(s.gain))).alias("_gain"),
    ).filter("plays > 0")
    return panel.withColumns({"pass_share": ratio("pass_plays", "plays"), "approx_points_per_drive": ratio("_points", "drives"), "gain_per_drive": ratio("_gain", "drives")}).drop("_points", "_gain")


def rolling(panel: DataFrame, columns: Mapping[str, str], entity: str, season: str, period: str, periods: int = 4, reset: bool = False, prior_only: bool = False) -> DataFrame:
    """Adds means (or sums) over the last `periods` rows of the entity; columns: new name -> 'avg(x)' or 'sum(x)'.

    reset: start anew each season. prior_only: leave out the row itself. All share one window, so one sort.
    """
    w = Window.partitionBy(entity, season) if reset else Window.partitionBy(entity)
    w = w.orderBy(season, period)
    w = w.rowsBetween(-periods, -1) if prior_only else w.rowsBetween(1 - periods, 0)
    return panel.withColumns({new: F.expr(e).over(w) for new, e in columns.items()})


def period_ranks(panel: DataFrame, columns: Mapping[str, tuple[str, bool]], season: str, period: str) -> DataFrame:
    """Ranks within each period; columns: new name -> (column, ascending). A null ranks as the largest value."""
    def order(x: str, up: bool) -> Column:
        return F.col(x).asc_nulls_last() if up else F.col(x).desc_nulls_first()

    return panel.withColumns({new: F.rank().over(Window.partitionBy(season, period).orderBy(order(x, up))).cast("long") for new, (x, up) in columns.items()})


def situational_panel(events: DataFrame, s: EventSpec, situations: Mapping[str, Column]) -> DataFrame:
    """Wide panel of plays, mean value, success rate and touchdowns per subgroup in each situation.

    A subgroup is counted at its first event of a situation, so no event is copied for a distinct count
    and no sums are held for every subgroup.
    """
    value, firsts, sums = F.col(s.value), {}, []
    drive = Window.partitionBy(*s.keys, s.group, s.subgroup).orderBy(s.group).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a subgroup whose group or number is null is no subgroup, but its events count
    whole = F.col(s.group).isNotNull() & F.col(s.subgroup).isNotNull()
    for name, test in situations.items():
        firsts[f"_{name}_first"] = test & whole & (F.count_if(test).over(drive) == 1)
        plays = F.count_if(test)
        sums += [
            plays.alias(f"{name}_plays"), ratio(F.sum(F.when(test, value)), plays).alias(f"{name}_value"), ratio(F.sum(F.when(test, F.col("is_success"))), plays).alias(f"{name}_success_rate"),
            ratio(F.sum(F.when(test, F.col("touchdown"))), F.count_if(f"_{name}_first")).alias(f"{name}_td_rate"),
        ]
    rows = events.filter(value.isNotNull() & F.col(s.entity).isNotNull()).withColumns(firsts).groupBy(*s.keys).agg(*sums)
    return rows.filter(" + ".join(f"{n}_plays" for n in situations) + " > 0")


def situational_panel_by_pivot(events: DataFrame, s: EventSpec, situations: Mapping[str, Column]) -> DataFrame:
    """The same by a union of filtered roll-ups and a pivot: the shape to test the other against."""
    parts = None
    for name, test in situations.items():
        rows = events.filter(F.col(s.value).isNotNull() & F.col(s.entity).isNotNull() & test).groupBy(*s.keys)
        part = rows.agg(F.count("*").alias("plays"), F.avg(s.value).alias("value"), F.avg(F.col("is_success").cast("double")).alias("success_rate"), ratio(F.sum("touchdown"), F.count_distinct(F.struct(s.group, s.subgroup))).alias("td_rate")).withColumn("situation", F.lit(name))
        parts = part if parts is None else parts.unionByName(part)
    wide = parts.groupBy(*s.keys).pivot("situation", list(situations)).agg(*[F.max(x).alias(x) for x in ("plays", "value", "success_rate", "td_rate")])
    return wide.fillna(0, [f"{n}_plays" for n in situations])


def team_features(offense: DataFrame, defense: DataFrame, s: EventSpec) -> DataFrame:
    """Offense with the same period's defense, tiers by threshold, and the trend against the rolling mean."""
    d = defense.select(*s.keys, *[F.col(x).alias(f"def_{x}") for x in defense.columns if x not in s.keys])
    both = offense.join(d, s.keys, "left")
    return both.withColumns({
        "efficiency_tier": bucket("value_l4", ((0.15, "elite"), (0.05, "good"), (-0.05, "average")), "poor", below=False, strict=True),
        "def_strength_tier": bucket("def_value_l4", ((-0.1, "elite"), (0.0, "good"), (0.1, "average")), "poor", strict=True),
        "trend": F.col("value_per_play") - F.col("value_l4"), "volatility": F.lit(0.1),
    })


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], last: bool = False) -> DataFrame:
    """The columns of each group's first (or last) row in order, by an aggregate that combines before the shuffle."""
    pick = F.max_by if last else F.min_by
    row = pick(F.struct(*columns), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, *[f"_row.{x}" for x in columns])
