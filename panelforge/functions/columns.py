"""Column functions: tolerant casts, flags, ratios, buckets, probabilities, dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# casts ----------------------------------------------------------------------


def to_int(x: Column | str) -> Column:
    """Text such as '1.0' to int, halves away from zero; what isn't a number gives null."""
    return c(x).try_cast("decimal(38,0)").cast("int")


def to_double(x: Column | str) -> Column:
    return c(x).try_cast("double")


def to_line(x: Column | str, scale: int = 1) -> Column:
    """A betting line: with halves (1), or whole numbers as warehouses without a scale keep them (0)."""
    return to_double(x) if scale else c(x).try_cast("decimal(38,0)").cast("double")


def to_date(x: Column | str) -> Column:
    return F.try_to_date(c(x))


def flag(x: Column | str) -> Column:
    """1 where the text or number equals 1, else 0 (null included)."""
    return F.when(to_double(x) == 1, 1).otherwise(0)


def any_flag(*xs: Column | str) -> Column:
    test = to_double(xs[0]) == 1
    for x in xs[1:]:
        test = test | (to_double(x) == 1)
    return F.when(test, 1).otherwise(0)


def indicator(test: Column) -> Column:
    return F.when(test, 1).otherwise(0)


def ratio(x: Column | str, y: Column | str) -> Column:
    """x / y, null where y is 0 or null."""
    return c(x).cast("double") / F.nullif(c(y).cast("double"), F.lit(0.0))


def surrogate_key(columns: Sequence[str], empty: str = "_null_") -> Column:
    """md5 of the columns as text, joined by dashes; nulls have a placeholder of their own."""
    return F.md5(F.concat_ws("-", *[F.coalesce(F.col(x).cast("string"), F.lit(empty)) for x in columns]))


def null_tokens(x: Column | str, tokens: Sequence[str] = ("NULL", "null", "", "NA", "n/a")) -> Column:
    return F.when(c(x).isin(*tokens), F.lit(None)).otherwise(c(x))


def filled(x: Column | str, value) -> Column:
    return F.coalesce(F.nanvl(to_double(x), F.lit(None).cast("double")), F.lit(value))


def conditional_rate(test: Column, among: Column | None = None) -> Column:
    """Share of rows that pass: of all rows, or of those in `among`."""
    hit = F.when(test, 1.0).otherwise(0.0)
    return F.avg(hit if among is None else F.when(among, hit))


# buckets --------------------------------------------------------------------


def bucket(x: Column | str, cuts: Sequence[tuple[float, str]], rest: str | None, below: bool = True, strict: bool = False) -> Column:
    """The label of the first cut that x is within (at most, or at least if not `below`)."""
    x = c(x)
    out = None
    for at, label in cuts:
        test = (x < at if strict else x <= at) if below else (x > at if strict else x >= at)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(rest)


def clamp(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """least/greatest that keep null null."""
    y = x
    y = F.least(y, F.lit(high)) if high is not None else y
    y = F.greatest(y, F.lit(low)) if low is not None else y
    return F.when(x.isNotNull(), y)


# betting ---------------------------------------------------------------------


def implied_probability(line: Column | str, home_sign: int = 1, per_point: float = 0.033) -> Column:
    """Home win probability that a point spread implies, linear around one half."""
    x = c(line) * home_sign
    return F.when(x > 0, 0.5 + F.abs(x) * per_point).when(x < 0, 0.5 - F.abs(x) * per_point).when(x == 0, 0.5)


def logistic(spread: Column | str, scale: float = 5.5) -> Column:
    return 1.0 / (1.0 + F.exp(-c(spread) / scale))


def elo_probability(gap: Column | str, scale: float = 400.0) -> Column:
    return 1.0 / (1.0 + F.pow(F.lit(10.0), -c(gap) / scale))


def recommendation(edge: Column | str, least: float = 3.0) -> Column:
    """Home is backed where the model likes it more than the market does."""
    return F.when(c(edge) >= least, "BET HOME").when(c(edge) <= -least, "BET AWAY").otherwise("NO BET")


def confidence(edge: Column | str, cuts: Sequence[tuple[float, str]] = ((5.0, "HIGH"), (3.0, "MEDIUM"))) -> Column:
    return bucket(F.abs(c(edge)), cuts, "LOW", below=False)


def prediction_confidence(spread: Column | str, full: float = 14.0) -> Column:
    return clamp(F.abs(c(spread)) / full, 0.0, 1.0)


def favourite(spread: Column | str) -> Column:
    return F.when(c(spread) > 0, "home").when(c(spread) < 0, "away").when(c(spread) == 0, "pick'em")


# dates -----------------------------------------------------------------------


def season_of(day: Column | str, first_month: int = 3) -> Column:
    """January and February belong to the season of the year before."""
    return F.year(c(day)) - indicator(F.month(c(day)) < first_month)


def week_of(day: Column | str, last: int = 18) -> Column:
    """Weeks since the first Tuesday of September of the season, 1 to `last`."""
    september = F.make_date(season_of(day), F.lit(9), F.lit(1))
    start = F.next_day(F.date_sub(september, 1), "TU")
    return F.greatest(F.lit(1), F.least(F.lit(last), F.floor(F.datediff(c(day), start) / 7).cast("int") + 1))


def in_season(day: Column | str, months: Sequence[int] = (9, 10, 11, 12, 1, 2)) -> Column:
    return F.month(c(day)).isin(*months)
