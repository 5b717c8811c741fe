"""County by day: enrichment, daily changes, 7-day means, growth, elections, vaccination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import buckets, join_code, margin_bucket, pad_code, two_way_label
from ..functions.dates import as_of_columns, parse_date
from ..functions.missing import add_all, number, rate_per, ratio
from ..operators.dedupe import first_per_key
from ..operators.enrich import lookup, overridden, repaired
from ..operators.filters import min_history
from ..operators.panel import Panel, with_latest
from ..sources.staging import staged
from . import constants as k

COUNTY = ("stname", "ctyname")
PANEL = Panel(COUNTY, "date", ties=("cases", "deaths"))


# dimensions ------------------------------------------------------------------
def population(raw: DataFrame) -> DataFrame:
    return raw.select(
        number(join_code("state", "county"), "long").alias("fips"),
        "stname",
        "ctyname",
        number("popestimate2019").alias("pop"),
    )


def metro(raw: DataFrame) -> DataFrame:
    """The crosswalk lists some counties twice with the same text."""
    return raw.select(number("fipscounty", "long").alias("fips"), "cbsaname", "msaname").distinct()


def density(raw: DataFrame) -> DataFrame:
    area = number("area_in_square_miles_total_area")
    return raw.select(number("target_geo_id2", "long").alias("fips"), ratio(number("population"), area).alias("pop_density")).dropna(subset=["fips"])


def regions(raw: DataFrame) -> DataFrame:
    return raw.withColumnRenamed("state", "stname")


def result_2016(raw: DataFrame, missing_is_lower: bool = False) -> DataFrame:
    return raw.select(
        number("combined_fips", "long").alias("fips"),
        "votes_dem",
        "votes_gop",
        two_way_label("votes_dem", "votes_gop", "Blue", "Red", missing_is_lower).alias("result2016"),
    )


def result_2020(raw: DataFrame) -> DataFrame:
    """Votes of the two parties per county, their total, share and margin bucket.

    Summing and widening is one aggregate: a party without rows is missing, a
    party whose votes are all missing counts 0.
    """
    votes = raw.where((F.col("race") == k.RACE) & F.col("fips5").isNotNull() & F.col("lname").isin(k.PARTY_A, k.PARTY_B))

    def of(party: str) -> Column:
        return F.sum(F.when(F.col("lname") == party, F.coalesce("votes", F.lit(0)))).alias(party)

    a, b = k.PARTY_A, k.PARTY_B
    wide = votes.groupBy(F.col("fips5").cast("long").alias("fips")).agg(of(k.PARTY_A), of(k.PARTY_B))
    return (
        wide.withColumn("total_votes", add_all(a, b))
        .withColumn("biden_pct", ratio(a, "total_votes"))
        .withColumn("biden_pct_bucket", margin_bucket("biden_pct", *k.MARGIN, k.MARGIN_LABELS))
    )


def vaccination(raw: DataFrame) -> DataFrame:
    pct = raw.select(number("fips", "long").alias("fips"), number("series_complete_pop_pct").alias("series_complete_pop_pct"))
    one = first_per_key(pct, ["fips"], [F.col("series_complete_pop_pct").desc_nulls_last()])
    return one.withColumn("full_vax_bin", buckets("series_complete_pop_pct", k.VACCINATION_BUCKETS))


# fact --------------------------------------------------------------------------
def counters(raw: DataFrame) -> DataFrame:
    day = parse_date("date") if dict(raw.dtypes)["date"] == "string" else F.col("date")
    return raw.select(day.alias("date"), "county", "state", F.col("fips").cast("long").alias("fips"), "cases", "deaths")


def named(fact: DataFrame, people: DataFrame) -> DataFrame:
    """County and state names from the population table, else the fact's own."""
    return (
        lookup(fact, people, "fips")
        .withColumn("ctyname", repaired("ctyname", "county"))
        .withColumn("stname", repaired("stname", "state"))
        .drop("county", "state")
    )


def described(fact: DataFrame, metros: DataFrame, densities: DataFrame) -> DataFrame:
    """Metro area, density, population override, then rates per 1,000 people."""
    wide = lookup(lookup(fact, metros, "fips"), densities, "fips")
    return (
        wide.withColumn("msaname", overridden("msaname", "ctyname", {k.NEW_YORK_CITY: k.NYC_METRO}))
        .withColumn("pop", overridden("pop", "ctyname", {k.NEW_YORK_CITY: float(k.NYC_POPULATION)}))
        .withColumn("caseper1k", rate_per("cases", "pop"))
        .withColumn("deathper1k", rate_per("deaths", "pop"))
    )


def changes(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "cases_prior": PANEL.lag("cases"),
            "new_cases": PANEL.delta("cases", keep_first=True),
            "deaths_prior": PANEL.lag("deaths"),
            "new_deaths": PANEL.delta("deaths", keep_first=True),
        }
    )


def growth(df: DataFrame) -> DataFrame:
    """Ramp means, their lags and the change against a week before."""
    means = df.withColumns({"pos_7d_avg": PANEL.rolling_mean("new_cases"), "death_7d_avg": PANEL.rolling_mean("new_deaths")})
    return means.withColumns(
        {
            "lstwk_pos_7d_avg": PANEL.lag("pos_7d_avg", 7),
            "lstwk_death_7d_avg": PANEL.lag("death_7d_avg", 7),
            "deaths_incr_week": PANEL.change("death_7d_avg"),
            "pos_incr_week": PANEL.change("pos_7d_avg"),
            "case_7d_15": PANEL.lag("pos_7d_avg", 14),
            "case_yest": PANEL.lag("pos_7d_avg"),
            "death_yest": PANEL.lag("death_7d_avg"),
        }
    )


def latest_day(rows: DataFrame) -> Column:
    """Latest day among counties with enough history, from the narrow fact alone."""
    per_county = rows.groupBy(*COUNTY).agg(F.count(F.lit(1)).alias("n"), F.max("date").alias("last"))
    return per_county.where(F.col("n") >= k.MIN_COUNTY_ROWS).agg(F.max("last")).scalar()


def one_per_day(fact: DataFrame) -> DataFrame:
    """The row with the smallest code and the highest counters of each county and day; copies collapse before the shuffle."""
    order = [F.col("fips").asc_nulls_last(), F.col("cases").desc_nulls_last(), F.col("deaths").desc_nulls_last(), F.col("pop").desc_nulls_last()]
    return first_per_key(fact, [*COUNTY, "date"], order)


def county_panel(feeds: dict[str, DataFrame]) -> DataFrame:
    """One row per county and day with ramp means, elections and vaccination.

    A county and day that repeats, exactly or not, keeps one row before the windows, so a window
    holds at most as many rows as the calendar has days. The narrow result is written once: the
    windows and the latest day both read it. The other dimensions come after the windows, so what is
    shuffled and sorted by county stays narrow.
    """
    fact = staged(one_per_day(named(counters(feeds["county_counters"]), population(feeds["county_population"]))), "county_days")
    panel = growth(changes(min_history(fact, PANEL, k.MIN_COUNTY_ROWS)))
    panel = with_latest(panel, PANEL, recent_cases="pos_7d_avg", recent_cases_1wk="lstwk_pos_7d_avg")
    panel = described(panel, metro(feeds["metro_crosswalk"]), density(feeds["density"]))
    panel = lookup(panel, staged(result_2020(feeds["election_2020"]), "result_2020"), "fips", unique=True)
    panel = lookup(panel, result_2016(feeds["election_2016"]), "fips")
    panel = panel.withColumn("result2016", overridden("result2016", "ctyname", {k.NEW_YORK_CITY: k.NYC_RESULT_2016}))
    panel = panel.withColumn("max_date", latest_day(fact)).withColumns(as_of_columns("date"))
    panel = lookup(panel, regions(feeds["census_regions"]), "stname")
    return lookup(panel, vaccination(feeds["county_vaccination"]), "fips", unique=True)


def latest_by_code(rows: DataFrame) -> DataFrame:
    """Latest day per code, from two columns of the feed. A row without a code has none."""
    return rows.dropna(subset=["fips"]).groupBy("fips").agg(F.max("date").alias("max_date"))


def county_panel_strict(feeds: dict[str, DataFrame]) -> DataFrame:
    """One row per county and day with strict means and the latest day per code.

    A county and day that repeats keeps the row with the smallest code and the
    highest counters.
    """
    rows = counters(feeds["county_counters"])
    fact = named(rows, population(feeds["county_population"]))
    panel = changes(one_per_day(fact)).withColumns(
        {
            "pos_7d_avg": PANEL.rolling_mean("new_cases", mode="strict"),
            "death_7d_avg": PANEL.rolling_mean("new_deaths", mode="strict"),
        }
    )
    panel = described(panel, metro(feeds["metro_crosswalk"]), density(feeds["density"]))
    votes = result_2016(feeds["election_2016"], missing_is_lower=True).select("fips", "result2016")
    panel = lookup(panel, votes, "fips")
    panel = panel.withColumn("result2016", overridden("result2016", "ctyname", {k.NEW_YORK_CITY: k.NYC_RESULT_2016}))
    panel = lookup(panel, latest_by_code(rows), "fips", unique=True).withColumns(as_of_columns("date"))
    return panel.withColumn("fips", pad_code("fips"))
