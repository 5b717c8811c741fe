"""Feeds of the flows, made from the test tables, and the same in SQL.

Counties stand for customers, states for nations, facilities for suppliers.
Nothing is left out: every order and every line item reaches a feed. A feed that a
flow reads more than once is staged, as a stored feed would be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import union_by_name
from ..operators.enrich import lookup
from ..operators.panel import Panel, build_panel
from ..plans.hospital import ADULT, CHILD, ICU
from ..sources.staging import staged
from .tables import load, nations, orders_of_nations, rows, running, shipments


def whole(c: str) -> Column:
    """Amount without cents."""
    return F.floor(c)


# counties ---------------------------------------------------------------------------
def customers_of_nations(spark: SparkSession, sf: str) -> DataFrame:
    return lookup(load(spark, sf, "customer"), nations(spark, sf, "c_nationkey"), "c_nationkey")


def county_counters(spark: SparkSession, sf: str, customers: DataFrame) -> DataFrame:
    """Orders so far per customer and day. One customer stands for a city without a code; first days come twice."""
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    panel = build_panel(orders, ["o_custkey"], F.col("o_orderdate"), "date", n=rows(), f=rows(F.col("o_orderstatus") == "F"))
    by_customer = Panel(("o_custkey",), "date")
    counted = panel.select("o_custkey", "date", running(by_customer, "n").alias("cases"), running(by_customer, "f").alias("deaths"))
    key = F.col("c_custkey")
    city = F.when(key == 1, F.lit("New York City")).otherwise(F.col("c_name"))
    names = customers.select(key.alias("o_custkey"), city.alias("county"), F.col("n_name").alias("state"))
    counters = lookup(counted, names, "o_custkey").select(
        "date", "county", "state", F.when(F.col("o_custkey") != 1, F.col("o_custkey")).alias("fips"), "cases", "deaths"
    )
    return staged(union_by_name([counters, counters.where(F.col("cases") == 1)]), "county_counters")


def county_feeds(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    customers = customers_of_nations(spark, sf)
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice")
    key = F.col("c_custkey")
    code = F.lpad(key.cast("string"), 9, "0")
    pct = F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 100).cast("string")).otherwise(F.lit("n/a"))
    vax = customers.select(key.cast("string").alias("fips"), pct.alias("series_complete_pop_pct"), "c_mktsegment")
    older = vax.where(F.col("c_mktsegment") == "BUILDING").withColumn("series_complete_pop_pct", F.lit("-1"))
    metro = customers.where(F.col("c_acctbal") >= 1000).select(
        code.alias("fipscounty"), F.col("c_mktsegment").alias("cbsaname"), F.concat("c_mktsegment", F.lit(" AREA")).alias("msaname")
    )
    high = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    mid = F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED")
    return {
        "county_counters": county_counters(spark, sf, customers),
        "county_population": customers.where(F.col("c_acctbal") >= 0).select(
            F.substring(code, 1, 6).alias("state"),
            F.substring(code, 7, 3).alias("county"),
            F.col("n_name").alias("stname"),
            F.col("c_name").alias("ctyname"),
            whole("c_acctbal").cast("string").alias("popestimate2019"),
        ),
        "metro_crosswalk": union_by_name([metro, metro.where(F.col("cbsaname") == "BUILDING")]),
        "density": customers.select(
            key.cast("string").alias("target_geo_id2"),
            whole("c_acctbal").cast("string").alias("population"),
            F.col("c_nationkey").cast("string").alias("area_in_square_miles_total_area"),
        ),
        "census_regions": census(spark, sf, "n_name"),
        "election_2016": staged(
            orders.groupBy(F.col("o_custkey").alias("combined_fips")).agg(
                rows(high).cast("double").alias("votes_dem"), rows(~high).cast("double").alias("votes_gop")
            ),
            "election_2016",
        ),
        "election_2020": orders.select(
            F.when(F.col("o_orderstatus") != "P", F.lit("President")).otherwise(F.lit("Senate")).alias("race"),
            F.col("o_custkey").alias("fips5"),
            F.when(high, F.lit("Biden")).when(mid, F.lit("Trump")).otherwise(F.lit("Other")).alias("lname"),
            F.when(F.col("o_orderpriority") != "2-HIGH", whole("o_totalprice").cast("double")).alias("votes"),
        ),
        "county_vaccination": union_by_name([vax, older]).drop("c_mktsegment"),
    }


def census(spark: SparkSession, sf: str, code: str) -> DataFrame:
    """Regions by nation: `state` holds the name, `state_code` what `code` says."""
    region = load(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    wide = lookup(load(spark, sf, "nation"), region, "n_regionkey")
    return wide.select(
        F.col("n_name").alias("state"),
        F.col(code).cast("string").alias("state_code"),
        "region",
        F.concat(F.lit("Division "), F.col("n_regionkey").cast("string")).alias("division"),
    )


COUNTY_SQL = """
WITH cust AS (SELECT *, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS code FROM customer JOIN nation ON n_nationkey = c_nationkey),
 daily AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS f FROM orders GROUP BY 1, 2),
 counted AS (SELECT o_custkey, date, CAST(sum(n) OVER w AS BIGINT) AS cases, CAST(sum(f) OVER w AS BIGINT) AS deaths FROM daily
     WINDOW w AS (PARTITION BY o_custkey ORDER BY date)),
 counters AS (SELECT date, CASE WHEN c_custkey = 1 THEN 'New York City' ELSE c_name END AS county, n_name AS state,
     CASE WHEN c_custkey <> 1 THEN c_custkey END AS fips, cases, deaths FROM counted JOIN cust ON c_custkey = o_custkey),
 population AS (SELECT c_custkey AS fips, n_name AS stname, c_name AS ctyname, floor(c_acctbal) AS pop FROM cust WHERE c_acctbal >= 0),
 metro AS (SELECT c_custkey AS fips, c_mktsegment AS cbsaname, c_mktsegment || ' AREA' AS msaname FROM cust WHERE c_acctbal >= 1000),
 density AS (SELECT c_custkey AS fips, floor(c_acctbal) / nullif(c_nationkey, 0) AS pop_density FROM cust),
 v16 AS (SELECT o_custkey AS fips, CAST(count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS DOUBLE) AS votes_dem,
     CAST(count(*) FILTER (WHERE NOT o_orderpriority IN ('1-URGENT', '2-HIGH')) AS DOUBLE) AS votes_gop FROM orders GROUP BY 1),
 v20 AS (SELECT fips, sum(biden) AS biden, sum(trump) AS trump FROM (
     SELECT o_custkey AS fips, CASE WHEN o_orderpriority = '1-URGENT' THEN floor(o_totalprice) WHEN o_orderpriority = '2-HIGH' THEN 0.0 END AS biden,
       CASE WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN floor(o_totalprice) END AS trump
     FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW') GROUP BY 1),
 share20 AS (SELECT *, biden + trump AS total_votes, biden / nullif(biden + trump, 0) AS biden_pct FROM v20),
 vax AS (SELECT c_custkey AS fips, CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 100) AS DOUBLE)
     WHEN c_mktsegment = 'BUILDING' THEN -1.0 END AS series_complete_pop_pct FROM cust),
 regions AS (SELECT n_name AS stname, n_name AS state_code, r_name AS region, 'Division ' || n_regionkey AS division
     FROM nation JOIN region ON r_regionkey = n_regionkey),
 named AS (SELECT date, fips, cases, deaths, coalesce(p.stname, state) AS stname, coalesce(p.ctyname, county) AS ctyname, p.pop
     FROM counters c LEFT JOIN population p USING (fips)),
 wide AS (SELECT named.* EXCLUDE (pop), cbsaname, pop_density,
     CASE WHEN ctyname = 'New York City' THEN 'NEW YORK-NEWARK, NY-NJ-PA' ELSE msaname END AS msaname,
     CASE WHEN ctyname = 'New York City' THEN 8491000.0 ELSE pop END AS pop
     FROM named LEFT JOIN metro USING (fips) LEFT JOIN density USING (fips)),
 rated AS (SELECT *, cases / nullif(pop, 0) * 1000 AS caseper1k, deaths / nullif(pop, 0) * 1000 AS deathper1k,
     count(*) OVER (PARTITION BY stname, ctyname) AS n_dates FROM wide)"""


# tests -----------------------------------------------------------------------------
OUTCOME_OF = {"F": "Positive", "O": "Negative", "P": "Inconclusive"}


def order_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per nation, day and status: small at any size of the raw table, which is read once."""
    cells = build_panel(orders_of_nations(spark, sf), ["c_nationkey", "o_orderstatus"], F.col("o_orderdate"), "date", n=rows())
    return staged(lookup(cells, nations(spark, sf, "c_nationkey", "state"), "c_nationkey").drop("c_nationkey"), "order_cells")


def test_results(cells: DataFrame) -> DataFrame:
    """Orders by state, status and day as new results; everything so far as the total."""
    outcome = F.create_map(*[F.lit(x) for pair in OUTCOME_OF.items() for x in pair])[F.col("o_orderstatus")]
    return cells.select(
        "state",
        "date",
        outcome.alias("overall_outcome"),
        F.col("n").alias("new_results_reported"),
        running(Panel(("state", "o_orderstatus"), "date"), "n").alias("total_results_reported"),
    )


TEST_CTE = """
 feed AS (SELECT n_name AS state, CAST(o_orderdate AS DATE) AS date, o_orderstatus AS s, count(*) AS n FROM orders
     JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3),
 totals AS (SELECT *, CAST(sum(n) OVER (PARTITION BY state, s ORDER BY date) AS BIGINT) AS t FROM feed),
 tests0 AS (SELECT state, date, max(CASE WHEN s = 'F' THEN n END) AS new_tests_positive, max(CASE WHEN s = 'O' THEN n END) AS new_tests_negative,
     max(CASE WHEN s = 'P' THEN n END) AS new_tests_inconclusive, max(CASE WHEN s = 'F' THEN t END) AS total_tests_positive,
     max(CASE WHEN s = 'O' THEN t END) AS total_tests_negative, max(CASE WHEN s = 'P' THEN t END) AS total_tests_inconclusive
     FROM totals GROUP BY 1, 2),
 tests1 AS (SELECT *, new_tests_negative + new_tests_positive AS new_tests FROM tests0)"""


# hospital --------------------------------------------------------------------------
BANDS = ["18_19", "60_69", "80"]


def line_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Line items per nation, day, flag, status and line: small at any size of the raw table, which is read once."""
    lines = shipments(spark, sf, "l_quantity", "l_linenumber", "l_returnflag", "l_linestatus")
    keys = ["s_nationkey", "l_returnflag", "l_linestatus", "l_linenumber"]
    cells = build_panel(lines, keys, F.col("l_shipdate"), "day", n=rows(), qty=F.sum(F.col("l_quantity").cast("decimal(18,2)")))
    return staged(lookup(cells, nations(spark, sf, "s_nationkey", "state"), "s_nationkey").drop("s_nationkey"), "line_cells")


def lines_where(condition: Column | None = None) -> Column:
    """Line items counted from their cells."""
    return F.sum("n") if condition is None else F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0).cast("long"))


def hospital_measures() -> dict[str, Column]:
    def flag(f: str, lo: int, hi: int) -> Column:
        return lines_where((F.col("l_returnflag") == f) & F.col("l_linenumber").between(lo, hi))

    bands = {}
    for status, f in (("confirmed", "R"), ("suspected", "A")):
        for i, band in enumerate(BANDS):
            bands[f"{ADULT}_covid_{status}_{band}"] = F.nullif(flag(f, 2 * i + 1, 2 * i + 2), F.lit(0))
        bands[f"{ADULT}_covid_{status}_{BANDS[0]}_coverage"] = lines_where()
    quantity = F.sum("qty").cast("double")
    return {
        "inpatient_beds_used": quantity,
        "staffed_adult_icu_bed_occupancy": F.sum(F.col("l_linenumber") * F.col("n")),
        "inpatient_beds_used_covid": lines_where(),
        "deaths_covid": lines_where(F.col("l_linestatus") == "F"),
        "deaths_covid_coverage": lines_where(),
        ICU: F.floor(quantity * 40),
        f"{ADULT}_covid_confirmed": flag("R", 1, 6),
        f"{ADULT}_covid_suspected": flag("A", 1, 6),
        f"{CHILD}_covid_confirmed": flag("R", 7, 7),
        f"{CHILD}_covid_suspected": flag("A", 7, 7),
        **bands,
    }


def _measure_sql() -> str:
    def flag(f: str, lo: int, hi: int) -> str:
        return f"count(*) FILTER (WHERE l_returnflag = '{f}' AND l_linenumber BETWEEN {lo} AND {hi})"

    qty = "CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE)"
    parts = {
        "inpatient_beds_used": qty,
        "staffed_adult_icu_bed_occupancy": "CAST(sum(l_linenumber) AS BIGINT)",
        "currently_hospitalized": "count(*)",
        "deaths_covid": "count(*) FILTER (WHERE l_linestatus = 'F')",
        "deaths_covid_coverage1": "count(*)",
        ICU: f"CAST(floor({qty} * 40) AS BIGINT)",
        f"{ADULT}_covid_confirmed": flag("R", 1, 6),
        f"{ADULT}_covid_suspected": flag("A", 1, 6),
        f"{CHILD}_covid_confirmed": flag("R", 7, 7),
        f"{CHILD}_covid_suspected": flag("A", 7, 7),
    }
    for status, f in (("confirmed", "R"), ("suspected", "A")):
        for i, band in enumerate(BANDS):
            parts[f"{ADULT}_covid_{status}_{band}"] = f"nullif({flag(f, 2 * i + 1, 2 * i + 2)}, 0)"
    return ",\n ".join(f"{e} AS {n}" for n, e in parts.items())


def hospital_feeds(cells: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The long series, two archives of shifted days that reach beyond its end, and the current daily file."""

    def by_day(part: DataFrame, name: str, shift: int) -> DataFrame:
        return build_panel(part, ["state"], F.date_add("day", shift), name, **hospital_measures())

    def daily(part: DataFrame, shift: int) -> DataFrame:
        """A cutoff four days before the day it counts for."""
        return by_day(part, "reporting_cutoff_start", shift - 4).drop("deaths_covid", "deaths_covid_coverage")

    newest = daily(cells.where(F.col("l_returnflag") == "R"), 7).withColumn("source_rank", F.lit(0))
    older = daily(cells.where(F.col("l_returnflag") != "N"), 12).withColumn("source_rank", F.lit(1))
    return by_day(cells, "date", 0), union_by_name([newest, older]), daily(cells, 20)


# Fixed values of the test: days and states to correct
CARRY = (("NATION_3", "1998-04-11"), ("NATION_8", "1999-04-14"), ("NATION_21", "2000-01-14"))
ICU_FIX = ("NATION_7", "1999-10-08", "1999-10-29", 386)


def _late_sql(rank: int, shift: int, condition: str) -> str:
    return f"""SELECT {rank} AS source_rank, n_name AS state, CAST(l_shipdate AS DATE) + {shift} AS date, {_measure_sql()}
 FROM ships WHERE {condition} GROUP BY 2, 3"""


HOSPITAL_CTE = f"""
 ships AS (SELECT lineitem.*, n_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey),
 series AS ({_late_sql(0, 0, 'true')}),
 newest AS (SELECT max(date) AS newest FROM series),
 late AS (SELECT * REPLACE (NULL AS deaths_covid, NULL AS deaths_covid_coverage1) FROM ({_late_sql(1, 7, "l_returnflag = 'R'")}
     UNION ALL {_late_sql(2, 12, "l_returnflag <> 'N'")} UNION ALL {_late_sql(3, 20, 'true')})),
 allrows AS (SELECT *, 'No' AS admit_date_ind FROM series WHERE date <> (SELECT newest FROM newest)
     UNION ALL SELECT *, NULL FROM late WHERE date >= (SELECT newest FROM newest)),
 one AS (SELECT *, {ADULT}_covid_confirmed + {ADULT}_covid_suspected + {CHILD}_covid_suspected + {CHILD}_covid_confirmed AS new_admit
     FROM allrows QUALIFY row_number() OVER (PARTITION BY state, date ORDER BY source_rank) = 1),
 hosp0 AS (SELECT * EXCLUDE (source_rank) REPLACE (
     CASE WHEN {' OR '.join(f"(state = '{s}' AND date = DATE '{d}')" for s, d in CARRY)}
       THEN lag(currently_hospitalized) OVER w ELSE currently_hospitalized END AS currently_hospitalized,
     CASE WHEN state = '{ICU_FIX[0]}' AND date > DATE '{ICU_FIX[1]}' AND date < DATE '{ICU_FIX[2]}' THEN CAST({ICU_FIX[3]} AS DOUBLE) ELSE {ICU} END AS {ICU})
     FROM one WINDOW w AS (PARTITION BY state ORDER BY date))"""


# cases, vaccination, places ------------------------------------------------------------
def cases_deaths(cells: DataFrame) -> DataFrame:
    by_state = Panel(("state",), "date")
    panel = build_panel(
        cells, ["state"], F.col("date"), "date", n=F.sum("n"), f=F.coalesce(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("n"))), F.lit(0))
    )
    return panel.select(
        "state",
        F.date_format("date", "MM/dd/yyyy").alias("submission_date"),
        running(by_state, "n").cast("double").alias("tot_cases"),
        running(by_state, "f").cast("double").alias("tot_death"),
        F.col("n").cast("double").alias("new_case"),
        F.col("f").cast("double").alias("new_death"),
    )


CASES_CTE = """
 cd AS (SELECT n_name AS state, CAST(o_orderdate AS DATE) AS date, CAST(count(*) AS DOUBLE) AS new_case,
     CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS new_death FROM orders
     JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2),
 cases0 AS (SELECT *, sum(new_case) OVER w AS tot_cases, sum(new_death) OVER w AS tot_death FROM cd WINDOW w AS (PARTITION BY state ORDER BY date))"""


def state_vaccination(cells: DataFrame) -> DataFrame:
    return build_panel(
        cells.withColumnRenamed("state", "location"),
        ["location"],
        F.col("day"),
        "date",
        administered_dose1_recip_18plus_pop_pct=lines_where(F.col("l_returnflag") == "N").cast("double"),
        administered_dose1_recip_65plus_pop_pct=lines_where(F.col("l_returnflag") == "A").cast("double"),
        administered_dose1_recip_12plus_pop_pct=lines_where(F.col("l_linenumber") <= 3).cast("double"),
        administered_dose1_pop_pct=lines_where().cast("double"),
    )


VAX_CTE = """
 vax AS (SELECT n_name AS state, CAST(l_shipdate AS DATE) AS date,
     CAST(count(*) FILTER (WHERE l_returnflag = 'N') AS DOUBLE) AS administered_dose1_recip_18plus_pop_pct,
     CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS DOUBLE) AS administered_dose1_recip_65plus_pop_pct,
     CAST(count(*) FILTER (WHERE l_linenumber <= 3) AS DOUBLE) AS administered_dose1_recip_12plus_pop_pct,
     CAST(count(*) AS DOUBLE) AS administered_dose1_pop_pct FROM ships GROUP BY 1, 2)"""


def state_places(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Census regions (the code is the nation), populations without one region, hex positions."""
    census_codes = census(spark, sf, "n_name").withColumn("state", F.concat(F.lit("Land of "), F.col("state")))
    nation = load(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state"), "n_regionkey")
    people = load(spark, sf, "customer").groupBy("c_nationkey").agg((rows() * 1000).alias("population"))
    population = lookup(people, nation, "c_nationkey").where(F.col("n_regionkey") != 0).select("state", "population")
    hexes = nation.select("state", F.col("c_nationkey").alias("hex_x"), F.col("n_regionkey").alias("hex_y"))
    return census_codes, population, hexes


# nursing homes ---------------------------------------------------------------------
def nursing_homes(spark: SparkSession, sf: str) -> DataFrame:
    """One row per supplier and week; the week ends on a Sunday."""
    ends = F.date_format(F.next_day(F.date_sub(F.to_date("l_shipdate"), 1), "Sun"), "MM/dd/yyyy")
    lines = shipments(spark, sf, "l_quantity", "l_returnflag", "l_linestatus", "l_linenumber")
    weekly = lines.groupBy("l_suppkey", "s_nationkey", ends.alias("week_ending")).agg(
        F.nullif(rows(F.col("l_linestatus") == "O"), F.lit(0)).alias("total_number_of_occupied_beds"),
        rows(F.col("l_returnflag") == "R").alias("residents_weekly_admissions_covid_19"),
        F.nullif(rows(F.col("l_returnflag") == "A"), F.lit(0)).alias("residents_weekly_covid_19_deaths"),
        rows(F.col("l_returnflag") == "N").alias("residents_weekly_confirmed_covid_19"),
        F.sum("l_linenumber").alias("residents_total_covid_19_deaths"),
        rows().alias("residents_total_confirmed_covid_19"),
        F.max("l_linenumber").alias("residents_total_admissions_covid_19"),
    )
    homes = lookup(weekly, nations(spark, sf, "s_nationkey", "provider_state"), "s_nationkey").drop("s_nationkey", "l_suppkey")
    return staged(homes, "nursing_homes")


NURSING_CTE = """
 ships AS (SELECT lineitem.*, n_name, CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS week FROM lineitem
     JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey),
 facility AS (SELECT l_suppkey, n_name AS provider_state, week, count(*) FILTER (WHERE l_linestatus = 'O') AS beds,
     count(*) FILTER (WHERE l_returnflag = 'R') AS adm, count(*) FILTER (WHERE l_returnflag = 'A') AS dead,
     count(*) FILTER (WHERE l_returnflag = 'N') AS conf, sum(l_linenumber) AS td, count(*) AS tc, max(l_linenumber) AS ta FROM ships GROUP BY 1, 2, 3),
 weekly AS (SELECT provider_state, week, CAST(sum(beds) AS BIGINT) AS n_residents, CAST(sum(adm) AS BIGINT) AS new_hosp_covid,
     CAST(sum(dead) AS BIGINT) AS new_covid_deaths, CAST(sum(conf) AS BIGINT) AS new_covid_cases, CAST(sum(td) AS BIGINT) AS total_covid_deaths,
     CAST(sum(tc) AS BIGINT) AS total_covid_cases, CAST(sum(ta) AS BIGINT) AS total_covid_hosp FROM facility GROUP BY 1, 2)"""
