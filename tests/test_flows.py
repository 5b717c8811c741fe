"""The published panels from a landing folder of hand-made files."""

from __future__ import annotations

import csv
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import county, federal, hospital, run, testing, trend
from tidewatch.sources.extracts import current_version
from tidewatch.schemas import ADMISSIONS, TEST_HISTORY
from tidewatch.sources.delimited import read_feed
from tidewatch.sources.landing import Landing

DAYS = [dt.date(2021, 10, 1) + dt.timedelta(days=i) for i in range(40)]
STATES = ["NY", "TX", "CA", "MA", "IL", "PR"]
PREFIX = "previous_day_admission_"


def write(folder, name, header, rows, encoding="utf-8"):
    with open(folder / name, "w", newline="", encoding=encoding) as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def county_files(folder):
    counters = []
    for i, d in enumerate(DAYS):
        counters.append([d, "Dona", "New Mexico", "35013", 10 * (i + 1), i])
        counters.append([d, "New York City", "New York", "", 100 * (i + 1), 2 * i])
        counters.append([d, "Autauga", "Alabama", "1001", 5 * (i + 1), 0])
    counters += [counters[0], counters[0]]
    counters += [[d, "Short", "Alabama", "1003", 1, 0] for d in DAYS[:7]]
    write(folder, "county_counters.csv", ["date", "county", "state", "fips", "cases", "deaths"], counters)
    write(folder, "census_regions.csv", ["State", "State Code", "Region", "Division"], [["New York", "NY", "Northeast", "M"], ["Alabama", "AL", "South", "E"], ["Texas", "TX", "South", "W"]])
    write(
        folder, "county_population.csv", ["SUMLEV", "REGION", "DIVISION", "STATE", "COUNTY", "STNAME", "CTYNAME", "POPESTIMATE2019"],
        [["50", "3", "6", "01", "001", "Alabama", "Autauga County", "1000"], ["50", "4", "8", "35", "013", "New Mexico", "Doña Ana County", "0"]],
        "latin-1",
    )
    write(folder, "metro_crosswalk.csv", ["fipscounty", "cbsaname", "msaname"], [["01001", "Montgomery", "MONTGOMERY, AL"]] * 2)
    write(
        folder, "density.csv",
        ["GEO.id", "GEO.id2", "GEO.d", "GCT.t", "GCT.target2", "GCT.d", "GCT.d2", "HD01", "HD02", "SUBHD"],
        [["Id", "Id2", "Geography", "Target Geo Id", "Target Geo Id2", "Geographic area", "Geographic area", "Population", "Housing units", "Area"],
         ["g", "1", "US", "t", "01001", "a", "Autauga", "54571", "1", "594.44"], ["g", "1", "US", "t", "", "a", "US", "9", "1", "3"]],
        "latin-1",
    )
    write(folder, "election_2016.csv", ["combined_fips", "votes_dem", "votes_gop"], [["1001", "5936.0", "18172.0"], ["35013", "9", "1"]])
    write(
        folder, "election_2020.csv", ["race", "fips5", "place", "lname", "votes"],
        [["President", "01001", "A", "Biden", "40"], ["President", "01001", "A", "Biden", "6"], ["President", "01001", "A", "Trump", "54"],
         ["President", "", "US", "Trump", "99"], ["Senate", "01001", "A", "Biden", "7"], ["President", "35013", "D", "Biden", "3"]],
    )
    (folder / "county_vaccination.json").write_text(
        json.dumps({"runid": 1, "vaccination_county_condensed_data": [
            {"fips": "01001", "series_complete_pop_pct": "50.0"}, {"fips": "01001", "series_complete_pop_pct": "12"},
            {"fips": "UNK", "series_complete_pop_pct": "1"}, {"fips": "35013", "series_complete_pop_pct": "n/a"}]})
    )


def hospital_row(state, i, plus=0):
    beds = [1000 + i, 50, 5, 200 + i, 300 + 10 * i + plus, 4000 if state == "IL" and i < 20 else 400]
    bands = [1, 2, 3, 4, 6 if i else "", 5]
    return [state, *beds, *bands]


HOSPITAL = ["state", "date", "inpatient_beds_used", "deaths_covid", "deaths_covid_coverage", "staffed_adult_icu_bed_occupancy",
            "inpatient_beds_used_covid", hospital.ICU, *[PREFIX + a for a in ADMISSIONS], PREFIX + "adult_covid_confirmed_60-69", PREFIX + "adult_covid_confirmed_60-69_coverage"]


def federal_files(folder):
    tests, cases, beds = [], [], []
    for i, d in enumerate(DAYS):
        for j, s in enumerate(STATES):
            if d == DAYS[-1] and j > 2:
                continue
            for o, n in (("Positive", 5 + j), ("Negative", 95 - j), ("Inconclusive", 1)):
                if not (s == "TX" and i == 5):
                    tests.append([s, d.strftime("%Y/%m/%d"), o, n, n * (i + 1)])
            cases.append([d.strftime("%m/%d/%Y"), s, 10 * (i + 1) * (j + 1), i, 10 * (j + 1), 1 if i else 0])
        for s in STATES:
            r = hospital_row(s, i)
            beds.append([r[0], d.strftime("%Y/%m/%d"), *r[1:]])
    cases.append(cases[0])
    write(folder, "test_results.csv", ["state", "date", "overall_outcome", "new_results_reported", "total_results_reported"], tests)
    write(folder, "cases_deaths.csv", ["submission_date", "state", "tot_cases", "tot_death", "new_case", "new_death"], cases)
    write(folder, "hospital_series.csv", HOSPITAL, beds)
    daily = ["reporting_cutoff_start" if c == "date" else c for c in HOSPITAL if not c.startswith("deaths_covid")]

    def late(name, first, plus, states):
        rows = []
        for n in range(3):
            cutoff = DAYS[-1] + dt.timedelta(days=first + n - 4)
            for s in states:
                r = hospital_row(s, 40 + n, plus)
                rows.append([s, cutoff, r[1], *r[4:]])
        write(folder, name, daily, rows)

    late("arch_old.csv", -1, 1000, STATES)
    late("arch_new.csv", 0, 2000, ["NY"])
    late("hospital_daily.csv", 1, 3000, STATES)
    write(folder, "archive_manifest.csv", ["Update Date", "Archive Link"], [["11/01/2021 09:00:00 AM", "arch_old.csv"], ["11/05/2021 09:00:00 AM", "arch_new.csv"]])
    write(
        folder, "state_vaccination.csv",
        ["location", "date", *[f"administered_dose1_recip_{a}plus_pop_pct" for a in (18, 65, 12)], "administered_dose1_pop_pct"],
        [["NY", str(DAYS[3]), "70.5", "90", "", "60"]],
    )
    write(folder, "state_population.csv", ["state", "state_name", "population"], [["NY", "New York", "19"], ["TX", "Texas", "28"]])
    write(folder, "hex_grid.csv", ["state", "Hex X", "Hex Y"], [["NY", "9", "2"]])


def other_files(folder):
    write(
        folder, "nursing_homes.csv",
        ["Week Ending", "Provider State", "Total Number of Occupied Beds", "Residents Weekly Admissions COVID-19", "Residents Weekly COVID-19 Deaths",
         "Residents Weekly Confirmed COVID-19", "Residents Total COVID-19 Deaths", "Residents Total Confirmed COVID-19", "Residents Total Admissions COVID-19"],
        [["10/03/2021", "NY", "50", "1", "2", "3", "4", "5", "6"], ["10/03/2021", "NY", "", "1", "", "3", "4", "5", "6"],
         ["10/10/2021", "NY", "7", "1", "8", "3", "4", "5", "6"], ["10/10/2021", "TX", "", "", "", "", "", "", ""]],
    )
    rows = [{"date": int(d.strftime("%Y%m%d")), "state": s, "positiveIncrease": 10 * (i % 9), "totalTestResultsIncrease": 100, "deathIncrease": i % 4,
             "hospitalizedCurrently": 7 * i} for i, d in enumerate(DAYS) for s in ("NY", "TX")]
    (folder / "state_tracking.json").write_text(json.dumps(rows))


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    county_files(folder)
    federal_files(folder)
    other_files(folder)
    return Landing(spark, str(folder))


@pytest.fixture(scope="module")
def out(tmp_path_factory):
    return str(tmp_path_factory.mktemp("out"))


@pytest.fixture(scope="module")
def panels(landing, out):
    made = run.extracts(landing, out, {"county", "strict", "trend", "federal", "ages", "nursing"})
    return {name: [r.asDict() for r in df.collect()] for name, df in made.items()}


def pick(rows, **want):
    found = [r for r in rows if all(r[k] == v for k, v in want.items())]
    assert len(found) == 1, (want, len(found))
    return found[0]


def test_county_names_overrides_and_history(panels):
    rows = panels["county_panel"]
    assert len(rows) == 3 * 40 and {r["ctyname"] for r in rows} == {"Doña Ana County", "New York City", "Autauga County"}
    city = pick(rows, ctyname="New York City", date=DAYS[10])
    assert (city["pop"], city["msaname"], city["result2016"], city["region"]) == (8491000.0, "NEW YORK-NEWARK, NY-NJ-PA", "Blue", "Northeast")
    assert city["fips"] is None and city["cbsaname"] is None and city["caseper1k"] == 1100 / 8491000.0 * 1000
    assert pick(rows, ctyname="Doña Ana County", date=DAYS[0])["caseper1k"] is None


def test_county_changes_means_and_growth(panels):
    rows = panels["county_panel"]
    first, last = pick(rows, fips=1001, date=DAYS[0]), pick(rows, fips=1001, date=DAYS[-1])
    assert (first["new_cases"], first["cases_prior"], first["case_yest"], first["n_dates"]) == (5.0, None, None, 40)
    assert (last["new_cases"], last["pos_7d_avg"], last["pos_incr_week"], last["case_7d_15"]) == (5.0, 5.0, 0.0, 5.0)
    assert last["deaths_incr_week"] is None
    assert (first["recent_cases"], first["max_date"], first["max_date_ind"], last["max_date_ind"]) == (5.0, DAYS[-1], "No", "Yes")
    assert first["weekday"] == "Friday" and first["max_weekday"] == "Tuesday"


def test_county_elections_density_vaccination(panels):
    row = pick(panels["county_panel"], fips=1001, date=DAYS[0])
    assert (row["Biden"], row["Trump"], row["total_votes"], row["biden_pct"], row["biden_pct_bucket"]) == (46.0, 54.0, 100.0, 0.46, "Biden +/- 10")
    assert (row["result2016"], row["full_vax_bin"], row["series_complete_pop_pct"]) == ("Red", "50-60", 50.0)
    assert row["pop_density"] == 54571 / 594.44 and row["msaname"] == "MONTGOMERY, AL"
    other = pick(panels["county_panel"], fips=35013, date=DAYS[0])
    assert (other["Biden"], other["Trump"], other["total_votes"], other["biden_pct_bucket"], other["full_vax_bin"]) == (3.0, None, None, None, None)


def test_strict_county_panel(panels):
    rows = panels["county_panel_strict"]
    assert len(rows) == 3 * 40 + 7
    assert pick(rows, fips="01001", date=DAYS[5])["pos_7d_avg"] is None and pick(rows, fips="01001", date=DAYS[6])["pos_7d_avg"] == 5.0
    short = pick(rows, ctyname="Short", date=DAYS[0])
    assert (short["max_date"], short["fips"], short["stname"]) == (DAYS[6], "01003", "Alabama")
    city = pick(rows, ctyname="New York City", date=DAYS[0])
    assert (city["fips"], city["max_date"], city["max_date_ind"], city["result2016"]) == (None, None, None, "Blue")


def test_state_trend(panels):
    row = pick(panels["state_trend"], state="NY", date=DAYS[20])
    assert row["totalpos_7d"] == sum(10 * (i % 9) for i in range(14, 21)) and row["pct_pos_7d"] == row["totalpos_7d"] / 700
    assert (row["change_hosp"], row["lstwk_hosp"], row["pct_positive"]) == (7.0, 91.0, 0.2)
    best = max(r["death_7d_avg"] for r in panels["state_trend"] if r["state"] == "NY" and r["death_7d_avg"] is not None)
    assert row["max_deaths"] == best
    assert row["days_since_peak_death"] == (row["date"] - row["max_death_date"]).days


def test_federal_tests(panels):
    rows = panels["federal_state"]
    filled = pick(rows, state="TX", date=DAYS[5])
    assert (filled["new_tests"], filled["new_tests2"], filled["pct_pos"]) == (0.0, None, 0.0)
    assert filled["new_tests_7d_avg"] == pytest.approx(500 / 6)
    last = pick(rows, state="NY", date=DAYS[-1])
    assert (last["test_date"], last["new_tests"], last["new_tests_7d_avg"]) == (DAYS[-2], None, None)
    assert pick(rows, state="NY", date=DAYS[20])["new_pos_tests_7d_avg_2wk"] == 5.0


def test_federal_cases(panels):
    rows = panels["federal_state"]
    day = pick(rows, state="TX", date=DAYS[30])
    assert (day["new_case_tot"], day["new_case_7d_avg"], day["case_7d_avg_4_wks"], day["case_death_date"]) == (20.0, 20.0, 20.0, DAYS[-2])
    first = pick(rows, state="TX", date=DAYS[0])
    assert (first["new_case_tot"], first["new_case_tot_7d_avg_cdc"]) == (None, None)
    # the newest day has too few states, so the last known value stands in
    assert pick(rows, state="NY", date=DAYS[-1])["new_case"] is None
    assert pick(rows, state="NY", date=DAYS[-1])["last_case_7d"] == 10.0


def test_hospital_revisions_and_corrections(panels):
    rows = panels["federal_state"]
    newest = DAYS[-1]
    assert pick(rows, state="NY", date=newest)["currently_hospitalized"] == 2700.0
    assert pick(rows, state="TX", date=newest)["currently_hospitalized"] == 1710.0
    assert pick(rows, state="TX", date=newest + dt.timedelta(days=2))["currently_hospitalized"] == 3710.0
    assert pick(rows, state="TX", date=newest + dt.timedelta(days=3))["currently_hospitalized"] == 3720.0
    assert pick(rows, state="IL", date=dt.date(2021, 10, 9))[hospital.ICU] == 386.0
    assert pick(rows, state="IL", date=dt.date(2021, 10, 8))[hospital.ICU] == 4000.0
    assert pick(rows, state="IL", date=dt.date(2021, 10, 9))["icu_change"] == -500.0
    day = pick(rows, state="NY", date=DAYS[12])
    assert (day["new_admit"], day["new_admit_7d_avg"], day["hosp_change"], day["currently_hospitalized_1wk"]) == (10.0, 10.0, 10.0, 350.0)
    assert day["deaths_covid_coverage1"] == 5.0 and not any(c.endswith("_coverage") for c in day)


def test_federal_places_flags_and_variant(panels):
    rows = panels["federal_state"]
    day = pick(rows, state="NY", date=DAYS[3])
    assert (day["region"], day["state_name"], day["population"], day["hex_x"], day["elect20"]) == ("Northeast", "New York", 19, "9", "Biden")
    assert (day["administered_dose1_pop_pct"], day["display_date"], day["month_num"]) == (60.0, "2021-Oct-4", 10)
    assert (pick(rows, state="PR", date=DAYS[3])["elect20"], pick(rows, state="TX", date=DAYS[3])["elect20"]) == ("NA", "Trump")
    assert pick(rows, state="MA", date=DAYS[3])["population"] == 0
    last = max(r["date"] for r in rows)
    assert last == DAYS[-1] + dt.timedelta(days=3)
    assert {r["max_date_ind"] for r in rows if r["date"] == last} == {"Yes"}
    assert (day["omi_pct"], day["omi_cases"], day["delta_cases"]) == (0.0, 0.0, 10.0)


def test_ages(panels):
    rows = panels["admissions_ages"]
    assert {(r["age_group"], r["status"]) for r in rows} == {("60 to 69", "confirmed"), ("pediatric", "confirmed"), ("pediatric", "suspected")}
    assert len({(r["state"], r["age_group"], r["status"], r["date"]) for r in rows}) == len(rows)
    assert DAYS[0] not in {r["date"] for r in rows}
    assert pick(rows, state="NY", age_group="pediatric", status="suspected", date=DAYS[9])["adm_7d_avg"] == 4.0


def test_nursing(panels):
    week = pick(panels["nursing_weekly"], provider_state="NY", week_ending="10/03/2021")
    assert (week["n_residents"], week["new_covid_deaths"], week["total_covid_hosp"], week["max_date"]) == (50.0, 2.0, 12.0, dt.date(2021, 10, 10))
    assert pick(panels["nursing_weekly"], provider_state="TX")["n_residents"] == 0.0
    rows = panels["nursing_and_all_deaths"]
    first, second = pick(rows, state="NY", n=1), pick(rows, state="NY", n=2)
    assert (first["new_deaths_nh"], first["new_deaths_all"]) == (None, None)
    assert (second["new_deaths_nh"], second["new_deaths_all"], second["tot_death"]) == (8.0, 7.0, 9.0)


def test_a_second_run_of_the_day_adds_nothing(landing, out, panels):
    first = run.extracts(landing, out, {"federal"})
    run.keep_snapshots(first["snapshots"], f"{out}/snapshots")
    made = run.extracts(landing, out, {"federal"})
    run.keep_snapshots(made["snapshots"], f"{out}/snapshots")
    assert run.stored_snapshots(landing.spark, f"{out}/snapshots").count() == first["snapshots"].count()
    again = made["federal_state"]
    assert again.where(F.col("new_reported_tests").isNotNull()).count() == 0
    assert again.count() == len(panels["federal_state"])


def test_reports_and_imported_history(landing, tmp_path, spark):
    write(tmp_path, "test_history.csv", ["state", "total_tests", "total_pos_tests", "date"], [["NY", "100", "5", "2021-09-30"]])
    landing.opened["test_history"] = read_feed(spark, str(tmp_path / "test_history.csv"), TEST_HISTORY)
    made = run.extracts(landing, str(tmp_path), {"county", "federal", "reports", "history"})
    fresh = {r["feed"]: r["last_date"] for r in made["freshness"].collect()}
    assert fresh == {"hospital": DAYS[-1] + dt.timedelta(days=3), "cases": DAYS[-2], "tests": DAYS[-2]}
    checks = {r["check"]: (r["n_rows"], r["n_distinct"]) for r in made["uniqueness"].collect()}
    assert checks["county counters"] == (129, 127) and checks["metro crosswalk"] == (2, 1) and checks["election 2020"] == (6, 4)
    assert {r["stname"]: r["n"] for r in made["rows_by_state"].collect()} == {"Alabama": 40, "New Mexico": 40, "New York": 40}
    week = made["hospital_last_week"].orderBy("day").collect()
    assert len(week) == 8 and week[0]["change"] is None
    ny = made["federal_state"].where("state = 'NY' AND new_reported_tests IS NOT NULL").collect()
    assert [(r["date"], r["new_reported_tests"]) for r in ny] == [(DAYS[-2], 39 * 100.0 - 100)]
    # what was imported once stays: the next runs need not ask for it
    run.keep_snapshots(made["snapshots"], f"{tmp_path}/snapshots")
    for _ in range(2):
        later = run.extracts(landing, str(tmp_path), {"federal"})
        run.keep_snapshots(later["snapshots"], f"{tmp_path}/snapshots")
        assert later["federal_state"].where("state = 'NY' AND new_reported_tests IS NOT NULL").count() == 1


def test_ages_alone_publish_no_panel(landing, tmp_path):
    assert set(run.extracts(landing, str(tmp_path), {"ages"})) == {"admissions_ages"}
    assert not (tmp_path / "snapshots").exists()


def test_publishing_writes_a_table_and_an_extract(spark, frame, tmp_path):
    df = frame([("NY", "2021-12-31", 1), ("NY", "2022-01-01", 2)], "state string, date date, x int")
    run.publish(df, str(tmp_path), "p")
    assert spark.read.parquet(current_version(spark, str(tmp_path / "tables" / "p"))).where("year_part = 2022").count() == 1
    back = read_feed(spark, current_version(spark, str(tmp_path / "p")), {"state": "string", "date": "date", "x": "int"})
    before = current_version(spark, str(tmp_path / "p"))
    with pytest.raises(Exception):
        run.publish(df.withColumn("x", F.raise_error(F.lit("half way"))), str(tmp_path), "p")
    assert current_version(spark, str(tmp_path / "p")) == before
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_command_line(landing, spark, tmp_path):
    run.main(landing.folder, str(tmp_path), {"trend", "nursing"})
    assert spark.read.parquet(current_version(spark, str(tmp_path / "tables" / "state_trend"))).count() == 80
    assert read_feed(spark, current_version(spark, str(tmp_path / "nursing_weekly")), {"n_residents": "double"}).count() == 3
    assert (tmp_path / "nursing_and_all_deaths").is_dir()


def test_pediatric_totals_do_not_count_beside_their_parts(frame):
    names = [f"{PREFIX}pediatric_covid_confirmed{x}" for x in ("", "_0_4", "_5_11")]
    df = frame([("NY", "2021-01-01", 10, 4, 6)], f"state string, date date, {', '.join(f'{n} int' for n in names)}")
    assert hospital.band_columns(df) == names[1:]
    got = hospital.admissions_by_age(df, names[1]).first()
    assert (got["age_group"], got["prev_day_admissions"]) == ("pediatric", 10)


def test_history_changes_and_repeats(frame):
    history = frame([("NY", 10, 1, "2021-01-01")], "state string, total_tests int, total_pos_tests int, date date")
    today = frame([("NY", 25, 4, "2021-01-02"), ("NY", 10, 1, "2021-01-01")], "state string, total_tests int, total_pos_tests int, date date")
    got = testing.history_changes(testing.accumulate(history, today)).orderBy("date").collect()
    assert [(r["new_reported_tests"], r["new_reported_pos_tests"]) for r in got] == [(None, None), (15, 3)]
    assert testing.accumulate(None, today).count() == 2


def test_trend_without_values_has_no_peak(frame):
    df = frame([(20210101, "GU", None)], "date long, state string, deathIncrease double")
    for c in ("positiveIncrease", "totalTestResultsIncrease", "hospitalizedCurrently"):
        df = df.withColumn(c, F.lit(None).cast("double"))
    row = trend.state_trend(df).first()
    assert (row["max_deaths"], row["max_death_date"], row["days_since_peak_death"]) == (None, None, None)


def test_votes_all_missing_count_zero(frame):
    df = frame([("President", 1, "Biden", None), ("President", 1, "Trump", 3.0)], "race string, fips5 long, lname string, votes double")
    row = county.result_2020(df).first()
    assert (row["Biden"], row["Trump"], row["total_votes"], row["biden_pct"]) == (0.0, 3.0, 3.0, 0.0)


def test_variant_steps(frame):
    days = ["2021-07-31", "2021-08-01", "2021-11-27", "2021-11-28", "2021-12-19", "2022-01-22", "2022-01-23"]
    df = frame([(d, 100.0) for d in days], "date date, new_case_7d_avg double")
    assert [r["omi_pct"] for r in federal.with_variant(df).orderBy("date").collect()] == [None, 0.0, 0.0, 0.006, 0.77, 0.998, 0.999]


def test_the_refreshed_series_follows_late_archives(spark, tmp_path):
    """Each feed after the other gives the panel that all of them give at once; a late day changes what looks back at it."""
    from tidewatch.operators.dedupe import union_by_name
    from tidewatch.plans import hospital
    from tidewatch.registry import feeds

    batches = hospital.version_rows(*feeds.hospital_feeds(feeds.line_cells(spark, "/root/testdata/sf0.001")))
    like = union_by_name(batches).schema
    corrections = {"carry": hospital.carry_table(spark, feeds.CARRY), "ranges": hospital.range_table(spark, (feeds.ICU_FIX,))}
    panel = hospital.refreshed_series(spark, str(tmp_path / "series"), like)
    assert panel.reach == 13
    for rows in batches:
        done = panel.apply(hospital.series_batch(rows, like, **corrections))
    got = hospital.read_series(panel, like)
    want = hospital.hospital_panel(*feeds.hospital_feeds(feeds.line_cells(spark, "/root/testdata/sf0.001")), **corrections)
    assert set(got.columns) == set(want.columns)
    key = lambda df: sorted(map(str, df.select(*sorted(want.columns)).collect()))
    assert key(got) == key(want)
    years = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr("count(distinct year(l_shipdate)) n").first()["n"]
    assert 0 < len(done.written) <= len(done.read) < years
