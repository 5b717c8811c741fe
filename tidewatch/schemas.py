"""Declared types of every feed: column name (after cleaning) to type.

Dates arrive as text and are parsed by the flow that knows the feed's format.
Columns a feed may lack are read as missing.
"""

from __future__ import annotations

TEXT, NUM, INT = "string", "double", "long"

COUNTY_COUNTERS = {"date": TEXT, "county": TEXT, "state": TEXT, "fips": INT, "cases": NUM, "deaths": NUM}
CENSUS_REGIONS = {"state": TEXT, "state_code": TEXT, "region": TEXT, "division": TEXT}
COUNTY_POPULATION = {
    "sumlev": TEXT, "region": TEXT, "division": TEXT, "state": TEXT, "county": TEXT,
    "stname": TEXT, "ctyname": TEXT, "popestimate2019": TEXT,
}
METRO_CROSSWALK = {"fipscounty": TEXT, "cbsaname": TEXT, "msaname": TEXT}
DENSITY = {
    "id": TEXT, "id2": TEXT, "geography": TEXT, "target_geo_id": TEXT, "target_geo_id2": TEXT,
    "geographic_area": TEXT, "geographic_area_2": TEXT, "population": TEXT, "housing_units": TEXT,
    "area_in_square_miles_total_area": TEXT,
}
ELECTION_2016 = {"combined_fips": INT, "votes_dem": NUM, "votes_gop": NUM}
ELECTION_2020 = {"race": TEXT, "fips5": INT, "place": TEXT, "lname": TEXT, "votes": NUM}
COUNTY_VACCINATION = {"fips": TEXT, "series_complete_pop_pct": TEXT}
TEST_RESULTS = {
    "state": TEXT, "date": TEXT, "overall_outcome": TEXT, "new_results_reported": NUM, "total_results_reported": NUM,
}
TEST_HISTORY = {"state": TEXT, "total_tests": NUM, "total_pos_tests": NUM, "date": TEXT}
ADMISSIONS = ("adult_covid_confirmed", "adult_covid_suspected", "pediatric_covid_confirmed", "pediatric_covid_suspected")
HOSPITAL_SERIES = {
    "state": TEXT, "date": TEXT, "inpatient_beds_used": NUM, "deaths_covid": NUM, "deaths_covid_coverage": NUM,
    "staffed_adult_icu_bed_occupancy": NUM, "inpatient_beds_used_covid": NUM,
    "staffed_icu_adult_patients_confirmed_and_suspected_covid": NUM,
    **{f"previous_day_admission_{a}": NUM for a in ADMISSIONS},
}
HOSPITAL_DAILY = {
    **{c: t for c, t in HOSPITAL_SERIES.items() if c not in ("date", "deaths_covid", "deaths_covid_coverage")},
    "reporting_cutoff_start": TEXT,
}
ARCHIVE_MANIFEST = {"update_date": TEXT, "archive_link": TEXT}
CASES_DEATHS = {
    "state": TEXT, "submission_date": TEXT, "tot_cases": NUM, "tot_death": NUM, "new_case": NUM, "new_death": NUM,
}
STATE_VACCINATION = {
    "location": TEXT, "date": TEXT,
    "administered_dose1_recip_18plus_pop_pct": NUM, "administered_dose1_recip_65plus_pop_pct": NUM,
    "administered_dose1_recip_12plus_pop_pct": NUM, "administered_dose1_pop_pct": NUM,
}
STATE_POPULATION = {"state": TEXT, "population": INT}
NURSING_HOMES = {
    "provider_state": TEXT, "week_ending": TEXT, "total_number_of_occupied_beds": NUM,
    "residents_weekly_admissions_covid_19": NUM, "residents_weekly_covid_19_deaths": NUM,
    "residents_weekly_confirmed_covid_19": NUM, "residents_total_covid_19_deaths": NUM,
    "residents_total_confirmed_covid_19": NUM, "residents_total_admissions_covid_19": NUM,
}
STATE_TRACKING = {
    "date": INT, "state": TEXT, "fips": TEXT, "negative": NUM, "hospitalizedIncrease": NUM, "hospitalizedCurrently": NUM,
    "totalTestResultsIncrease": NUM, "positiveIncrease": NUM, "negativeIncrease": NUM, "deathIncrease": NUM,
    "totalTestResults": NUM, "death": NUM, "inIcuCumulative": NUM, "inIcuCurrently": NUM, "onVentilatorCurrently": NUM,
    "onVentilatorCumulative": NUM, "positiveCasesViral": NUM, "totalTestEncountersViral": NUM,
}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in columns.items())
