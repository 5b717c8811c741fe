"""Results depend on them, so they are stated as they are."""

# Place overrides -------------------------------------------
NEW_YORK_CITY = "New York City"
NYC_METRO = "NEW YORK-NEWARK, NY-NJ-PA"
NYC_POPULATION = 8491000
NYC_RESULT_2016 = "Blue"
NYC_STATE_CODE = "NYC"
NYC_REGION = "Northeast"

# Windows and thresholds --------------------------------------
MIN_COUNTY_ROWS = 8
MIN_REPORTING = 5
REPORTING_OFFSET_DAYS = 4
ICU_CHANGE_LIMIT = 500

# Election 2020 -------------------------------------------------
RACE = "President"
PARTY_A, PARTY_B = "Biden", "Trump"
MARGIN = (0.45, 0.55)
MARGIN_LABELS = ("Trump +10 or more", "Biden +/- 10", "Biden + 10 or more")
STATES_2020 = [
    "AZ", "CA", "CO", "CT", "DE", "GA", "HI", "IL", "ME", "MD", "MA", "MI", "MN", "NV", "NH", "NJ", "NM", "NY", "OR",
    "PA", "RI", "VT", "VA", "WA", "WI",
]
NO_VOTE = "PR"

# Vaccination buckets, by lower bound -----------------------------
VACCINATION_BUCKETS = [(None, "0-50"), (50, "50-60"), (60, "60-70"), (70, "70-100")]

# Hospital corrections ------------------------------------------
# days on which the previous row's value is used instead
CARRY_DAYS = [("TX", "2021-04-11"), ("MA", "2021-04-14"), ("CA", "2021-01-14")]
# state, after, before (both exclusive), value
ICU_RANGE = ("IL", "2021-10-08", "2021-10-29", 386)

# Share of the new variant, by first day --------------------------
VARIANT_STEPS = [
    ("2021-08-01", 0.0),
    ("2021-11-28", 0.006),
    ("2021-12-05", 0.08),
    ("2021-12-12", 0.379),
    ("2021-12-19", 0.77),
    ("2021-12-26", 0.889),
    ("2022-01-02", 0.962),
    ("2022-01-09", 0.978),
    ("2022-01-16", 0.998),
    ("2022-01-23", 0.999),
]

# Peak-indexed series ----------------------------------------------
INDEX_FROM = "2020-04-01"
REGIME_DAY = "2021-12-01"
INDEX_SHOWN_AFTER_YEAR = 2020
