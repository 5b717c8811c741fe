"""Hospital series: late revisions, corrections, changes and means; admissions by age band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from ..functions.dates import is_latest, parse_date
from ..functions.missing import add_all, clip
from ..functions.names import drop_ending, starting
from ..operators.dedupe import first_per_key, union_by_name
from ..operators.enrich import lookup
from ..operators.filters import drop_latest, latest_of
from ..operators.panel import Panel, carry_previous
from ..operators.reshape import lengthen
from ..schemas import ADMISSIONS
from ..streaming.refresh import Derived, RefreshedPanel
from . import constants as k

PANEL = Panel(("state",), "date")
KEY = ["state", "date"]
ADULT, CHILD = "previous_day_admission_adult", "previous_day_admission_pediatric"
PARTS = [f"previous_day_admission_{a}" for a in ADMISSIONS]
ICU = "staffed_icu_adult_patients_confirmed_and_suspected_covid"
OCCUPANCY = ["inpatient_beds_used", "staffed_adult_icu_bed_occupancy"]


def _series(raw: DataFrame, day: Column, *more: Column | str) -> DataFrame:
    bands = [c for c in starting(raw, ADULT, CHILD) if c not in PARTS]
    kept = raw.select(
        "state", day.alias("date"), *OCCUPANCY, F.col("inpatient_beds_used_covid").alias("currently_hospitalized"), ICU, *PARTS, *bands, *more
    )
    return drop_ending(kept, "coverage").withColumn("new_admit", add_all(*PARTS))


def _day(raw: DataFrame, name: str) -> Column:
    return parse_date(name) if dict(raw.dtypes)[name] == "string" else F.col(name)


def history_series(raw: DataFrame) -> tuple[DataFrame, Column]:
    """The long series without its newest, incomplete day; and that day."""
    day = _day(raw, "date")
    newest = latest_of(raw.select(day.alias("date")), "date")
    series = _series(raw, day, "deaths_covid", F.col("deaths_covid_coverage").alias("deaths_covid_coverage1"))
    return drop_latest(series.withColumn("admit_date_ind", is_latest("date", newest)), "date", newest), newest


def late_revisions(raw: DataFrame, since: Column) -> DataFrame:
    """Archived daily files, dated by their cutoff, from the series' newest day on."""
    day = F.date_add(_day(raw, "reporting_cutoff_start"), k.REPORTING_OFFSET_DAYS)
    return _series(raw, day, "source_rank").where(F.col("date") >= since)


TIES = ("currently_hospitalized", "new_admit", *OCCUPANCY, ICU)


def version_rows(series: DataFrame, archives: DataFrame, daily: DataFrame) -> list[DataFrame]:
    """Rows of the long series, of the archives newest first, and of the current daily file, each with its rank."""
    history, newest = history_series(series)
    last = F.lit(1_000_000)
    return [
        history.withColumn("source_rank", F.lit(0)),
        late_revisions(archives.withColumn("source_rank", F.col("source_rank") + 1), newest),
        late_revisions(daily.withColumn("source_rank", last), newest),
    ]


def merged_series(series: DataFrame, archives: DataFrame, daily: DataFrame) -> DataFrame:
    """Long series first, then the archives newest first, then the current daily file."""
    rows = union_by_name(version_rows(series, archives, daily))
    return first_per_key(rows, KEY, [F.col("source_rank").asc(), *[F.col(c).desc_nulls_last() for c in TIES]]).drop("source_rank")


def carry_table(spark: SparkSession, days=tuple(k.CARRY_DAYS)) -> DataFrame:
    """(state, date): days that take the previous row's count."""
    return spark.createDataFrame([(s, str(d)) for s, d in days], "state string, date string").select("state", F.to_date("date").alias("date"))


def range_table(spark: SparkSession, ranges=(k.ICU_RANGE,)) -> DataFrame:
    """(state, lo, hi, value): days from lo to before hi that take a constant; given as the days before and after."""
    rows = [(s, str(after), str(before), float(v)) for s, after, before, v in ranges]
    table = spark.createDataFrame(rows, "state string, lo string, hi string, value double")
    return table.select("state", F.date_add(F.to_date("lo"), 1).alias("lo"), F.to_date("hi").alias("hi"), "value")


def with_corrections(df: DataFrame, carry: DataFrame | None = None, ranges: DataFrame | None = None) -> DataFrame:
    """df with _listed, whether its day takes the previous row's count, and _fixed, the constant in force.

    Both are tables and are joined by (state, date): any number of corrections costs one join each.
    Ranges are laid out as days, inside the days of the data; where they overlap the highest value counts.
    """
    spark = df.sparkSession
    carry = (carry_table(spark) if carry is None else carry).select(*KEY).distinct().withColumn("_listed", F.lit(True))
    ranges = range_table(spark) if ranges is None else ranges
    day = F.explode(F.when(F.col("lo") < F.col("hi"), F.sequence("lo", F.date_sub("hi", 1))))
    fixed = ranges.withColumn("date", day).groupBy(*KEY).agg(F.max("value").alias("_fixed"))
    return lookup(lookup(df, carry, KEY, unique=True), fixed, KEY, unique=True)


def corrected(df: DataFrame, carry: DataFrame | None = None, ranges: DataFrame | None = None) -> DataFrame:
    """Listed days take the previous row's count; ranges of days of a state take a constant."""
    both = with_corrections(df, carry, ranges)
    both = both.withColumn("currently_hospitalized", carry_previous(PANEL, "currently_hospitalized", F.col("_listed").isNotNull()))
    return both.withColumn(ICU, F.coalesce("_fixed", ICU)).drop("_listed", "_fixed")


#: Columns of the changes: expression, rows back, columns among them that it is made of.
CHANGES = {
    "hosp_change": Derived(lambda p: p.delta("currently_hospitalized"), 1, ("currently_hospitalized",)),
    "total_icu_change": Derived(lambda p: p.delta("staffed_adult_icu_bed_occupancy"), 1),
    "total_hosp_change": Derived(lambda p: p.delta("inpatient_beds_used"), 1),
    "icu_change": Derived(lambda p: clip(p.delta(ICU), -k.ICU_CHANGE_LIMIT, k.ICU_CHANGE_LIMIT), 1, (ICU,)),
    "new_admit_7d_avg": Derived(lambda p: p.rolling_mean("new_admit"), 6),
    "currently_hospitalized_1wk": Derived(lambda p: p.lag("currently_hospitalized", 7), 7, ("currently_hospitalized",)),
    "adm_1_wk": Derived(lambda p: p.lag("new_admit", 7), 7),
    "new_admit_avg_1wk": Derived(lambda p: p.lag("new_admit_7d_avg", 7), 7, ("new_admit_7d_avg",)),
}


def hospital_changes(df: DataFrame) -> DataFrame:
    first = {name: d.column(PANEL) for name, d in CHANGES.items() if "new_admit_7d_avg" not in d.of}
    later = {name: d.column(PANEL) for name, d in CHANGES.items() if name not in first}
    return df.withColumns(first).withColumns(later)


def hospital_panel(series: DataFrame, archives: DataFrame, daily: DataFrame, **corrections) -> DataFrame:
    return hospital_changes(corrected(merged_series(series, archives, daily), **corrections))


# the same series, kept up to date ----------------------------------------------------
REPORTED = {"currently_hospitalized": "reported_hospitalized", ICU: "reported_icu"}


def series_batch(rows: DataFrame, like: StructType, **corrections) -> DataFrame:
    """Rows of version_rows() as a batch of the refreshed series: with all columns of `like`, and their corrections."""
    empty = rows.sparkSession.createDataFrame([], like)
    return with_corrections(union_by_name([empty, rows]), **corrections).withColumnsRenamed(REPORTED)


def refreshed_series(spark: SparkSession, root: str, like: StructType) -> RefreshedPanel:
    """The corrected series with its changes and means, refreshed where late archives change it.

    `like` is the schema of the rows of all feeds together. A day on the list of corrections takes the row before
    it, so it is dirty when that row is.
    """
    names = {**{f.name: f.name for f in like.fields}, **REPORTED}
    base = StructType([StructField(names[f.name], f.dataType) for f in like.fields] + [StructField("_listed", BooleanType()), StructField("_fixed", DoubleType())])
    first = {
        "currently_hospitalized": Derived(lambda p: carry_previous(p, "reported_hospitalized", F.col("_listed").isNotNull()), 1),
        ICU: Derived(lambda p: F.coalesce("_fixed", "reported_icu"), 0),
    }
    ties = [names[c] for c in TIES]
    order = lambda: [F.col("source_rank").asc(), *[F.col(c).desc_nulls_last() for c in ties]]
    return RefreshedPanel(spark, root, PANEL, base, order, first | CHANGES, period=F.year)


def read_series(panel: RefreshedPanel, like: StructType) -> DataFrame:
    """The columns that hospital_panel() gives."""
    return panel.read().select(*[f.name for f in like.fields if f.name != "source_rank"], *CHANGES)


# age bands -----------------------------------------------------------------------
def band_label(name: Column) -> Column:
    """Age band of an admission column, from what stands after its kind.

    Two numbers joined by an underscore are a range and shown as "60 to 69", a number alone
    or anything else stands as it is, and all pediatric columns are one band.
    """
    band = F.regexp_replace(name, f"^{ADULT}_covid_(confirmed|suspected)_?", "")
    shown = F.regexp_replace(band, r"^(\d+)_(\d+)$", "$1 to $2")
    return F.when(name.startswith(CHILD), F.lit("pediatric")).otherwise(shown)


def band_status(name: Column) -> Column:
    return F.when(name.contains("confirmed"), F.lit("confirmed")).otherwise(F.lit("suspected"))


def band_columns(df: DataFrame) -> list[str]:
    """Admission columns split by age. A total is left out where its parts are there too."""
    cols = starting(df, ADULT, CHILD)
    return [
        c for c in cols if not (c.startswith(ADULT) and c in PARTS) and not (c in PARTS and any(o.startswith(c + "_") for o in cols))
    ]


def admissions_by_age(hospital: DataFrame, reported: str = f"{ADULT}_covid_confirmed_60_69") -> DataFrame:
    """Admissions per state, band, status and day with a ramp mean.

    Columns that fall into one band are added up before the window; all of them must be known.
    """
    cols = band_columns(hospital)
    long = lengthen(hospital.where(F.col(reported).isNotNull()), ["state", "date"], cols, "name", "value")
    banded = long.withColumns({"age_group": band_label(F.col("name")), "status": band_status(F.col("name"))})
    # as with any total, a missing part makes the sum missing
    total = F.when(F.count("value") == F.count(F.lit(1)), F.sum("value"))
    summed = banded.groupBy("state", "age_group", "status", "date").agg(total.alias("prev_day_admissions"))
    panel = Panel(("state", "age_group", "status"), "date")
    return summed.withColumn("adm_7d_avg", panel.rolling_mean("prev_day_admissions"))
