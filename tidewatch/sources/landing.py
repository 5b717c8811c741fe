"""The feeds of a landing folder, by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as s
from .delimited import read_banner, read_feed, read_positional, read_text
from .documents import read_nested_records, read_records
from .manifest import read_manifest
from .staging import staged

ADMISSION_PREFIXES = ("previous_day_admission_adult", "previous_day_admission_pediatric")
LATIN = "ISO-8859-1"

# Texts of the two heading lines of the density file.
DENSITY_BANNER = {"id": ["GEO.id", "Id"]}
# Fact feeds that the plans read more than once: their text is parsed once and kept as columns.
READ_OFTEN = {"county_counters", "test_results", "hospital_series", "cases_deaths", "nursing_homes"}
VACCINATION_FIELD = "vaccination_county_condensed_data"


@dataclass
class Landing:
    """Feeds read from one folder. Each is opened on first use and kept by name."""

    spark: SparkSession
    folder: str
    readers: dict[str, Callable[[], DataFrame]] = field(default_factory=dict)
    opened: dict[str, DataFrame] = field(default_factory=dict)

    def __post_init__(self):
        sp = self.spark
        csv = lambda name, columns, **kw: lambda: read_feed(sp, self.path(f"{name}.csv"), columns, **kw)
        self.readers = {
            "county_counters": lambda: read_positional(sp, self.path("county_counters.csv"), s.COUNTY_COUNTERS),
            "census_regions": csv("census_regions", s.CENSUS_REGIONS),
            "county_population": csv("county_population", s.COUNTY_POPULATION, encoding=LATIN),
            "metro_crosswalk": csv("metro_crosswalk", s.METRO_CROSSWALK),
            "density": lambda: read_banner(sp, self.path("density.csv"), s.DENSITY, DENSITY_BANNER, LATIN),
            "election_2016": csv("election_2016", s.ELECTION_2016),
            "election_2020": csv("election_2020", s.ELECTION_2020),
            "county_vaccination": lambda: read_nested_records(
                sp, self.path("county_vaccination.json"), VACCINATION_FIELD, s.COUNTY_VACCINATION
            ),
            "test_results": csv("test_results", s.TEST_RESULTS),
            "test_history": csv("test_history", s.TEST_HISTORY),
            "hospital_series": csv("hospital_series", s.HOSPITAL_SERIES, prefixes=ADMISSION_PREFIXES),
            "hospital_daily": csv("hospital_daily", s.HOSPITAL_DAILY, prefixes=ADMISSION_PREFIXES),
            "hospital_archives": lambda: read_manifest(
                sp, read_feed(sp, self.path("archive_manifest.csv"), s.ARCHIVE_MANIFEST), s.HOSPITAL_DAILY, ADMISSION_PREFIXES, self.folder
            ),
            "cases_deaths": csv("cases_deaths", s.CASES_DEATHS),
            "state_vaccination": csv("state_vaccination", s.STATE_VACCINATION),
            "state_population": csv("state_population", s.STATE_POPULATION),
            "hex_grid": lambda: read_text(sp, self.path("hex_grid.csv")),
            "nursing_homes": csv("nursing_homes", s.NURSING_HOMES),
            "state_tracking": lambda: read_records(sp, self.path("state_tracking.json"), s.STATE_TRACKING),
        }

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.opened:
            feed = self.readers[name]()
            self.opened[name] = staged(feed, name) if name in READ_OFTEN else feed
        return self.opened[name]

    def load(self, *names: str) -> dict[str, DataFrame]:
        """Several feeds at once."""
        return {n: self[n] for n in names}
