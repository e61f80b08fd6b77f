"""Domain vocabularies and the small dimension tables built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. They must equal the source system's for results to match, so they
# are written out as data.
# ---------------------------------------------------------------------------

# code, latitude, longitude
AIRPORTS = (
    ("ATL", 33.6407, -84.4277),
    ("LAX", 33.9425, -118.4081),
    ("ORD", 41.9742, -87.9073),
    ("DFW", 32.8998, -97.0403),
    ("DEN", 39.8561, -104.6737),
    ("JFK", 40.6413, -73.7781),
    ("SFO", 37.6213, -122.3790),
    ("SEA", 47.4502, -122.3088),
    ("LAS", 36.0840, -115.1537),
    ("MCO", 28.4312, -81.3081),
    ("EWR", 40.6895, -74.1745),
    ("MIA", 25.7959, -80.2870),
    ("PHX", 33.4373, -112.0078),
    ("IAH", 29.9902, -95.3368),
    ("BOS", 42.3656, -71.0096),
    ("MSP", 44.8820, -93.2218),
    ("DTW", 42.2162, -83.3554),
    ("FLL", 26.0742, -80.1506),
    ("CLT", 35.2140, -80.9431),
    ("SLC", 40.7899, -111.9791),
    ("SAN", 32.7336, -117.1897),
    ("BWI", 39.1754, -76.6683),
    ("MDW", 41.7868, -87.7522),
    ("TPA", 27.9755, -82.5332),
    ("IAD", 38.9531, -77.4565),
    ("PDX", 45.5898, -122.5951),
    ("HOU", 29.6454, -95.2789),
    ("HNL", 21.3245, -157.9251),
    ("SJC", 37.3626, -121.9290),
    ("OAK", 37.7213, -122.2208),
    ("SMF", 38.6954, -121.5908),
    ("AUS", 30.1975, -97.6664),
    ("SAT", 29.5337, -98.4698),
    ("RSW", 26.5362, -81.7552),
    ("BNA", 36.1245, -86.6782),
    ("STL", 38.7487, -90.3700),
    ("MCI", 39.2976, -94.7139),
    ("RDU", 35.8801, -78.7880),
    ("PHL", 39.8744, -75.2424),
    ("DCA", 38.8521, -77.0377),
    ("LGA", 40.7773, -73.8726),
    ("MEM", 35.0424, -89.9767),
    ("CLE", 41.4117, -81.8498),
    ("PIT", 40.4915, -80.2329),
    ("CVG", 39.0488, -84.6678),
    ("IND", 39.7173, -86.2944),
    ("CMH", 39.9980, -82.8919),
    ("OMA", 41.3032, -95.8941),
    ("ABQ", 35.0402, -106.6090),
    ("ANC", 61.1743, -149.9963),
)

# code -> airport name, city
AIRPORT_NAMES = {
    "JFK": ("John F. Kennedy International", "New York"),
    "LAX": ("Los Angeles International", "Los Angeles"),
    "ORD": ("O'Hare International", "Chicago"),
    "DFW": ("Dallas/Fort Worth International", "Dallas"),
    "ATL": ("Hartsfield-Jackson Atlanta International", "Atlanta"),
    "SFO": ("San Francisco International", "San Francisco"),
    "SEA": ("Seattle-Tacoma International", "Seattle"),
    "MIA": ("Miami International", "Miami"),
    "BOS": ("Logan International", "Boston"),
    "DEN": ("Denver International", "Denver"),
}

CARRIERS = ("AA", "UA", "DL", "WN", "AS", "B6", "NK", "F9", "HA", "G4")
AIRLINES = ("AA", "UA", "DL", "WN", "AS", "B6", "NK", "F9")
AIRCRAFT_TYPES = ("Boeing 737", "Boeing 777", "Airbus A320", "Airbus A321")
DELAY_CAUSES = ("weather", "carrier", "nas", "security", "late_aircraft")
NO_CAUSE = "none"
HUBS = ("ORD", "ATL", "DFW", "JFK", "LAX")
PEAK_HOURS = ((7, 9), (16, 19))
STORM_CODES = (80, 81, 82, 95, 96, 97, 98, 99)

EARTH_RADIUS_MI = 3958.8
CRUISE_MPH = 520
TAXI_MINUTES = 40
DELAY_THRESHOLD_MIN = 15
SEVERE_DELAY_MIN = 60
NEAREST_AIRPORT_MAX_MI = 300
IMPACT_THRESHOLD = 0.4
SECTOR_OVERLOAD = 15
CACHE_TTL_S = 60
CACHE_MAX_AGE_S = 300
SNAPSHOTS_KEPT = 10
FEET_PER_METRE = 3.28084
KNOTS_PER_MPS = 1.944
LOW_ALTITUDE_M = 1524
MID_ALTITUDE_M = 7620
ALTITUDE_COLOURS = {
    "low": (30, 144, 255, 200),
    "mid": (255, 215, 0, 200),
    "high": (255, 69, 0, 220),
}
GREEN, YELLOW, RED = "#2ea043", "#d29922", "#f85149"

# Closed box used for live positions: lat_min, lat_max, lon_min, lon_max
LIVE_BOX = (24.0, 50.0, -125.0, -66.0)
# Half-open box used for airspace sectors, split into rows x columns
SECTOR_BOX = (25.0, 50.0, -125.0, -65.0)
SECTOR_ROWS, SECTOR_COLS = 4, 5

# ---------------------------------------------------------------------------

NETWORK = AIRPORTS[:25]  # the airports the flight tables fly between
NETWORK_CODES = tuple(a[0] for a in NETWORK)
ALL_CODES = tuple(a[0] for a in AIRPORTS)
N_SECTORS = SECTOR_ROWS * SECTOR_COLS


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "\\'") + "'"


def airports(spark: SparkSession, table=AIRPORTS) -> DataFrame:
    """The airport dimension: at most 50 rows, held in the plan itself."""
    rows = []
    for ordinal, (code, lat, lon) in enumerate(table):
        name, city = AIRPORT_NAMES.get(code, (None, None))
        rows.append(
            f"('{code}', {ordinal}, double({lat!r}), double({lon!r}), "
            f"{_sql_text(name) if name else 'string(null)'}, "
            f"{_sql_text(city) if city else 'string(null)'})"
        )
    return spark.sql(
        "SELECT * FROM VALUES " + ", ".join(rows) + " AS t(code, ord, lat, lon, name, city)"
    )


def airport_array(table=NETWORK) -> Column:
    """The dimension as one constant array column, for per-row nearest lookups.

    Constants are written as SQL text: one expression instead of hundreds of Column calls.
    """
    entries = ", ".join(
        f"named_struct('ord', {ordinal}, 'code', '{code}', 'lat', double({lat!r}), 'lon', double({lon!r}))"
        for ordinal, (code, lat, lon) in enumerate(table)
    )
    return F.expr(f"array({entries})")


def airport_pairs(spark: SparkSession, table=NETWORK) -> DataFrame:
    """Every ordered pair of distinct airports: n*(n-1) rows, fixed by the dimension."""
    return (
        airports(spark, table)
        .select(
            F.col("code").alias("origin"), F.col("lat").alias("o_lat"), F.col("lon").alias("o_lon"),
            F.explode(airport_array(table)).alias("d"),
        )
        .where("origin <> d.code")
        .select(
            "origin", F.col("d.code").alias("destination"), "o_lat", "o_lon",
            F.col("d.lat").alias("d_lat"), F.col("d.lon").alias("d_lon"),
        )
    )


def constants(values) -> Column:
    """A constant array of text or whole numbers."""
    return F.expr("array(" + ", ".join(_sql_text(v) if isinstance(v, str) else str(v) for v in values) + ")")


def pick(values, index: Column) -> Column:
    """values[index] with a constant array; null when the index is null."""
    return F.element_at(constants(values), (index + 1).cast("int"))
