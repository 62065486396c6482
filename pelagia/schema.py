"""The cell table's schema, ingest rules and the small constant tables of the domain."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Provenance of a dataset, and the key of a cell.
DATASET = ["model", "member", "scenario", "variable"]
CELL = ["iz", "iy", "ix"]

GRID_CELLS = T.StructType(
    [T.StructField(c, T.StringType()) for c in (*DATASET, "dataset")]
    + [T.StructField("time", T.DateType()), T.StructField("window", T.StringType())]
    + [T.StructField(c, T.IntegerType()) for c in CELL]
    + [T.StructField(c, T.DoubleType()) for c in ("depth", "lat", "lon", "value")]
)

# Fixed values of the domain, down to PELAGIC_ZONES: names, factors, bounds and ranges that results depend on.

#: (window, start, end); the first is historical, the others future and overlapping.
WINDOWS = (("2006-2014", "2006-01-01", "2014-12-31"), ("2030-2060", "2030-01-01", "2060-12-31"), ("2050-2060", "2050-01-01", "2060-12-31"), ("2090-2100", "2090-01-01", "2100-12-31"))
EXPERIMENTS = ("historical", "ssp126", "ssp245", "ssp585")
VARIABLES = ("thetao", "so", "ph", "o2", "chl", "uo", "vo", "zooc", "zos", "mlotst")
GLORYS = ("thetao", "so", "uo", "vo", "zos", "mlotst", "siconc")
HINDCAST = ("chl", "o2", "ph")
FLAT = ("zos", "mlotst", "siconc")
DELTA_MODE = {"chl": "log_ratio"}
ANOMALY_SCALE = {"siconc": 0.01}
OUTPUT_BOUNDS = {"mlotst": (0.0, None), "siconc": (0.0, 1.0), "so": (0.0, None)}
CESM_NAMES = {"TEMP": "thetao", "SALT": "so", "UVEL": "uo"}
SCALE_FACTORS = {"thetao": 100, "temp": 100, "so": 100, "salt": 100, "uo": 100, "uvel": 100, "o2": 1000, "chl": 10000}
DEFAULT_SCALE = 100

#: (label, lower, upper): half-open ranges of depth in metres.
FINE_BINS = tuple((f"{a:04d}_{b:04d}m", float(a), float(b)) for edges in ((0, 25, 50, 100, 200, 400, 600, 800, 1000, 1500, 2000, 3000, 4000, 5000, 6000),) for a, b in zip(edges, edges[1:], strict=False))
PELAGIC_ZONES = (("epipelagic_0000_0200m", 0.0, 200.0), ("mesopelagic_0200_1000m", 200.0, 1000.0), ("bathypelagic_1000_4000m", 1000.0, 4000.0), ("abyssopelagic_4000_6000m", 4000.0, 6000.0))


def finite(value: Column) -> Column:
    """NULL for NaN and the infinities: a cell has a value or none."""
    v = value.cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def read_cells(spark: SparkSession, path: str, variable: str | None = None) -> DataFrame:
    """The cell table under path; a variable selects its partition before anything is read."""
    cells = spark.read.parquet(path)
    return (cells if variable is None else cells.where(F.col("variable") == variable)).withColumn("value", finite(F.col("value")))


def table(spark: SparkSession, rows: tuple, schema: str) -> DataFrame:
    """A constant table, for broadcast joins."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def any_of(column: Column, wanted: tuple | list) -> Column:
    """Membership; no names at all admit everything."""
    return column.isin(list(wanted)) if wanted else F.lit(True)


def spec(text: str) -> dict[str, str]:
    """A mapping written as "source:target source:target"; a name alone maps to itself, a source named twice is an error."""
    out: dict[str, str] = {}
    for part in text.replace(",", " ").split():
        source, _, target = part.partition(":")
        if not source or source in out or part.count(":") > 1:
            raise ValueError(f"not a mapping: {part}")
        out[source] = target or source
    return out


def filled_template(template: str, **columns: Column) -> Column:
    """A path template whose {name} tokens are columns; a token without a column is an error."""
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(columns[name])
    return F.concat(*parts)


def rule(column: Column, values: dict, default: Column | None = None) -> Column:
    """values[column], or default."""
    out = F.lit(None) if default is None else default
    for k, v in values.items():
        out = F.when(column == k, F.lit(v)).otherwise(out)
    return out
