"""Batch and streaming sources of a spec."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluiceway import storage
from sluiceway.errors import SourceError

# Source formats of a spec, and the options CSV is read with unless a spec says else.
FORMATS = ("parquet", "delta", "csv", "json")
CSV_OPTIONS = {"header": "true", "inferSchema": "true"}

# A source whose name contains one of these words is a dimension and read as a batch.
DIMENSION_WORDS = (
    "user_profiles",
    "users",
    "customers",
    "products",
    "categories",
    "dimensions",
    "lookup",
    "reference",
)

# Path beginnings that never denote a catalog table.
PATH_SCHEMES = ("dbfs:", "s3:", "abfss:")


def is_table_name(path: str) -> bool:
    """Whether a path is a catalog table such as ``catalog.schema.table``."""
    return path.count(".") >= 2 and "/" not in path and not path.startswith(PATH_SCHEMES)


def _check(source: dict) -> None:
    missing = [key for key in ("name", "type", "path") if not source.get(key)]
    if missing:
        raise SourceError(f"source {source.get('name', '?')!r} lacks {', '.join(missing)}")
    if source["type"] not in FORMATS:
        raise SourceError(f"source {source['name']!r}: unknown type {source['type']!r}, use one of {FORMATS}")


def _options(source: dict) -> dict:
    options = dict(source.get("options") or {})
    if source["type"] != "csv":
        return options
    defaults = dict(CSV_OPTIONS)
    if source.get("schema") is not None:
        # A given schema saves the pass over all files that inference takes.
        defaults.pop("inferSchema")
    return {**defaults, **options}


def read_source(spark: SparkSession, source: dict) -> DataFrame:
    """Lazy frame over one source; ``schema`` may be given to skip inference."""
    _check(source)
    try:
        if is_table_name(source["path"]):
            return spark.table(source["path"])
        reader = spark.read.format(source["type"]).options(**_options(source))
        if source.get("schema") is not None:
            reader = reader.schema(source["schema"])
        return reader.load(source["path"])
    except Exception as error:  # a missing connector is no PySpark error
        if source["type"] == "delta" and "DATA_SOURCE_NOT_FOUND" in str(error):
            raise SourceError(f"source {source['name']!r}: this Spark has no delta connector") from error
        raise SourceError(f"source {source['name']!r} at {source['path']}: {error}") from error


def read_sources(spark: SparkSession, sources: list[dict]) -> dict[str, DataFrame]:
    """All sources under their names; an unknown type is reported before anything is read."""
    for source in sources:
        _check(source)
    return {source["name"]: read_source(spark, source) for source in sources}


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame with its rows counted by whichever job reads it whole, so no job of its own.

    Filters are not pushed below the count, so it is meant for sources that are read whole.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def source_mode(source: dict) -> str:
    """``stream`` or ``batch``: what the source says, else batch for a dimension by name."""
    mode = source.get("mode")
    if mode is not None:
        if mode not in ("stream", "batch"):
            raise SourceError(f"source {source['name']!r}: mode must be stream or batch")
        return mode
    name = source["name"].lower()
    return "batch" if any(word in name for word in DIMENSION_WORDS) else "stream"


def read_stream(spark: SparkSession, source: dict) -> DataFrame:
    """Streaming frame over the files of a source; the schema comes from a batch read.

    A path that is one file is read through its folder, which is what a file stream watches.
    """
    _check(source)
    if is_table_name(source["path"]):
        return spark.readStream.table(source["path"])
    schema = source.get("schema") or read_source(spark, source).schema
    options = _options(source)
    options.pop("inferSchema", None)
    path = source["path"]
    if storage.is_file(spark, path):
        path, _, file = path.rpartition("/")
        options["pathGlobFilter"] = file
    reader = spark.readStream.format(source["type"]).options(**options)
    return reader.schema(schema).load(path)
