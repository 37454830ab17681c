"""Station footfall, communes and city gazetteers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.functions.text import blank_to_null
from railmart.schemas import GAZETTEER_FIELDS, GAZETTEER_WIDTH
from railmart.sources.files import latest, list_files, read_csv, read_json_array

COMMUNES_JSON = (
    "nom string, code string, codeDepartement string, codeRegion string, population long"
)
FOOTFALL_NAME = "Nom de la gare"
FOOTFALL_YEARS = ["Total Voyageurs 2024", "Total Voyageurs 2023"]


def read_footfall(spark: SparkSession, folder: str) -> DataFrame:
    """(name, value, ord) of the newest list; the newest year column present gives the value.

    `ord` is the place in the file, which decides between equally good matches. The file is a list
    of some thousand stations, read as one split, so the running id is the line order.
    """
    newest = latest(list_files(spark, folder, "sncf_frequentation_*.csv"))
    df = read_csv(spark, newest, sep=";").coalesce(1)
    year = next(name for name in FOOTFALL_YEARS if name in df.columns)
    return df.select(
        F.col(FOOTFALL_NAME).alias("name"),
        F.col(year).try_cast("double").alias("value"),
        F.monotonically_increasing_id().alias("ord"),
    ).where(F.col("name").isNotNull())


def read_communes(spark: SparkSession, folder: str) -> DataFrame:
    """(name, population) of the newest commune list; official codes stay text."""
    newest = latest(list_files(spark, folder, "communes_population_france_*.csv"))
    return _communes(read_csv(spark, newest, ["nom", "code", "population"]))


def read_communes_json(spark: SparkSession, path: str) -> DataFrame:
    return read_json_array(spark, path, COMMUNES_JSON)


def _communes(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("nom").alias("name"), F.col("population").try_cast("double").alias("population")
    ).where(F.col("name").isNotNull())


def read_gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """(ascii_name, name, population) of the newest staged gazetteer."""
    newest = latest(list_files(spark, folder, "geonames_cities_*.csv"))
    return (
        read_csv(spark, newest, ["asciiname", "name", "population"])
        .select(
            F.col("asciiname").alias("ascii_name"),
            "name",
            F.col("population").try_cast("double").alias("population"),
        )
        .where(F.col("ascii_name").isNotNull())
    )


def of_listed_countries(df: DataFrame, column: str = "country_code") -> DataFrame:
    """Places of the countries the job covers."""
    return df.where(F.col(column).isin(C.GAZETTEER_COUNTRIES))


def read_gazetteer_dump(spark: SparkSession, path: str) -> DataFrame:
    """Headerless tab-separated dump: listed countries only, rows shorter than 15 fields dropped."""
    fields = spark.read.text(path).select(F.split("value", "\t").alias("f")).where(F.size("f") >= GAZETTEER_WIDTH)
    named = fields.select(*[blank_to_null(F.get("f", F.lit(i))).alias(name) for i, name in GAZETTEER_FIELDS.items()])
    return of_listed_countries(named).select(
        "name", "asciiname", "country_code", "population", "latitude", "longitude"
    )
