"""Input files: companies, corrections by hand, municipalities, labelled samples."""

from __future__ import annotations

import codecs
import csv
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.functions.ids import company_id
from wagewright.functions.places import NAMES, size_band
from wagewright.operators.history import first_of
from wagewright.schema import conform
from wagewright.sources.workbook import cell, sheets
from wagewright.stores import written

#: Length of a region's code within a municipality's, by country.
REGION_CODE = {"DE": 3, "NL": 4, "FR": 3}
#: Columns of samples of earlier versions.
OLD_COLUMNS = {"giudizio": "verdict", "note": "notes", "frasi_trovate": "matched_phrases", "contesto": "context"}


def companies(spark: SparkSession, path: str) -> DataFrame:
    """Companies of a CSV with a header; rows without a name go, flags that aren't numbers are 0."""
    rows = spark.read.csv(path, header=True).where(F.trim("name") != "")
    flag = lambda c: F.coalesce(F.col(c).try_cast("int"), F.lit(0)) if c in rows.columns else F.lit(0)
    return conform(rows.withColumn("company_id", company_id(F.col("name"))).withColumn("is_tech", flag("is_tech")).withColumn("website_verified", flag("website_verified")), "companies")


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """Corrections by hand, by company_id; of several rows of one the last counts."""
    rows = spark.read.csv(path, header=True).where(F.trim("company") != "").withColumn("company_id", company_id(F.col("company"))).withColumn("_o", F.monotonically_increasing_id())
    return first_of(rows, ["company_id"], "_o", last=True).drop("_o")


def unknown_overrides(overrides: DataFrame, companies: DataFrame) -> DataFrame:
    """Corrections of companies that aren't in the list."""
    return overrides.join(companies.select("company_id"), "company_id", "left_anti")


def eurostat_units(spark: SparkSession, path: str) -> DataFrame:
    """Local units of a CSV whose header names them; european_municipalities takes them."""
    rows = spark.read.csv(path, header=True)
    return rows.select("country_code", "nuts3", "lau_code", "name_latin", "name", F.col("population").try_cast("bigint").alias("population"))


def eurostat_regions(spark: SparkSession, path: str) -> DataFrame:
    """Region codes and their names, one column for each level, of a CSV with a header."""
    return spark.read.csv(path, header=True).select("code", "n1", "n2", "n3", "n4")


#: Fixed value: the sheet that names regions.
REGION_SHEET = "NUTS & SR 2021"


def workbook_units(cells: DataFrame) -> DataFrame:
    """Local units of a workbook's sheets, one for each country; the first row is the header."""
    at = lambda i: cell(i)["text"]
    return cells.where((F.col("row") > 1) & F.col("sheet").isin(list(REGION_CODE))).select(F.col("sheet").alias("country_code"), at(0).alias("nuts3"), at(1).alias("lau_code"), at(4).alias("name_latin"), at(3).alias("name"), cell(6)["number"].cast("bigint").alias("population"))


def workbook_regions(cells: DataFrame) -> DataFrame:
    """Region codes and their names, one column for each level, of a workbook's sheet; of a code that comes again the last row."""
    own = cells.where((F.col("row") > 1) & (F.col("sheet") == REGION_SHEET)).select("row", cell(0)["text"].alias("code"), *(F.nullif(cell(i)["text"], F.lit("")).alias(f"n{i}") for i in range(1, 5))).where(F.col("code") != "")
    return first_of(own, ["code"], "row", last=True).drop("row")


def eurostat_workbooks(spark: SparkSession, units: str, regions: str) -> DataFrame:
    """Municipalities of the observed countries but Italy, from the two workbooks as they are published."""
    return european_municipalities(workbook_units(sheets(spark, units, list(REGION_CODE))), workbook_regions(sheets(spark, regions, [REGION_SHEET])))


def italian_municipalities(spark: SparkSession, path: str, population_path: str) -> DataFrame:
    """Municipalities of a semicolon-separated file, by place of the column; short rows and rows without a code go."""
    cells = spark.read.text(path).select(F.split("value", ";").alias("c")).where((F.size("c") >= 15) & (F.trim(F.get("c", F.lit(4))) != "")).where(F.trim(F.get("c", F.lit(4))).rlike(r"^\d+$"))
    at = lambda i: F.trim(F.get("c", F.lit(i)))
    people = spark.read.schema("codice string, popolazione bigint").json(population_path, multiLine=True).select(F.col("codice").alias("istat_code"), F.col("popolazione").alias("population")).dropDuplicates(["istat_code"])
    rows = cells.select(at(4).alias("istat_code"), at(6).alias("city"), at(11).alias("province"), at(14).alias("province_code"), at(10).alias("region"), at(0).alias("region_code"), at(9).alias("macro_area"), (at(13) == "1").cast("int").alias("is_capoluogo"))
    full = rows.join(people, "istat_code", "left").withColumns({"location_id": F.concat(F.lit("IT-"), "istat_code"), "country": F.lit("Italy"), "country_code": F.lit("IT"), "is_remote": F.lit(0), "city_size_band": size_band(F.col("population"))})
    return conform(full, "locations")


def european_municipalities(units: DataFrame, regions: DataFrame) -> DataFrame:
    """units: country_code, nuts3, lau_code, name_latin, name, population; regions: code and names in four columns n1 to n4.

    A city's name ends at its first comma; a region is the unit's code cut to its country's length.
    """
    size = F.coalesce(*(F.when(F.col("country_code") == c, n) for c, n in REGION_CODE.items()))
    name = F.coalesce(F.nullif(F.col("name_latin"), F.lit("")), F.nullif(F.col("name"), F.lit("")))
    fine = units.where(F.col("nuts3").isNotNull() & F.col("lau_code").isNotNull() & name.isNotNull() & F.col("country_code").isin(list(REGION_CODE)))
    rows = fine.withColumn("region_code", F.substring("nuts3", F.lit(1), size)).withColumn("city", F.trim(F.substring_index(name, ",", 1)))
    names = regions.select(F.col("code").alias("region_code"), F.coalesce("n1", "n2", "n3", "n4").alias("region"))
    country = F.element_at(F.create_map(*(F.lit(x) for kv in NAMES.items() for x in kv)), F.col("country_code"))
    full = rows.join(names, "region_code", "left").withColumns({"location_id": F.concat_ws("-", "country_code", "lau_code"), "country": country, "is_remote": F.lit(0), "is_capoluogo": F.lit(0), "city_size_band": size_band(F.col("population"))})
    return conform(full, "locations")


def _windows(error: UnicodeError) -> tuple[str, int]:
    return error.object[error.start : error.end].decode("cp1252", errors="replace"), error.end


def labelled_records(content: bytes) -> list[dict[str, str | None]]:
    """The rows of a file by the columns of its own header; a quoted cell goes on over line ends, which don't count."""
    codecs.register_error("windows", _windows)
    lines = content.decode("utf-8-sig", errors="windows").splitlines()
    if not lines:
        return []
    sign = ";" if lines[0].count(";") >= lines[0].count(",") else ","
    return [{OLD_COLUMNS.get(k, k): v for k, v in r.items() if k is not None} for r in csv.DictReader(lines, delimiter=sign)]


def labelled_rows(files: DataFrame) -> DataFrame:
    """path, row (from 1) and values (a map by column) of labelled CSVs given as path and content.

    Each file has its own header, separator and mixture of encodings: UTF-8 with stray Windows bytes.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = labelled_records(bytes(content))
                yield pd.DataFrame({"path": path, "row": range(1, len(rows) + 1), "values": pd.Series(rows, dtype=object)})

    return files.select("path", "content").mapInPandas(read, "path string, row int, values map<string,string>")


def labelled_sample(spark: SparkSession, path: str) -> DataFrame:
    """Labelled CSVs however they were saved, with the columns of all of them; all columns are text, and blank cells NULL."""
    rows = written(labelled_rows(spark.read.format("binaryFile").load(path)), "labelled")
    named = rows.select("path", F.posexplode(F.map_keys("values")).alias("i", "name")).groupBy("name").agg(F.min(F.struct("i", "path")).alias("at"))
    names = [r["name"] for r in named.orderBy("at").collect()]  # columns of hand-made files
    return rows.select(*(F.nullif(F.element_at("values", F.lit(n)), F.lit("")).alias(n) for n in names))


def refresh(sample: DataFrame, jobs: DataFrame, columns: list[str]) -> DataFrame:
    """sample with the given columns taken anew from jobs (by url) in rows that have no verdict yet."""
    own = first_of(jobs.select("url", "job_key", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}") for c in columns)), ["url"], "job_key").drop("job_key").withColumn("_found", F.lit(True))
    joined = sample.join(own, "url", "left")
    fresh = F.col("_found").isNotNull() & (F.trim(F.coalesce("verdict", F.lit(""))) == "")
    return joined.select(*(F.when(fresh, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in sample.columns))
