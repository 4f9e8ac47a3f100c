"""Queries over files as people keep them: workbooks and labelled samples, made from the test tables and read again."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.adapters import load
from wagewright.plans.queries import query
from wagewright.sources import files, workbook

FILE = "path string, content binary"
#: Rows of a file that a query makes.
ROWS = 1000


def workbook_bytes(sheets: dict[str, list[tuple]]) -> bytes:
    """A workbook with shared strings; None is no cell."""
    shared: dict[str, int] = {}

    def cell(at: int, row: int, v: str | float) -> str:
        place = f'r="{chr(65 + at)}{row}"'
        return f'<c {place} t="s"><v>{shared.setdefault(v, len(shared))}</v></c>' if isinstance(v, str) else f"<c {place}><v>{v}</v></c>"

    space, link = workbook.MAIN[1:-1], workbook.LINK[1:-1]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for n, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{r}">' + "".join(cell(i, r, v) for i, v in enumerate(own) if v is not None) + "</row>" for r, own in enumerate(rows, 1))
            archive.writestr(f"xl/worksheets/sheet{n}.xml", f'<worksheet xmlns="{space}"><sheetData>{body}</sheetData></worksheet>')
        archive.writestr("xl/workbook.xml", f'<workbook xmlns="{space}" xmlns:r="{link}"><sheets>' + "".join(f'<sheet name="{escape(name)}" sheetId="{n}" r:id="r{n}"/>' for n, name in enumerate(sheets, 1)) + "</sheets></workbook>")
        archive.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{n}" Target="worksheets/sheet{n}.xml"/>' for n in range(1, len(sheets) + 1)) + "</Relationships>")
        archive.writestr("xl/sharedStrings.xml", f'<sst xmlns="{space}">' + "".join(f"<si><t>{escape(s)}</t></si>" for s in shared) + "</sst>")
    return out.getvalue()


COUNTRY = "CASE c_nationkey % 3 WHEN 0 THEN 'DE' WHEN 1 THEN 'NL' ELSE 'FR' END"
NUTS = f"concat({COUNTRY}, 'A', CAST(c_nationkey % 9 AS STRING), 'X')"


@query("workbook_places", f"""WITH u AS (SELECT *, {COUNTRY} AS cc, CASE c_nationkey % 3 WHEN 1 THEN substr({NUTS}, 1, 4) ELSE substr({NUTS}, 1, 3) END AS region_code, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey * 700 END AS n FROM customer WHERE c_custkey % 7 <> 0)
  SELECT concat(cc, '-', c_custkey) AS location_id, CASE WHEN c_custkey % 4 = 0 THEN c_name ELSE 'Ünit ' || c_custkey END AS city, concat('Region ', region_code) AS region, region_code, CASE cc WHEN 'DE' THEN 'Germany' WHEN 'NL' THEN 'Netherlands' ELSE 'France' END AS country, n AS population,
    CASE WHEN n >= 1000000 THEN 'metro' WHEN n >= 250000 THEN 'large' WHEN n >= 50000 THEN 'medium' WHEN n > 0 THEN 'small' END AS city_size_band FROM u""")
def workbook_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipalities of workbooks with a sheet for each country; some cells have no value."""
    def book(rows: pd.DataFrame) -> pd.DataFrame:
        by = {cc: [("NUTS", "LAU", "", "NATIONAL", "LATIN", "", "POPULATION")] for cc in ("DE", "NL", "FR")}
        for k, cc, nuts, name in zip(rows["k"], rows["cc"], rows["nuts"], rows["name"], strict=True):
            by[cc].append((nuts, None if k % 7 == 0 else int(k), None, f"{name}, city" if k % 4 == 0 else "national", None if k % 4 == 0 else f"Ünit {k}", None, "n.a." if k % 5 == 0 else int(k) * 700))
        return pd.DataFrame({"path": [f"units-{rows['k'].iloc[0]}.xlsx"], "content": [workbook_bytes(by)]})

    customers = load(spark, sf_dir, "customer")
    units = customers.select(F.col("c_custkey").alias("k"), F.expr(COUNTRY).alias("cc"), F.expr(NUTS).alias("nuts"), F.col("c_name").alias("name"), F.floor(F.col("c_custkey") / ROWS).alias("file"))
    codes = units.select(F.explode(F.array(F.substring("nuts", 1, 3), F.substring("nuts", 1, 4))).alias("code")).distinct()

    def names(rows: pd.DataFrame) -> pd.DataFrame:
        head = ("code", "level 1", "level 2", "level 3", "level 4")
        own = [(c, *(f"Region {c}" if i == len(c) - 2 else None for i in range(1, 5))) for c in sorted(rows["code"])]
        return pd.DataFrame({"path": ["regions.xlsx"], "content": [workbook_bytes({files.REGION_SHEET: [head, *own], "other": [("x",)]})]})

    books, regions = units.groupBy("file").applyInPandas(book, FILE), codes.withColumn("book", F.lit("regions")).groupBy("book").applyInPandas(names, FILE)  # 54 codes at most
    found = files.european_municipalities(files.workbook_units(workbook.sheets_of(books, list(files.REGION_CODE))), files.workbook_regions(workbook.sheets_of(regions, [files.REGION_SHEET])))
    return found.select("location_id", "city", "region", "region_code", "country", "population", "city_size_band")


@query("labelled_files", "SELECT concat('u', o_orderkey) AS url, CASE o_orderkey % 3 WHEN 0 THEN 'sì' WHEN 1 THEN 'no;, \"x\"' END AS verdict, concat('two', 'lines ', o_orderkey) AS notes, CASE WHEN o_orderkey // 1000 % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS salary_min FROM orders")
def labelled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled CSVs with their own headers and separators, old column names, cells over two lines and Windows bytes."""
    def made(rows: pd.DataFrame) -> pd.DataFrame:
        even = bool(rows["o_orderkey"].iloc[0] // ROWS % 2 == 0)
        sign = ";" if even else ","
        lines = [sign.join(["url", "giudizio", "note"] + ["salary_min"] * even)]
        for k, c in zip(rows["o_orderkey"], rows["o_custkey"], strict=True):
            verdict = ("sì", '"no;, ""x"""', "")[k % 3]
            lines.append(sign.join([f"u{k}", verdict, f'"two\nlines {k}"'] + [str(c)] * even))
        text = "\r\n".join(lines)
        content = "".join(("﻿", text)).encode() if even else text.encode("cp1252")
        return pd.DataFrame({"path": [f"{rows['o_orderkey'].iloc[0]}.csv"], "content": [content]})

    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.floor(F.col("o_orderkey") / ROWS).alias("file"))
    rows = files.labelled_rows(orders.groupBy("file").applyInPandas(made, FILE))
    return rows.select(*(F.nullif(F.element_at("values", F.lit(c)), F.lit("")).alias(c) for c in ("url", "verdict", "notes", "salary_min")))
