"""Names of any length in places, and mentions of pay in SQL."""

import re

from wagewright.functions import pay, places, sql
from wagewright.plans.queries import QUERIES

PLACES = "location_id string, city string, region string, region_code string, country_code string, population long"


def test_names_of_any_length(spark):
    gazetteer = spark.createDataFrame([
        ("IT-1", "Milano", "Lombardia", "03", "IT", 1_300_000), ("IT-2", "San Marco in San Marco di San Marco Alto", "Terra di mezzo tra le due acque", "99", "IT", 10), ("IT-3", "Milano Marittima", None, None, "IT", 5),
        ("DE-1", "Frankfurt am Main", "Hessen", "DE7", "DE", 700_000),
    ], PLACES)
    cases = {
        "Sede: san marco in san marco di san marco alto (IT)": "IT-2", "San Marco, Italia": "IT", "tutta la Terra di Mezzo tra le due Acque, Italia": "IT-REG-99", "terra di mezzo tra le due, Italia": "IT",
        "Greater Milan": "IT-1", "Milan or Milano Marittima": "IT-3", "Frankfurt": "DE-1", "Hesse, Germany": "DE-REG-DE7", "": "IT",
    }
    rows = spark.createDataFrame([(raw, "DE" if want.startswith("DE") else "IT", None) for raw, want in cases.items()], "raw string, country string, workplace string")
    assert {r["raw"]: r["location_id"] for r in places.geocode(rows, gazetteer).collect()} == cases


def test_mentions_of_pay(spark):
    assert "pay_mentions" in sql.register(spark)
    texts = ["Ärger: €. 30.000 bis EUR.40.000 pro Jahr, fatturato €800 mln", "no figure", "", None, "RAL 30.000 - 40.000 €"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = spark.sql("SELECT id, substr(text, start + 1, stop - start) AS said, phrase, low, high, period FROM {t}, LATERAL pay_mentions(text)", t=frame).collect()
    assert {r["id"] for r in got} <= {0, 4}
    first = next(r for r in got if r["id"] == 4)
    assert first["said"] == first["phrase"] and (first["low"], first["high"]) == (30000, 40000)
    assert all(r["said"].replace("€.", "€").replace("EUR.", "EUR") == r["phrase"] for r in got)
    listed = spark.sql("SELECT id, inline(pay_list(text)) FROM {t}", t=frame)
    assert sorted(map(tuple, listed.collect()), key=str) == sorted(map(tuple, spark.sql("SELECT id, m.* FROM {t}, LATERAL pay_mentions(text) m", t=frame).collect()), key=str)


def alternatives(pattern):
    """The alternatives of a pattern as the plain texts that they hold."""
    depth, parts = 0, [""]
    for c in re.sub(r"\\\.", ".", pattern):
        depth += (c == "(") - (c == ")")
        if c == "|" and depth == 0:
            parts.append("")
        else:
            parts[-1] += c
    return [re.sub(r"\\[bws]\*?|\?", " ", p).lower().replace("\\", "") for p in parts]


def test_every_alternative_holds_a_piece():
    inner = lambda p: re.sub(r"^\\b\(\?:|\)\\b$", "", p)
    cases = [(pay.PERIOD_WORDS[k], v) for k, v in pay.PERIOD_PIECES.items()] + [(pay.CURRENCIES[k], v) for k, v in pay.CURRENCY_PIECES.items()]
    cases += [(pay.GROSS, pay.GROSS_PIECES), (inner(pay.COMPANY_FIGURES), pay.COMPANY_PIECES), (inner(pay.DEALS).replace("(?-i:ARR)", "arr"), pay.DEAL_PIECES), (inner(pay.BENEFITS), pay.BENEFIT_PIECES)]
    for pattern, pieces in cases:
        for one in alternatives(pattern):
            assert any(p in one for p in pieces.split(",")), one


def test_texts_are_dealt_out_to_many_tasks(spark, tmp_path):
    path = str(tmp_path)
    spark.range(50_000).selectExpr("id AS o_orderkey", "id AS o_custkey").coalesce(1).write.parquet(f"{path}/orders.parquet")
    assert QUERIES["pay_mentions"](spark, path).rdd.getNumPartitions() == 3
