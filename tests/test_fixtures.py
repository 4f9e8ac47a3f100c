"""Expected values for the scalar functions, as data tables."""

import pytest
from pyspark.sql import functions as F

from wagewright.functions import ids, pay, places, rules, text


def one(spark, column, **values):
    """The value of a column over one row of the given strings."""
    names = list(values)
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names))
    return row.select(column.alias("x")).first()["x"]


def many(spark, column, rows, names):
    """The values of a column over rows of strings, in order."""
    data = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{n} string" for n in names))
    return [r["x"] for r in data.select("i", column.alias("x")).orderBy("i").collect()]


def test_numbers():
    assert [pay.number(x) for x in ("35.000", "1.800,50", "40,5", "35,000", "45 000", "1,200,000")] == [35000, 1800.5, 40.5, 35000, 45000, 1200000]


PAY = [
    ("Si offre RAL 35.000 - 40.000 € in base all'esperienza", None, (35000, 40000, "year", "gross")),
    ("Retribuzione: RAL 30-35K", None, (30000, 35000, "year", ...)),
    ("Stipendio di 1.800 € netti al mese", None, (1800, ..., "month", "net")),
    ("Retribuzione secondo CCNL 2024, 14 mensilità", None, None),
    ("💰 Pacchetto retributivo: 35.000-40.000 | welfare", None, (35000, 40000, ..., ...)),
    ("Range retribuzione : €k 50-60", None, (50000, 60000, ..., ...)),
    ("We pay attention to 3 things", None, None),
    ("Accès à la salle de sport pour 5€/mois", None, None),
    ("Own a portfolio of up to 40 enterprise accounts at €10K+ ARR", None, None),
    ("Paris 8e arr. Salaire 45 000 € par an", None, (45000, ..., ..., ...)),
    ("Base salary range (Italy) : €97,000 - €146,000 Base salary range (Germany) : €112,500 - €168,750", "DE", (112500, 168750, ..., ...)),
    ("Retribuzione Annua Lorda: da €. 65.000 a €. 80.000 + Premio", None, (65000, 80000, "year", ...)),
    ("Range RAL da €. 35.000 a €. 50.000 Buoni Pasto", None, (35000, 50000, ..., ...)),
    ("Compensation : CCNL Textile Industry, Level 4° - 5° Salary Renges: 70€ - 90€ per day", None, (70, 90, "day", ...)),
    ("ricavi pari a € 17,8 mld e investito € 2,5 mld", None, None),
    ("Gross annual salary no less than: 35.000k", None, (35000, ..., ..., ...)),
    ("Jahresgehalt: 55.000 € – 65.000 € brutto", None, (55000, 65000, "year", "gross")),
    ("Das Gehalt liegt zwischen 4.200 und 5.000 Euro brutto monatlich, 3 Jahre Erfahrung", None, (4200, 5000, "month", "gross")),
    ("Rémunération : 45 000 € - 52 000 € bruts annuels", None, (45000, 52000, "year", "gross")),
    ("€ 3.500 - € 4.500 bruto per maand", None, (3500, 4500, "month", "gross")),
    ("Fahrtkostenzuschuss 50 € pro Monat", None, None),
    ("ein Umsatz von 3,5 Mrd. Euro", None, None),
    ("Stagevergoeding van €500 per maand", None, (500, 500, "month", None)),
    (None, None, None),
    ("", None, None),
]


@pytest.mark.parametrize(("words", "country", "expected"), PAY)
def test_pay(words, country, expected):
    found = pay.parse(words, country)
    got = (found["min"], found["max"], found["period"], found["gross_net"])
    if expected is None:
        assert got[0] is None
    else:
        assert all(e is ... or e == g for e, g in zip(expected, got, strict=True)), got


def test_pay_column_and_fields(spark):
    rows = [
        ("Stipendio 2.000 € lordi al mese", None, "IT", False), ("Gehalt 4.500 € brutto pro Monat", None, "DE", False), ("Stage, rimborso 1.000 € al mese", None, "IT", True),
        ("pay by field", '{"min": 30000, "max": null, "currency": "EUR", "interval": "per-year-salary"}', "IT", False), ("listed", '[{"compensationType": "Salary", "interval": "1 YEAR", "currencyCode": "USD", "minValue": 100000, "maxValue": 120000}]', "IT", False),
        ("said", '"€35K – €45K"', "IT", False), ("Retribuzione commisurata all'esperienza", None, "IT", False), ("nothing", None, "IT", False), (None, "not json", None, False),
    ]
    data = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, text string, salary_structured string, country_code string, is_intern boolean")
    out = pay.with_pay(data).orderBy("i").collect()
    assert [r["ral_min_annual"] for r in out] == [28000, 54000, 12000, 30000, None, 35000, None, None, None]
    assert [r["ral_max_annual"] for r in out][3:6] == [30000, None, 45000]
    assert [r["salary_transparency"] for r in out] == ["figure", "figure", "figure", "figure", "none", "figure", "vague", "none", "none"]
    assert [r["salary_source"] for r in out] == ["text", "text", "text", "structured", "structured", "structured", "none", "none", "none"]


def test_annualize(spark):
    rows = [(2000.0, "month", "EUR", "gross"), (35000.0, "year", "EUR", None), (1800.0, "month", "EUR", "net"), (15.0, "hour", "EUR", "gross"), (250.0, "year", "EUR", None), (2000000.0, "year", "EUR", None), (1500.0, "month", "EUR", "gross"), (70.0, "day", "EUR", None)]
    data = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, v double, p string, c string, g string")
    got = [r["x"] for r in data.select("i", pay.annualize(F.col("v"), F.col("p"), F.col("c"), F.col("g"), F.lit(14)).alias("x")).orderBy("i").collect()]
    assert got == [28000, 35000, None, None, None, None, 21000, None]


def test_posting_period(spark):
    rows = [("2026-06-07", "2026-10-04T08:00:00Z"), ("2026-01-15", "2026-10-04T08:00:00Z"), ("2024-03-01", "2026-10-04T08:00:00Z"), (None, "2026-10-04"), ("2026-09-31", "2026-10-04")]
    got = many(spark, rules.posting_period(rules.posted_date(F.col("p")), rules.posted_date(F.col("o"))), rows, ["p", "o"])
    assert got == ["post_law", "pre_law", "old", None, None]


def test_seniority(spark):
    rows = {
        "Senior Data Analyst": "senior", "Stage - Marketing": "intern", "CFO Services - Consulente in ambito Finance Transformation - Senior Consultant": "senior",
        "CFO Services – Project Manager Finance Transformation - Consultant": "mid", "Deputy Store Director BOH": "manager", "Group Chief Financial Officer": "executive",
        "Werkstudent Marketing (m/w/d)": "intern", "": "mid",
    }
    assert many(spark, rules.seniority(F.col("t")), [(t,) for t in rows], ["t"]) == list(rows.values())


def test_experience(spark):
    rows = {"Requisiti: Da 3 a 6 anni di esperienza nel ruolo": 3, "Il Gruppo, con quasi 150 anni di esperienza": None, "at least 4 years": 4, "": None}
    assert many(spark, rules.experience_years(F.col("t")), [(t,) for t in rows], ["t"]) == list(rows.values())
    got = one(spark, rules.seniority_with_source(F.col("t"), F.col("d")), t="Data Analyst", d="Cerchiamo 1-2 anni di esperienza")
    assert tuple(got) == ("junior", "experience", 1)


def test_functions_and_contracts(spark):
    titles = {"Addetti/e Vendita Mantova": "retail", "Change Management Consultant": "consulting", "Werkstudent Marketing (m/w/d)": "marketing", "": "other"}
    assert many(spark, rules.job_function(F.col("t")), [(t,) for t in titles], ["t"]) == list(titles.values())
    rows = [(None, "Marketing Intern", None), (None, "Operaio", "sostituzione di tubazioni stradali"), (None, "Werkstudent Marketing (m/w/d)", None), ("Tempo indeterminato", "x", None)]
    assert many(spark, rules.contract_type(F.col("e"), F.col("t"), F.col("d")), rows, ["e", "t", "d"]) == ["internship", None, "internship", "permanent"]
    assert one(spark, rules.work_schedule(F.lit(None).cast("string"), F.col("t"), F.lit("")), t="Cassiere part time") == "part_time"
    assert one(spark, rules.is_open_application(F.col("t")), t="AUTOCANDIDATURA") is True


def test_workplace(spark):
    rows = [("On-site", None, "smart working", "x"), (None, None, "Modalità di lavoro: ibrida. Altro", "x"), (None, None, "", "Lavapiatti"), (None, None, "in presenza di esperienza professionale pregressa", "Analyst")]
    got = many(spark, rules.workplace_with_source(F.col("a"), F.col("l"), F.col("d"), F.col("t")), rows, ["a", "l", "d", "t"])
    assert [tuple(x) for x in got] == [("onsite", "ats"), ("hybrid", "text"), ("onsite", "role"), (None, None)]


def test_language(spark):
    assert one(spark, rules.description_lang(F.col("t")), t="Wir suchen für unser Team eine Person, die mit uns und der Gruppe ist und auf das Ziel achtet") == "de"
    assert one(spark, rules.description_lang(F.col("t")), t="the and") is None


def test_names(spark):
    assert one(spark, ids.company_id(F.col("n")), n="D'Amico S.p.A.") == "damico-spa"
    assert one(spark, ids.candidate_slugs(F.col("n"), F.col("w")), n="Banca Esempio S.p.A.", w="https://www.bancaesempio.it")[:2] == ["bancaesempio", "banca-esempio"]
    assert many(spark, ids.domain_root(F.col("w")), [("https://group.examplebank.com/it",), ("",), (None,), ("localhost",)], ["w"]) == ["examplebank", None, None, None]
    assert one(spark, ids.name_match(F.col("n"), F.lit(None).cast("string"), F.array("t")), n="Banca Esempio", t="Esempio cerca un analista") == "weak"
    assert one(spark, ids.name_match(F.col("n"), F.lit(None).cast("string"), F.array("t")), n="Banca Esempio", t="Lavora in Banca Esempio") == "strong"
    assert tuple(one(spark, ids.workday_parts(F.col("u")), u="https://acme.wd103.myworkdayjobs.com/it-IT/AcmeCareers")) == ("acme.wd103.myworkdayjobs.com", "acme", "AcmeCareers")
    assert one(spark, ids.oracle_parts(F.col("u")), u="https://h.example.com/hcmUI/CandidateExperience/it/sites/CX_1/job/12")["site"] == "CX_1"
    assert "acme" in one(spark, ids.workday_tenants(F.col("n"), F.lit(None).cast("string")), n="Acme Group")


def test_more_places(spark):
    found = many(spark, places.is_italy(F.col("l"), F.lit(None).cast("string")), [("Mantova",), ("Reggio Emilia",), ("L'Aquila",), ("Pavia (PV)",), ("Paris",)], ["l"])
    assert found == [True, True, True, True, False]
    assert one(spark, places.scope_country(F.col("l"), F.lit(None).cast("string")), l="Nice, Provence-Alpes-Côte d Azur") == "FR"


def test_the_first_band_counts():
    text = "Italy: 61,600 EUR - 92,400 EUR. Later, Italy: €50,000 - 60,000"
    assert (pay.parse(text, "IT")["min"], pay.parse(text, "IT")["max"]) == (61600, 92400)
    assert pay.number("1.224.0") == 1224


def test_text(spark):
    scrubbed = one(spark, text.scrub_personal_data(F.col("t")), t="Scrivi a mario.rossi@azienda.it o chiama +39 02 1234 5678")
    assert "@" not in scrubbed and "1234" not in scrubbed
    assert one(spark, text.clean_html(F.col("t")), t="&lt;b&gt;a&amp;amp;b&lt;/b&gt;  c&nbsp;<i>d</i>") == "a&amp;b c d"
    assert many(spark, text.normalize_text(F.col("t")), [("D'Amico S.p.A.",), ("Città  di Forlì",), (None,), ("",)], ["t"]) == ["damico s p a", "citta di forli", "", ""]
    assert one(spark, text.keyword_context(F.col("t"), "(?i)salary"), t="no  word") == ""
    assert one(spark, text.join_notes(F.array("t", F.lit("b"), F.lit("b"))), t="a") == "a | b"


def test_entities_that_were_cut_off(spark):
    cut = "<title>a&amp;&amp</title>&copy; &copy=1 &ampx; &#8364; &nosuch; &a"
    assert one(spark, text.clean_html(F.col("t"), closed=True), t=cut) == "a&&amp © &copy=1 &ampx; € &nosuch; &a"
    assert one(spark, text.clean_html(F.col("t")), t=cut) == "a&& © ©=1 &x; € &nosuch; &a"


GAZETTEER = [
    ("IT-015146", "Milano", "Lombardia", "03", "IT", 1_300_000), ("IT-015209", "Sesto San Giovanni", "Lombardia", "03", "IT", 80_000), ("IT-058091", "Roma", "Lazio", "12", "IT", 2_700_000),
    ("DE-09162", "München", "Bayern", "DE2", "DE", 1_500_000), ("DE-1", "Winzig", "Bayern", "DE2", "DE", 900),
]


def test_places(spark):
    gazetteer = spark.createDataFrame(GAZETTEER, "location_id string, city string, region string, region_code string, country_code string, population long")
    rows = {
        ("Milan, Lombardy, Italy", None): "IT-015146", ("Sesto San Giovanni (MI)", None): "IT-015209", ("Remote - Italy", None): "IT-REMOTE", ("Remote, EMEA", None): "EU-REMOTE", ("Anywhere in Québec", None): None,
        ("London, United Kingdom", "GB"): None, ("Lombardy", None): "IT-REG-03", ("München", "DE"): "DE-09162", ("Winzig office", "DE"): "DE", ("Bayern", "DE"): "DE-REG-DE2", (None, "IT"): "IT", ("Remote", "NL"): "NL-REMOTE",
    }
    data = spark.createDataFrame([(i, *k, None) for i, k in enumerate(rows)], "i int, raw string, country string, workplace string")
    got = [r["location_id"] for r in places.geocode(data, gazetteer).orderBy("i").collect()]
    assert got == list(rows.values())
    assert places.special_places(gazetteer).where("location_id = 'IT-REG-03'").count() == 1


def test_scope(spark):
    rows = {("Munich, Bavaria", None): "DE", (None, "NLD"): "NL", ("Paris La Défense", None): "FR", ("Milan, Lombardy", None): "IT", ("London, United Kingdom", None): None}
    assert many(spark, places.scope_country(F.col("l"), F.col("c")), list(rows), ["l", "c"]) == list(rows.values())


def test_sql_functions(spark):
    from wagewright.functions import sql

    assert "pay_parse" in sql.register(spark)
    row = spark.sql("SELECT pay_size_band(60000) a, pay_annual(2000, 'month', NULL, 'gross', 14) b, pay_annual(2000, 'month', 'EUR', 'net', 14) c, pay_share(1, 8) d, pay_shown(35000, 40000) e, pay_parse('RAL 35.000 €', 'IT').min f").first()
    assert tuple(row) == ("medium", 28000, None, 12.5, "€35,000 - €40,000", 35000)
