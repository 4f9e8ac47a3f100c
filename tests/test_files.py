"""Workbooks and labelled samples."""

from wagewright.plans.file_queries import workbook_bytes
from wagewright.sources import files, workbook


def test_cells():
    assert [workbook.column_number(r) for r in ("A1", "Z9", "AA10", "AB7")] == [0, 25, 26, 27]
    book = workbook_bytes({"DE": [("a", None, 3), (None, 1.5, "x & y")], "skip": [("z",)]})
    got = list(workbook.sheet_rows(book, ["DE"]))
    cell = lambda text, number=None: {"text": text, "number": number}
    assert got == [("DE", 1, [cell("a"), None, cell("3", 3.0)]), ("DE", 2, [None, cell("1.5", 1.5), cell("x & y")])]


def test_workbooks_give_the_rows_of_csv(spark, tmp_path):
    head = ("NUTS", "LAU", "", "NATIONAL", "LATIN", "", "POP")
    units = {"DE": [head, ("DE111", "08111", None, "x", "Stuttgart, Landeshauptstadt", None, 630000), ("DE111", None, None, "no code"), ("DE112", "1", None, "Only national", None, None, "n.a.")], "FR": [head, ("FR101", 75056, None, "Paris", None, None, 2_100_000)], "IT": [head, ("IT", "1", None, "x")]}
    regions = {files.REGION_SHEET: [("code",), ("DE1", None, "Baden-Württemberg"), ("FR1", "Ile de France"), (None, "x")]}
    (tmp_path / "lau.xlsx").write_bytes(workbook_bytes(units))
    (tmp_path / "nuts.xlsx").write_bytes(workbook_bytes(regions))
    got = files.eurostat_workbooks(spark, str(tmp_path / "lau.xlsx"), str(tmp_path / "nuts.xlsx")).select("location_id", "city", "region", "region_code", "population").collect()
    (tmp_path / "lau.csv").write_text("country_code,nuts3,lau_code,name_latin,name,population\nDE,DE111,08111,\"Stuttgart, Landeshauptstadt\",x,630000\nDE,DE111,,,no code,\nDE,DE112,1,,Only national,n.a.\nFR,FR101,75056,,Paris,2100000\n", encoding="utf-8")
    (tmp_path / "nuts.csv").write_text("code,n1,n2,n3,n4\nDE1,,Baden-Württemberg,,\nFR1,Ile de France,,,\n", encoding="utf-8")
    same = files.european_municipalities(files.eurostat_units(spark, str(tmp_path / "lau.csv")), files.eurostat_regions(spark, str(tmp_path / "nuts.csv"))).select("location_id", "city", "region", "region_code", "population").collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in same} and len(got) == 3


def test_labelled_files_each_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿url;giudizio;note\r\nu1;s".encode() + b"\xec" + ';"two\r\nlines; ""q"""\r\n\r\n'.encode())
    (tmp_path / "b.csv").write_text("note,url\nn,u2\nshort\n", encoding="utf-8")
    (tmp_path / "c.csv").write_bytes(b"")
    got = files.labelled_sample(spark, str(tmp_path / "*.csv"))
    assert {(r["url"], r["verdict"], r["notes"]) for r in got.collect()} == {("u1", "sì", 'twolines; "q"'), ("u2", None, "n"), (None, None, "short")}
