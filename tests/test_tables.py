"""Merges with commit: conflicts, disjoint writers, whole versions."""

import pytest

from wagewright.operators.history import upsert
from wagewright.schema import TABLES, conform
from wagewright.tables import KEYS, ConflictError, Table

SEARCHES = "search_id long, search_term string, n_jobs long"


def rows(spark, *own):
    return spark.createDataFrame(list(own), SEARCHES)


def held(table, version=None):
    return {(r["search_id"], r["search_term"], r["n_jobs"]) for r in table.read(version).collect()}


def test_merges(spark, tmp_path):
    assert set(KEYS) == set(TABLES)
    table = Table(spark, str(tmp_path), "searches", parts=3)
    assert held(table) == set() and table.upsert(rows(spark).limit(0)) == 0
    assert table.upsert(rows(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3))) == 1
    assert table.upsert(rows(spark, (2, None, 5), (9, "z", 9))) == 2
    assert held(table) == {(1, "a", 1), (2, None, 5), (3, "c", 3), (9, "z", 9)}
    assert held(table, 1) == {(1, "a", 1), (2, "b", 2), (3, "c", 3)}
    table.insert_or_ignore(rows(spark, (1, "no", 0), (4, "second", 2), (4, "first", 1)), "n_jobs")
    assert held(table) == {(1, "a", 1), (2, None, 5), (3, "c", 3), (9, "z", 9), (4, "first", 1)}
    assert table.vacuum(keep=1) > 0 and (4, "first", 1) in held(table)
    children = Table(spark, str(tmp_path), "job_locations", parts=2)
    place = lambda *own: conform(spark.createDataFrame(list(own), "job_key string, location_raw string, location_id string"), "job_locations")
    children.replace_children(place(("k", "Milan", "1"), ("k", "Rome", "2"), ("j", "Bonn", "3")))
    children.replace_children(place(("k", "Paris", "4")))
    assert {(r["job_key"], r["location_raw"]) for r in children.read().collect()} == {("k", "Paris"), ("j", "Bonn")}


def test_no_writer_loses_rows(spark, tmp_path):
    """Another merge commits between reading and committing: of the same parts (done again), and of others (named again)."""
    for parts in (1, 64):
        one, two = (Table(spark, str(tmp_path / str(parts)), "searches", parts) for _ in range(2))
        one.upsert(rows(spark, (1, "a", 1), (2, "b", 2)))
        calls = []

        def made(old, new, one=one, two=two, calls=calls):
            calls.append(1)
            if len(calls) == 1:
                two.upsert(rows(spark, (2, "two", 20), (5, "two", 50)))
            return upsert(old, new, one.keys)

        assert one.change(rows(spark, (1, "one", 10)), made) == 3
        assert held(one) == {(1, "one", 10), (2, "two", 20), (5, "two", 50)}
        assert len(calls) == (2 if parts == 1 else 1)
        assert held(one, 2) == {(1, "a", 1), (2, "two", 20), (5, "two", 50)}


def test_a_merge_gives_up(spark, tmp_path):
    table, other = (Table(spark, str(tmp_path), "searches", 1) for _ in range(2))

    def made(old, new):
        other.upsert(rows(spark, (1, "other", 0)))
        return upsert(old, new, table.keys)

    with pytest.raises(ConflictError):
        table.change(rows(spark, (1, "mine", 1)), made, attempts=2)
    assert held(table) == {(1, "other", 0)}
