"""The stream with state against the merge of snapshots one by one, with a restart, failures and lost marks."""

import random

from wagewright.operators import history
from wagewright.streaming import stateful


def test_stream_equals_merges(spark, tmp_path):
    rng = random.Random(9)
    source, sink, checkpoint = (str(tmp_path / x) for x in ("in", "out", "check"))
    days = [f"2024-01-{d:02d}" for d in range(1, 13)]
    stored = spark.createDataFrame([], "board string, job_key string, first_seen string, last_seen string, is_active int, pay double")
    for i, day in enumerate(days):
        ads = [(b, f"{b}|{j}", day, n, float(rng.randint(1, 9)), None) for b in "ab" for j in range(12) for n in range(2) if rng.random() < 0.5]
        if i == 5:
            ads = [a for a in ads if a[0] != "a"]  # an empty board
        ok = {"a": i != 3, "b": i not in (6, 7)}
        marks = [(b, None, day, None, None, ok[b]) for b in "ab" if not (b == "b" and i == 6)]  # and one whose mark never comes
        spark.createDataFrame(ads + marks, stateful.EVENTS).coalesce(1).write.mode("append").parquet(source)
        boards = spark.createDataFrame(list(ok.items()), "board string, ok boolean")
        seen = spark.createDataFrame(ads, stateful.EVENTS).drop("ok", "day")
        stored = spark.createDataFrame(history.merge_snapshot(stored, seen, boards, day).collect(), stored.schema)
        if i in (4, 11):  # the stream stops and goes on from its checkpoint
            stateful.follow(spark, source, sink, checkpoint, files_at_once=3, buckets=2).awaitTermination()
    got = {tuple(r) for r in stateful.state(spark, sink).select(*stored.columns).collect()}
    assert got == {tuple(r) for r in stored.collect()}


def test_state_is_asked_for_by_parts(spark, tmp_path, monkeypatch):
    """Ads of a batch take as many calls of state as there are parts, not as ads."""
    calls = tmp_path / "calls"
    calls.mkdir()
    source, sink, checkpoint = (str(tmp_path / x) for x in ("in", "out", "check"))

    class Counted(stateful.Snapshots):
        def init(self, handle):
            super().init(handle)
            for state in (self.ads, self.waiting):
                for name in ("getValue", "containsKey", "updateValue"):
                    setattr(state, name, self.counted(getattr(state, name)))

        def counted(self, call):
            def one(*args):
                with (calls / "n").open("a") as f:
                    f.write(".")
                return call(*args)

            return one

    monkeypatch.setattr(stateful, "Snapshots", Counted)
    ads = [("a", f"a|{i}", day, i, 1.0, None) for day in ("2024-01-01", "2024-01-02") for i in range(3000)]
    marks = [("a", None, day, None, None, True) for day in ("2024-01-01", "2024-01-02")]
    spark.createDataFrame(ads + marks, stateful.EVENTS).coalesce(1).write.parquet(source)
    stateful.follow(spark, source, sink, checkpoint, buckets=1).awaitTermination()
    assert stateful.state(spark, sink).where("is_active = 1 and last_seen = '2024-01-02'").count() == 3000
    assert len((calls / "n").read_text()) < 500
