import collections
import os
import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pipeline(spark):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF).persist()
        assert after.columns == docs.columns, name
        assert 0 < after.count() <= before, name
        docs, before = after, after.count()
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Labels and a benchmark, and documents with nulls, repeats, a very long text and clashing columns."""
    rng = random.Random(2)
    words = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    good = [(i, words(60)) for i in range(120)]
    bad = [(i, " ".join(w.upper() + "!!" for w in words(60).split())) for i in range(200, 300)]
    path = str(tmp_path_factory.mktemp("tables"))
    item = words(14)
    spark.createDataFrame([(1, item), (2, None), (None, "x y"), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 0), (400, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    line = "subscribe to our weekly letter for more of the same"
    rows = [*good, *bad, (400, None), (401, ""), (None, None), (None, good[0][1]), (500, words(20_000)), (501, f"{good[1][1]} tail"), (502, words(30) + " " + item.upper() + " " + words(9)), (503, words(40) + "\n" + line), (504, words(40) + "\n" + line), (5, good[5][1]), (5, words(50))]
    schema = "doc_id long, text string, lang string, source string, n_chars int, node long, score double, n string, rank int"
    return path, spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, 0.1, "n", 3) for i, t in rows], schema)


def test_stages_on_odd_rows(spark, tables):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    path, docs = tables
    stages = dict(corpus_pipeline.STAGES)
    key = lambda df: collections.Counter((r["doc_id"], r["text"]) for r in df.collect())
    before = key(docs)

    kept = stages["quality classifier"](spark, docs, path)
    assert kept.columns == docs.columns and kept.where("doc_id between 200 and 299").count() == 0 and kept.where("doc_id < 120 and doc_id <> 5").count() >= 115
    assert all(before[k] == n for k, n in key(kept).items())

    lines = stages["line dedup"](spark, docs, path)
    assert lines.schema["n_chars"].dataType == docs.schema["n_chars"].dataType and lines.columns == docs.columns and lines.count() == docs.count()
    assert lines.where("n_chars <> length(text)").count() == 0 and lines.where("text is null").count() == 2
    assert [lines.where(f"doc_id = {i} and text like '%subscribe%'").count() for i in (503, 504)] == [1, 0]

    near = stages["SimHash near-dedup"](spark, docs, path)
    left = key(near)
    assert near.columns == docs.columns and max(left.values()) == 1
    assert sum(1 for (i, t) in left if not t) == 1 and (None, before and docs.where("doc_id = 0").first()["text"]) not in left
    assert not near.where("doc_id = 501").count() and near.where("doc_id = 5").count() == 2 and near.where("doc_id = 500").count() == 1

    clean = stages["benchmark decontamination"](spark, docs, path)
    assert clean.columns == docs.columns and key(clean) == collections.Counter({k: n for k, n in before.items() if k[0] != 502})

    packed = stages["best-fit packing"](spark, docs, path)
    assert packed.where("piece = 0").count() == docs.count()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), path).count() == 0, name
