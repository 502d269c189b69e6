"""The corpus pipeline, stage by stage, against plain versions on a small table with awkward rows and columns."""

import brute
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tierflow.llm import minhash, mixing, quality

CLASHES = ("size", "target", "taken", "source_no", "score", "shard_no", "row", "mark", "node", "uid", "__epoch", "words.in")


@pytest.fixture(scope="module")
def data():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet")
    some = rows.where("doc_id < 4")
    more = [some.withColumn("doc_id", F.col("doc_id") + 900_000), some, some.withColumn("text", F.lit(None).cast("string")), some.withColumn("doc_id", F.lit(None).cast("long"))]
    for other in more:
        rows = rows.unionByName(other)
    return rows.withColumns({c: F.lit("x") for c in CLASHES})


def rows_of(df, columns=("doc_id", "text", "source")):
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in df.select(*columns).toPandas().itertuples(index=False, name=None)), key=str)


def test_an_id_with_two_texts_loses_none(spark):
    first, second = ("one two three four five six", "seven eight nine ten eleven twelve")
    rows = spark.createDataFrame([(1, first), (1, second), (2, second), (2, second), (None, second), (3, "a"), (3, "a")], "doc_id long, text string")
    kept = rows_of(minhash.keep_one(rows), ("doc_id", "text"))
    assert kept == sorted([(1, first), (1, second), (None, second), (3, "a")], key=str)


def test_near_duplicates_stage(spark, docs, data):
    got = rows_of(corpus_pipeline.drop_near_duplicates(spark, docs, data))
    rows = rows_of(docs)
    named = sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], r[1] or ""))
    of = brute.near_duplicates([((r[0], r[1] or "", n), r[1]) for n, r in enumerate(named)], width=5)
    best = {}
    for n, r in enumerate(named):
        best.setdefault(of[r[0], r[1] or "", n][1], set()).add(r[0])
    assert [r for r in got if r[0] is None] == [r for r in rows if r[0] is None]
    kept = [r for r in got if r[0] is not None]
    groups = [of[r[0], r[1] or "", named.index(r)][1] for r in kept]
    assert sorted(groups) == sorted(best) and all(r[0] == min(best[g]) for r, g in zip(kept, groups))


def test_leak_stage(spark, docs, data):
    items = pd.read_parquet(f"{data}/benchmark.parquet")[["item_id", "text"]].itertuples(index=False, name=None)
    rows = rows_of(docs)
    hit = brute.decontaminate(list(enumerate(r[1] for r in rows)), list(items))
    assert rows_of(corpus_pipeline.drop_leaks(spark, docs, data)) == [r for n, r in enumerate(rows) if not hit[n][4]]


def test_mixing_stage_keeps_columns_and_counts(spark, docs, data):
    mixed = corpus_pipeline.mix_sources(spark, docs, data)
    assert mixed.columns == docs.columns
    plain = mixing.mix(docs, mixing.word_count(F.col("text"))).toPandas()
    words = mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert words == plain["taken"].sum() and mixed.where("size <> 'x' OR target <> 'x' OR taken <> 'x'").count() == 0


@pytest.mark.parametrize("rows", [10_000, 7])
def test_the_cut_is_found_in_steps(spark, docs, monkeypatch, rows):
    monkeypatch.setattr(mixing, "ONE_TASK_ROWS", rows)
    got = mixing.mix(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), mixing.word_count(F.col("text"))).toPandas()
    order = []
    for r in got.itertuples():
        order += [(r, epoch) for epoch in range(3) if r.size]
    assert got["taken"].sum() <= got["size"].sum() and got["taken"].sum() > got["size"].sum() - got["size"].max()
    assert (got["taken"] <= 3 * got["size"]).all()


def test_quality_stage_and_the_whole_run(spark, docs, data):
    good = rows_of(corpus_pipeline.keep_good(spark, docs, data))
    features = docs.select("doc_id", "text", "source", quality.statistics("text").alias("features"))
    model = quality.train(features.select("doc_id", "features"), spark.read.parquet(f"{data}/labels.parquet"))
    scored = features.withColumn("good", model.score(F.col("features")) >= quality.THRESHOLD)
    assert good == rows_of(scored.where("good")) and len(good) < docs.count()
    whole = corpus_pipeline.run(spark, data).toPandas()
    assert len(whole) and whole["shard"].between(0, corpus_pipeline.SHARDS - 1).all()
    assert set(whole["doc_id"]) <= set(pd.read_parquet(f"{data}/documents.parquet")["doc_id"])
