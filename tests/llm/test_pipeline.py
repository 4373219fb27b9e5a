"""Every stage of the pipeline against the operator's own verdicts on the stage's input."""

import __spark_entry__ as entry
import corpus_pipeline
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelloom.llm import classifier, decontaminate, mixing, near_dedup

FOLDER = "/root/testdata/sf0.001"


def ids(frame):
    return sorted(r[0] for r in frame.select("doc_id").collect())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        frames.append((docs, docs := spark.read.parquet(str(tmp_path / name))))
    assert all(after.columns == columns for _, after in frames[:-1])
    (all_docs, good), (_, distinct), (_, clean), (_, mixed), (_, sharded) = frames
    labels, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))
    assert ids(good) == ids(classifier.classify(all_docs, labels).where("predicted = 1"))
    assert ids(distinct) == ids(near_dedup.near_duplicates(good).where("kept"))
    assert ids(clean) == ids(decontaminate.search(distinct, items).where(F.size("items") == 0))
    taken = mixing.mix(clean).toPandas()
    times = pd.Series(ids(mixed)).value_counts()
    for row in taken[taken["size"] > 0].itertuples():
        assert abs(times.get(row.doc_id, 0) - row.taken / row.size) <= 0.5
    assert sorted(ids(sharded)) == ids(mixed) and {"shard", "slot"} <= set(sharded.columns)
    assert corpus_pipeline.run(spark, FOLDER).count() == mixed.count()


def words_kept(spark, sizes, slack):
    """Words per source after the mix against its target, for texts of the given numbers of words."""
    rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate((s, n) for s, of in sizes.items() for n in of)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = {r.source: r.target for r in mixing.mix(docs, carried=["source"]).toPandas().itertuples()}
    kept = corpus_pipeline.target_mix(spark, docs, "").select("source", mixing.word_count("text").alias("n")).toPandas().groupby("source").n.sum()
    for source, target in targets.items():
        assert abs(kept.get(source, 0) - target) <= slack, (source, kept.get(source, 0), target)


def test_mix_keeps_words_of_few_documents(spark):
    words_kept(spark, {"a": [100] * 40, "b": [100] * 12, "c": [90] * 300, "d": [100] * 40}, 60)


def test_mix_keeps_words_beside_a_very_long_document(spark):
    for long in range(3):
        words_kept(spark, {"a": [40] * 30 + [4000 + long] + [40] * 30, "b": [40] * 200, "c": [41] * 700 + [9000], "d": [40] * 30 + [5000 + long]}, 80)


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size string, copies string, score string, predicted string, "
          "slot string, _row string, _id string, `a b.c` string")


def odd_documents(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, "x", "y", "z", "p", "q", "r", "i", "d") for i, t, s in rows], SCHEMA).repartition(3)


A, B = (" ".join(f"{name}{i}" for i in range(40)) for name in "ab")


def test_no_text_is_lost_with_an_id(spark):
    docs = odd_documents(spark, [(1, A, "s"), (2, A, "s"), (2, B, "s"), (3, B, "t"), (5, B, None), (5, B, None), (7, A + " end", "s"), (None, A, "s"),
                                 (None, "no id " + B[:90], "s"), (8, "", "s"), (8, "", "s"), (9, None, None), (9, " ", None)])
    kept = corpus_pipeline.distinct_texts(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert found == sorted([(1, A), (2, B), (None, "no id " + B[:90]), (8, ""), (9, None), (9, " ")], key=str)


def test_repeated_rows(spark):
    docs = odd_documents(spark, [(1, A, "s"), (1, A, "s"), (2, A, "s"), (None, B, "s"), (None, B, "s")])
    assert sorted(((r.doc_id, r.text) for r in corpus_pipeline.distinct_texts(spark, docs, FOLDER).collect()), key=str) == [(1, A), (None, B)]


def test_odd_rows_and_names_in_every_stage(spark):
    docs = odd_documents(spark, [(1, A, "s"), (1, A, "s"), (2, B, None), (2, A + " x", "t"), (None, A, "s"), (None, None, None), (3, "", "t"), (4, "word " * 60_000, "t")])
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, frame, FOLDER)
            rows = after.collect()
            assert bool(rows) or frame is not docs or name == "quality", name
            if name != "shard":
                assert after.columns == docs.columns
                assert {tuple(r) for r in rows} <= {tuple(r) for r in docs.collect()}
            else:
                assert {"shard", "size", "input_size", "input_slot"} <= set(after.columns) and len(rows) == frame.count()


def shuffled_bytes(frame):
    """What the shuffles of a frame's final plan write."""
    frame.collect()
    plans, found = [frame._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            found += plan.metrics().apply("dataSize").value()
        inner = {"AdaptiveSparkPlanExec": "executedPlan", "ResultQueryStageExec": "plan", "ShuffleQueryStageExec": "plan", "BroadcastQueryStageExec": "plan"}.get(kind)
        children = plan.children()
        plans += [getattr(plan, inner)()] if inner else [children.apply(i) for i in range(children.size())]
    return found


@pytest.mark.parametrize("stage", [corpus_pipeline.distinct_texts, corpus_pipeline.without_benchmark, corpus_pipeline.target_mix])
def test_whole_texts_are_not_shuffled(spark, stage, tmp_path):
    rows = [(i, " ".join(f"{(0 if i % 20 == 1 else i)}x{j}" for j in range(2000)), None, f"s{i % 3}") for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert shuffled_bytes(stage(spark, docs, FOLDER)) < 0.25 * sum(len(r[1]) for r in rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("ids", [lambda i: i, lambda i: None, lambda i: i // 50])
def test_whole_copies_are_those_of_the_tape(spark, ids):
    """Copies of documents against those decided row by row, for ids that are unique, missing and repeated."""
    rows = [(ids(i), " ".join(["w"] * (0 if i % 31 == 0 else 5 + i * i % 90)), "abc"[i % 3] if i % 5 else None, i) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n long").repartition(3)
    found = mixing.whole_copies(docs, carried=["n", "source", "doc_id", "text"]).toPandas()
    assert sorted(found["n"]) == list(range(1500))
    narrow = mixing._copies(mixing._mixed(docs, [], mixing.BLOCK, mixing.SLICES, mixing.SEED, mixing.MOST_REPEATS, mixing.WEIGHTS, None), mixing.MOST_REPEATS)
    wanted = narrow.selectExpr("_source.name AS source", "_id AS doc_id", "size", "copies").toPandas()
    found = found.assign(size=found["text"].str.split().str.len(), source=found["source"].fillna(""))
    for frame in (found, wanted):
        frame["doc_id"] = frame["doc_id"].fillna(-1).astype(int)
    listed = [sorted(map(tuple, f[["source", "doc_id", "size", "copies"]].astype({"size": int, "copies": int}).values.tolist())) for f in (found, wanted)]
    assert listed[0] == listed[1] and len({row[3] for row in listed[0]}) > 1
