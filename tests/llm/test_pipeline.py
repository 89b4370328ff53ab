import os
import random
from collections import Counter

import pandas as pd
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from compare import compare, connect
from paperloom.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR).toArrow(), connect(SF_DIR), ORACLE_SQL[name]) is None


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(oracle_sql())


def test_stages_over_odd_rows(spark, odd_docs, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        if name == "language":
            assert {2, 3, 4, 5}.isdisjoint(r.doc_id for r in docs.collect())
        if name == "near_duplicates":
            kept = Counter(r.text for r in docs.collect())
            assert max(kept.values()) == 1
    assert docs.count() > 0


def test_a_worker_gets_little_text_at_a_time(spark, tmp_path, monkeypatch):
    """A split of texts is not one batch, neither in rows nor in bytes, and the session is as before after a run."""
    for key in corpus_pipeline.BATCHES:  # earlier tests may have run a stage
        spark.conf.unset(key)
    rows = [(i, "ab cd " * (20_000 if i % 20 else 1), "en", "s", 1) for i in range(100)] + [(i, "ab", "en", "s", 1) for i in range(100, 4000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pd.DataFrame({"n": [len(b)], "size": [int(b["text"].str.len().sum())]})

    def stage(spark, docs, sf_dir):
        return docs.mapInPandas(sizes, "n long, size long")

    try:
        found = corpus_pipeline.in_small_batches(stage)(spark, docs, SF_DIR).collect()
    finally:
        for key in corpus_pipeline.BATCHES:
            spark.conf.unset(key)
    assert sum(r.n for r in found) == len(rows)
    assert max(r.n for r in found) <= 1024 and max(r["size"] for r in found) <= 5 << 20
    assert all(hasattr(run, "__wrapped__") for _, run in corpus_pipeline.STAGES)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", corpus_pipeline.in_small_batches(stage))])
    assert max(r.n for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) <= 1024
    assert all(spark.conf.get(key, None) is None for key in corpus_pipeline.BATCHES)


def test_noise_and_foreign_texts_go_and_clean_ones_stay(spark):
    rng = random.Random(3)
    syllables = {"aa": ["ka", "ri", "to", "mun", "el"], "bb": ["ost", "vre", "zug", "hin", "pf"]}

    def text(parts, n):
        return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))

    clean = [(i, text(syllables[lang], rng.choice((1, 3, 40, 200))), lang, "s", 0) for i in range(300) for lang in ["aa" if i % 2 else "bb"]]
    noise = ["".join(rng.choices("qwxyjdcbsäß   ", k=600)) for _ in range(20)] + [text(["жы", "щур", "ло", "бг"], 150) for _ in range(20)]
    rows = clean + [(1000 + i, t, None, "s", 0) for i, t in enumerate(noise)] + [(2000, "123 !!", "aa", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, docs, SF_DIR).collect()}
    assert {r[0] for r in clean} <= kept
    assert len(kept - {r[0] for r in clean}) <= 2


def test_planted_copies_and_passages(spark):
    """Of texts that are equal or nearly so one stays; a passage stays where it comes first."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    texts = {i: rng.choices(words, k=150) for i in range(40)}
    for i in (1, 2, 3):  # near copies of text 0: one word of 150 differs
        texts[i] = texts[0][:70] + [f"new{i}"] + texts[0][71:]
    texts[5] = list(texts[4])
    passage = rng.choices(words, k=60)
    texts[10], texts[20] = texts[10] + passage, texts[20][:50] + passage + texts[20][50:]
    rows = [(i, " ".join(t), "en", "s", 0) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert {r.doc_id for r in kept.collect()} == set(range(40)) - {1, 2, 3, 5}
    cut = {r.doc_id: r.text.split() for r in corpus_pipeline.cut_repeated_passages(spark, kept, SF_DIR).collect()}
    assert cut[10] == texts[10] and cut[20] == texts[20][:50] + texts[20][110:]
    assert all(cut[i] == texts[i] for i in cut if i != 20)


def test_whole_run(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "sequence_id", "offset", "ids"} <= set(found.columns)
    assert found.count() > 100


def test_empty_documents(spark, no_docs, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(os.path.join(tmp_path, "labels.parquet"))
    docs = no_docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() == 0
