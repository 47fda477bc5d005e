"""The pipeline's stages on the smallest tables and on difficult rows."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from reelgauge.llm import mixing, quality

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stages.stored(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] > counts[3] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048
    assert set(packed["doc_id"]) == {r[0] for r in docs.select("doc_id").distinct().collect()}


def test_difficult_rows(spark, corpus, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda frame: sorted((r["doc_id"] for r in frame.select("doc_id").collect()), key=repr)
    good = stages["quality_rules"](spark, corpus, FOLDER)
    # Null, empty and short texts go, those of 30,000 and of 54 words stay, with their repeated rows.
    assert not {0, 1, 2, 3, 14, 15, None} & set(ids(good)) and good.columns == corpus.columns
    judged = {(r["doc_id"], r["kept"]) for r in quality.judged(corpus, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
    assert ids(good) == ids(corpus.join(spark.createDataFrame([(i,) for i, kept in judged if kept], "k long"), F.col("doc_id") == F.col("k"), "left_semi"))
    spoken = stages["language_id"](spark, corpus, FOLDER)
    assert spoken.columns == corpus.columns and not {0, 1, 2, 15} & set(ids(spoken))
    single = stages["near_duplicates"](spark, corpus, FOLDER)
    # 5 repeats 4, 12 repeats 6 and 13 is near it, and the rows of 6 are one document.
    assert ids(single) == ids(corpus.where("doc_id is null or doc_id not in (5, 12, 13)").dropDuplicates(["doc_id"]))
    copies = {r["doc_id"]: r["copies"] for r in mixing.copies(corpus.where("doc_id is not null")).collect()}
    assert not {0, 1, 2} & set(ids(stages["mixing"](spark, corpus, FOLDER))) and copies
    pieces = stages["packing"](spark, corpus, FOLDER).toPandas()
    assert set(pieces["doc_id"].dropna().astype(int)) == set(range(16)) and pieces["doc_id"].isna().any()
    one = corpus_pipeline.stages.near_duplicates(spark, corpus.where("doc_id = 6"), FOLDER)
    assert one.count() == 1


def test_language_stage_rejects_what_it_has_not_learned(spark):
    random = np.random.default_rng(6)
    stems = {"en": "the of and is not with from have this that".split(), "de": "der die das und ist nicht mit von haben dies".split()}
    clean = [(lang, n) for n in (3, 8, 30, 100) for lang in ("en", "de", "en") for _ in range(40)]
    texts = [" ".join(random.choice(stems[lang], n)) for lang, n in clean]
    odd = [" ".join("".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(n)) for n in (5, 20, 80)]
    odd += ["kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan", "все люди рождаются свободными и равными"]
    rows = [(i, t, lang) for i, (t, (lang, _)) in enumerate(zip(texts, clean))] + [(1000 + i, t, None) for i, t in enumerate(odd)]
    for some in (("en", "de", None), ("en", None)):
        docs = spark.createDataFrame([r for r in rows if r[2] in some], "doc_id long, text string, lang string")
        kept = {r["doc_id"] for r in corpus_pipeline.stages.language_id(spark, docs, FOLDER).collect()}
        known = {r[0] for r in rows if r[2] and r[2] in some}
        assert not kept - known and len(known - kept) <= 0.02 * len(known)
