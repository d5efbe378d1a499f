"""Rare toxic labels give a model or a loud error, never an empty model without a word."""

import random

import pytest
from pyspark.sql import functions as F

from attestry.llm import samples, toxicity

DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"


def made(spark, toxic, clean, marked):
    rng = random.Random(6)
    ids = list(range(toxic + clean))
    docs = [
        (k, " ".join(f"w{rng.randrange(300)}" for _ in range(30)) + (" vileword and hatefulness" if n < toxic and marked else ""))
        for n, k in enumerate(ids[: toxic + clean])
    ]
    labels = [(k, int(n < toxic)) for n, k in enumerate(ids[: toxic + clean])]
    return spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)


def test_few_toxic_labels_among_many_clean_ones_make_a_model(spark):
    docs, labels = made(spark, 4, 2_000, True)
    model = toxicity.train(docs, labels)
    found = {r.doc_id for r in toxicity.severity(docs, model).where("toxic").collect()}
    assert len(model.features) and found == {0, 1, 2, 3}


def test_toxic_labels_that_nothing_marks_are_an_error(spark):
    docs, labels = made(spark, 3, 300, False)
    with pytest.raises(ValueError, match="no feature marks them"):
        toxicity.train(docs, labels)


def test_classes_fill_their_halves_and_keep_their_weights(spark):
    docs, labels = made(spark, 40, 400, True)
    sample = samples.sample_by_class(docs, labels, "toxic", 100)
    got = {r.label: (r.n, r.weight) for r in sample.groupBy("label").agg(F.count("text").alias("n"), F.sum("weight").alias("weight")).collect()}
    held = lambda low, high: docs.where((docs.doc_id >= low) & (docs.doc_id < high) & ~samples.held_out(docs.doc_id)).count()
    toxic, clean = held(0, 40), held(40, 440)
    assert got[1] == (toxic, toxic) and got[0][0] == 50 and got[0][1] == pytest.approx(clean)
    odd = spark.createDataFrame([(0, None), (None, 1), (1, 7), (2, 1), (2, 0), (10**6, 1)], LABELS)
    assert {r.label for r in samples.sample_by_class(docs, odd, "toxic").collect()} <= {1}
    assert samples.sample_by_class(docs, odd.where("doc_id > 10"), "toxic").collect() == []
