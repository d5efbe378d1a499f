"""Line dedup of very long documents: work per line, not per line and text."""

from pyspark.sql import functions as F

from attestry.llm import line_dedup


def long_docs(spark, lines):
    numbers = F.sequence(F.lit(1), F.lit(lines))
    text = F.array_join(F.transform(numbers, lambda i: F.concat(F.lit("this is line number "), i.cast("string"))), "\n")
    return spark.range(3).select(F.col("id").alias("doc_id"), text.alias("text")).repartition(3)


def test_the_text_is_hashed_once_per_document(spark):
    plan = line_dedup.keyed_lines(spark.createDataFrame([(1, "a")], "doc_id long, text string"), 20)
    lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first_generate = next(n for n, line in enumerate(lines) if "Generate" in line)
    assert not any("xxhash64" in line for line in lines[: first_generate])


def test_long_documents_keep_the_right_lines(spark):
    docs = long_docs(spark, 100_000)
    applied = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).collect()
    got = {r.doc_id: (r.n_lines, r.n_dropped, len(r.kept)) for r in applied}
    whole = len(docs.first().text)
    assert got == {0: (100_000, 100_000, 0), 1: (100_000, 100_000, 0), 2: (100_000, 0, whole)}


def test_gaps_between_the_words_of_a_bitmap_keep_their_lines(spark):
    """Dropped lines in the first, third and last word; all others stay in order."""
    shared = {5: "a line that three documents hold", 150: "another line that they all hold", 400: "and one more that they hold"}
    texts = ["\n".join(shared.get(n, f"{doc}:{n}") for n in range(450)) for doc in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.kept for r in line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).collect()}
    for doc in (0, 1):
        assert got[doc] == "\n".join(f"{doc}:{n}" for n in range(450) if n not in shared)
    assert got[2] == texts[2]
