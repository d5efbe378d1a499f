"""Spelling variants: words one edit apart, by asymmetric q-chunks.

A word of length L contributes two disjoint chunks, its halves; other words contribute the grams that
can stand where such a chunk stands. One edit leaves one half untouched, so two words one edit apart
share a chunk and a gram, at the same place or shifted by one. A chunk is named by the gap
``[lo, hi)`` that it leaves open: the edit must lie in that gap.

A chunk that many words share (a common prefix or ending) is refined by its own rule: the gap is
halved, and the half without the edit joins the chunk. In the end a gap has one place, so a crowd
never meets as all pairs: what still meets differs in that place alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.llm.text import ascii_lower
from attestry.session import materialize

RUN = r"[a-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_TIMES = 5, 3
TYPO_EVERY = 97
#: A chunk whose words would meet in more pairs than this is refined.
PAIRS_PER_CHUNK = 256


def corpus_words(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES,
    typo_every: int | None = TYPO_EVERY,
) -> DataFrame:
    """The words of all texts with their numbers of occurrences: word, n.

    Runs of letters are lower-cased in A-Z. If ``typo_every`` divides crc32("<doc_id>:<run>"), the
    run loses one code point, as a reproducible typing error; None, or a null doc_id, changes
    nothing. Null and empty texts have no words; repeated rows count again.
    """
    run, length = F.col("run"), F.char_length("run")
    runs = docs.select(
        F.col("doc_id").alias("doc"),
        F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(RUN), F.lit(0))).alias("run"),
    ).where(length >= least_length)
    if typo_every:
        hashed = F.crc32(F.concat_ws(":", F.col("doc").cast("string"), run))
        at = F.pmod(F.col("hash"), length).cast("int")
        shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, length))
        runs = runs.withColumn("hash", F.when(F.col("doc").isNotNull(), hashed)).select(
            F.when(F.col("hash") % typo_every == 0, shorter).otherwise(run).alias("word")
        )
    else:
        runs = runs.select(run.alias("word"))
    return (
        runs.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .where((F.char_length("word") >= least_length) & (F.col("n") >= least_times))
    )


def _outside(lo: Column, hi: Column, extra: Column) -> Column:
    """A name of the word's text outside the gap, which is ``extra`` code points wider here."""
    left = F.substring(F.col("word"), F.lit(1), lo)
    right = F.substring(F.col("word"), hi + extra + 1, F.col("length") + 1)
    return F.xxhash64(left, right, "length", lo, hi)


def _halved(postings: DataFrame) -> DataFrame:
    """Each posting twice, with either half of its gap: word, n, length, extra, lo, hi, key."""
    middle = F.expr("(lo + hi) div 2").cast("int")
    gaps = F.array(
        F.struct(F.col("lo").alias("lo"), middle.alias("hi")),
        F.struct(middle.alias("lo"), F.col("hi").alias("hi")),
    )
    cut = postings.select("word", "n", "length", "extra", F.explode(gaps).alias("gap"))
    lo, hi = F.col("gap.lo"), F.col("gap.hi")
    return cut.select(
        "word", "n", "length", "extra", lo.alias("lo"), hi.alias("hi"),
        _outside(lo, hi, F.col("extra")).alias("key"),
    )


def _met(postings: DataFrame) -> DataFrame:
    """Pairs one edit apart whose chunk and gram agree, each pair in exactly one of its gaps.

    The edit is placed as far right as the common beginning reaches, so a pair belongs to the gap
    that holds the end of its common beginning. The last gap also takes an edit after the last place.
    """
    left = postings.where("extra = 0").select(
        "key", "lo", "hi", "length", F.col("word").alias("a"), F.col("n").alias("a_n")
    )
    right = postings.select(
        "key", "extra", F.col("word").alias("b"), F.col("n").alias("b_n")
    )
    begun = F.substring("a", F.lit(1), F.col("lo")) == F.substring("b", F.lit(1), F.col("lo"))
    parted = (F.col("hi") == F.col("length")) | (
        F.substring("a", F.lit(1), F.col("hi")) != F.substring("b", F.lit(1), F.col("hi"))
    )
    once = (F.col("extra") == 1) | (F.col("a") < F.col("b"))
    return (
        left.join(right, "key")
        .where(once & begun & parted)
        .where(F.levenshtein("a", "b", 1) == 1)
        .select("a", "a_n", "b", "b_n")
    )


def near_words(words: DataFrame) -> DataFrame:
    """All pairs of ``words`` (word, n) that differ by one code point, each once: a, a_n, b, b_n.

    An edit inserts, deletes or replaces one code point. ``words`` has no repeated word.
    """
    sized = words.select("word", "n", F.char_length("word").alias("size"))
    whole = sized.select(
        "word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("extra"), "size"
    ).select(
        "word", "n", (F.col("size") - F.col("extra")).alias("length"), "extra",
        F.lit(0).alias("lo"), (F.col("size") - F.col("extra")).alias("hi"),
    ).where("length > 0")
    postings = materialize(_halved(whole))
    found = []
    while True:
        chunks = postings.groupBy("key").agg(
            F.sum(1 - F.col("extra")).alias("chunks"), F.count(F.lit(1)).alias("grams")
        )
        meeting = chunks.where((F.col("chunks") > 0) & (F.col("grams") > 1))
        crowded = (F.col("chunks") * F.col("grams") > PAIRS_PER_CHUNK) & (F.col("hi") - F.col("lo") > 1)
        judged = materialize(
            postings.join(meeting, "key").withColumn("crowded", crowded).drop("chunks", "grams")
        )
        found.append(materialize(_met(judged.where("not crowded"))))
        again = judged.where("crowded")
        if again.isEmpty():
            break
        postings = materialize(_halved(again))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def roots(forms: DataFrame) -> DataFrame:
    """The end of each word's chain of forms, by pointer doubling: word, root.

    ``forms`` (word, form) lists words that have a form; chains never close, as n grows along them.
    """
    at = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = at.join(onward, "root", "left")
        step = materialize(
            joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        )
        at = step.select("word", "root")
        if step.where("moved").isEmpty():
            return at


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """Every word with the form it is a variant of: word, form, root, n, n_near, form_n.

    ``n_near`` counts the words one edit away. ``form`` is the one of them with the largest n (ties:
    the first in code-point order) if that is at least ``ratio`` (over 1) times the word's own n;
    ``root`` follows forms to the last, and is the word itself where there is none. No words give no
    rows.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1, or chains of forms could close")
    words = materialize(words.select("word", "n"))
    pairs = near_words(words)
    both = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
                F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
            )
        ).alias("near")
    ).select("near.*")
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form"))).alias("best"),
    )
    large = -F.col("best.rank") >= ratio * F.col("n")
    judged = materialize(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(large, F.col("best.form")).alias("form"),
            F.when(large, -F.col("best.rank")).alias("form_n"),
        )
    )
    ends = roots(judged.where("form IS NOT NULL").select("word", "form"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
