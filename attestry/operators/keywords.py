"""Keyword presence per scope over twelve dimensions, with first evidence.

All patterns are unrolled into one projection, so a page is read once and only one flag per pattern
travels to the scope's aggregate. Evidence is located afterwards, and only for patterns that are
reported.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.catalog import KEYWORD_GUARDS, KEYWORDS, MAX_KEYWORD_SCORE
from attestry.functions.text import (
    REGEX_FLAGS,
    cut,
    fold_case,
    pattern_hit,
    portable,
    window_end,
    window_start,
    word_text,
)

EVIDENCE_PER_DIMENSION = 3


def _unrolled(rules: Mapping) -> list[tuple[str, str, int, str]]:
    """(dimension, level, position inside the dimension, pattern), strong patterns first."""
    rows = []
    for dimension, (_, strong, weak) in rules.items():
        leveled = [("high", p) for p in strong] + [("mid", p) for p in weak]
        rows += [(dimension, level, at, p) for at, (level, p) in enumerate(leveled)]
    return rows


def _distinct_patterns(rules: Mapping) -> dict[str, str]:
    """Pattern text to flag column; a pattern used by several dimensions is tested once."""
    patterns = dict.fromkeys(pattern for *_, pattern in _unrolled(rules))
    return {pattern: f"hit_{at}" for at, pattern in enumerate(patterns)}


def _flags(rules: Mapping) -> list[Column]:
    return [
        pattern_hit(
            F.col("text"), F.col("_folded"), F.col("_words"), pattern, KEYWORD_GUARDS.get(pattern)
        ).alias(name)
        for pattern, name in _distinct_patterns(rules).items()
    ]


def _prepared(pages: DataFrame) -> DataFrame:
    folded = pages.withColumn("_folded", fold_case(F.col("text")))
    return folded.withColumn("_words", word_text(F.col("_folded")))


def page_hits(pages: DataFrame, scope: Sequence[str], rules: Mapping = KEYWORDS) -> DataFrame:
    """One boolean per pattern and page."""
    return _prepared(pages).select(*scope, *_flags(rules))


def _score(high: Column, mid: Column) -> Column:
    return (
        F.when(high >= 3, 3)
        .when((high >= 1) | (mid >= 2), 2)
        .when(mid >= 1, 1)
        .otherwise(0)
        .cast("int")
    )


def _level_count(rules: Mapping, dimension: str, level: str, names: Mapping[str, str]) -> Column:
    hits = [
        F.col(names[pattern]).cast("int")
        for dim, lvl, _, pattern in _unrolled(rules)
        if (dim, lvl) == (dimension, level)
    ]
    return sum(hits, F.lit(0))


def keyword_totals(
    pages: DataFrame, scope: Sequence[str] = ("parsed_document_id",), rules: Mapping = KEYWORDS
) -> DataFrame:
    """One row per scope: the score of every dimension, the total and its share of the maximum."""
    names = _distinct_patterns(rules)
    hits = page_hits(pages, scope, rules).groupBy(*scope).agg(
        *[F.max(name).alias(name) for name in names.values()]
    )
    scored = hits.select(
        *scope,
        *[
            _score(
                _level_count(rules, dimension, "high", names),
                _level_count(rules, dimension, "mid", names),
            ).alias(dimension)
            for dimension in rules
        ],
    )
    total = sum((F.col(dimension) for dimension in rules), F.lit(0))
    return scored.withColumn("total_score", total).withColumn(
        "keyword_score_ratio", F.col("total_score") / F.lit(float(MAX_KEYWORD_SCORE))
    )


def keyword_scores(
    pages: DataFrame, scope: Sequence[str] = ("parsed_document_id",), rules: Mapping = KEYWORDS
) -> DataFrame:
    """One row per scope and dimension with the strong and weak hit counts and the score."""
    names = _distinct_patterns(rules)
    hits = page_hits(pages, scope, rules).groupBy(*scope).agg(
        *[F.max(name).alias(name) for name in names.values()]
    )
    per_dimension = F.array(
        *[
            F.struct(
                F.lit(dimension).alias("dimension_id"),
                F.lit(rules[dimension][0]).alias("dimension_name"),
                _level_count(rules, dimension, "high", names).alias("hit_count_high"),
                _level_count(rules, dimension, "mid", names).alias("hit_count_mid"),
            )
            for dimension in rules
        ]
    )
    return (
        hits.select(*scope, F.explode(per_dimension).alias("d"))
        .select(*scope, "d.*")
        .withColumn("score", _score(F.col("hit_count_high"), F.col("hit_count_mid")))
    )


def keyword_evidence(
    pages: DataFrame,
    scope: Sequence[str] = ("parsed_document_id",),
    rules: Mapping = KEYWORDS,
    page_order: Sequence[str] = ("page_number",),
    most: int | None = EVIDENCE_PER_DIMENSION,
) -> DataFrame:
    """Evidence windows per scope and dimension with their rank, strong patterns first.

    ``most`` is how many a dimension shows; None shows all. ``evidence_rank`` counts from 1.

    ``page_order`` says which page of a scope comes first (for a scope of several documents put the
    document position in front). The first page per pattern comes from partial minima over page
    order alone; text is joined back only for pages that are actually quoted.
    """
    names = _distinct_patterns(rules)
    single = len(page_order) == 1
    place = F.col(page_order[0]) if single else F.struct(*page_order)
    placed = _prepared(pages).select(*scope, place.alias("_place"), *_flags(rules))
    firsts = placed.groupBy(*scope).agg(
        *[F.min(F.when(F.col(name), F.col("_place"))).alias(name) for name in names.values()]
    )

    def reported(dimension: str) -> Column:
        entries = F.array(
            *[
                F.struct(
                    F.lit(dimension).alias("dimension_id"),
                    F.lit(level).alias("level"),
                    F.lit(at).alias("pattern_position"),
                    F.lit(pattern).alias("pattern"),
                    F.lit(REGEX_FLAGS + portable(pattern)).alias("_regex"),
                    F.col(names[pattern]).alias("place"),
                )
                for dim, level, at, pattern in _unrolled(rules)
                if dim == dimension
            ]
        )
        found = F.filter(entries, lambda entry: entry["place"].isNotNull())
        ranked = F.transform(
            found, lambda entry, i: entry.withField("evidence_rank", (i + 1).cast("int"))
        )
        return ranked if most is None else F.slice(ranked, 1, most)

    wanted = (
        firsts.select(*scope, F.explode(F.flatten(F.array(*map(reported, rules)))).alias("e"))
        .select(*scope, "e.*")
        .select(
            "*",
            *[F.col("place" if single else f"place.{name}").alias(name) for name in page_order],
        )
        .drop("place")
    )
    keys = [*scope, *[name for name in page_order if name not in scope]]
    carried = [c for c in ("document_version_id", "page_number") if c not in keys]
    texts = pages.select(*keys, *[c for c in carried if c in pages.columns], "text")
    start = F.call_function("regexp_instr", F.col("text"), F.col("_regex"))
    match = F.call_function("regexp_substr", F.col("text"), F.col("_regex"))
    located = (
        wanted.join(texts, keys)
        .withColumn("_start", start - 1)
        .withColumn("_end", F.col("_start") + F.length(match))
        .withColumn("char_start", window_start(F.col("_start")))
        .withColumn("char_end", window_end(F.col("_end"), F.length("text")))
        .withColumn("quote", cut(F.col("text"), F.col("char_start"), F.col("char_end")))
    )
    return located.drop("text", "_start", "_end", "_regex")
