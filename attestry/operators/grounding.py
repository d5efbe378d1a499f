"""Does a quote really stand where it is said to stand? One operator for every caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.text import cut, is_blank, quote_occurrence


def _outcome(text: Column) -> Column:
    quote, start, end = F.col("quote"), F.col("char_start"), F.col("char_end")
    # Most quotes stand at their offsets; only the others are searched for in the whole text.
    stands = (end <= F.length(text)) & (cut(text, start, end) == quote) & ~is_blank(quote)
    return (
        F.when(text.isNull(), "page_missing")
        .when(stands, "grounded")
        .when(is_blank(quote) | ~text.contains(quote), "quote_missing")
        .when(start.isNull() | end.isNull(), "offsets_missing")
        .otherwise("offsets_mismatch")
    )


def ground(evidence: DataFrame, pages: DataFrame) -> DataFrame:
    """Add ``outcome`` to evidence rows that name a parsed document, page, quote and offsets.

    Text moves once, keyed by page, so a long document spreads over all tasks; a page cited by very
    many rows is split by the adaptive skew join.
    """
    texts = pages.select("parsed_document_id", "page_number", F.col("text").alias("_text"))
    return (
        evidence.join(texts, ["parsed_document_id", "page_number"], "left")
        .withColumn("outcome", _outcome(F.col("_text")))
        .drop("_text")
    )


def grounding_report(evidence: DataFrame, pages: DataFrame) -> DataFrame:
    """Per document: how many quotes were checked and how many failed, by reason."""
    return (
        ground(evidence, pages)
        .groupBy("parsed_document_id")
        .agg(
            F.count(F.lit(1)).alias("checked_evidence"),
            F.count_if(F.col("outcome") == "page_missing").alias("missing_page"),
            F.count_if(F.col("outcome") == "offsets_missing").alias("missing_offsets"),
            F.count_if(F.col("outcome").isin("quote_missing", "offsets_mismatch")).alias(
                "quote_mismatch"
            ),
        )
        .withColumn(
            "valid",
            F.col("missing_page") + F.col("missing_offsets") + F.col("quote_mismatch") == 0,
        )
    )


def locate_quotes(quotes: DataFrame, pages: DataFrame) -> DataFrame:
    """Offsets of quotes that occur exactly once on their page; else absent or ambiguous."""
    texts = pages.select("parsed_document_id", "page_number", F.col("text").alias("_text"))
    text, quote = F.col("_text"), F.col("quote")
    occurrence = F.when(text.isNull(), "page_missing").otherwise(quote_occurrence(text, quote))
    start = F.when(F.col("occurrence") == "unique", F.instr(text, quote) - 1)
    return (
        quotes.join(texts, ["parsed_document_id", "page_number"], "left")
        .withColumn("occurrence", occurrence)
        .withColumn("char_start", start)
        .withColumn("char_end", F.col("char_start") + F.length("quote"))
        .drop("_text")
    )
