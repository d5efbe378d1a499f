"""Sources mixed to target weights by entropy balancing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.llm.ranks import blocks_for, numbered
from attestry.llm.text import word_count
from attestry.session import materialize

TOLERANCE = 1e-9
MAX_STEPS = 60


def token_targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Target tokens per source: source, source_size, target.

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` of all
    tokens; no target is above ``most`` times its source, and what is cut off goes to the others by
    weight. With sources ordered by limit per weight, those before the first whose limit holds the
    common level are at their limit, the rest at level times weight. Reads one row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = sources.withColumn(
        "weight", F.array(*[F.lit(float(w)) for w in weights])[(turn % len(weights)).cast("int")]
    ).withColumn("limit", most * F.col("source_size"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_limit.rowsBetween(0, Window.unboundedFollowing)
    left = share * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    levelled = ranked.withColumn("level", left / F.sum("weight").over(rest))
    fits = F.when(F.col("limit") >= F.col("level") * F.col("weight"), F.col("level"))
    return levelled.withColumn(
        "level", F.first(fits, ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ).select(
        "source",
        "source_size",
        F.least("limit", F.col("level") * F.col("weight")).alias("target"),
    )


def _rate(tilt: Column, most: float) -> Column:
    """min(most, exp(tilt * size / mean size)) without overflow."""
    return F.least(F.lit(most), F.exp(F.least(tilt * F.col("x"), F.lit(50.0))))


def balance(classes: DataFrame, targets: DataFrame, most: float) -> DataFrame:
    """The tilt of every source: source, mean, tilt (null: all rows at ``most``), by Newton's method.

    Entropy balancing keeps the rates near 1 in relative entropy, under one token constraint per
    source and rates of at most ``most``. Its convex dual has one multiplier per source and the
    rates min(most, exp(tilt * size / mean)). A step is one aggregation over (source, size) classes;
    the Hessian is diagonal. Steps on the logarithm of the tokens that leave the bracket found so far
    are replaced by its middle. Nothing but the number of open sources reaches the driver.
    """
    named = classes.join(targets, classes["source"].eqNullSafe(targets["source"])).select(
        classes["*"],
        "target",
        "source_size",
        (F.col("source_size") / F.sum("rows").over(Window.partitionBy(classes["source"]))).alias("mean"),
    )
    solvable = materialize(
        named.where((F.col("target") > 0) & (F.col("target") < most * F.col("source_size") * (1 - 1e-12)))
        .withColumn("x", F.col("size") / F.col("mean"))
        .where(F.col("size") > 0)
    )
    state = materialize(
        solvable.groupBy("source").agg(F.first("target").alias("target"), F.first("mean").alias("mean"))
        .select("source", "target", "mean", F.lit(0.0).alias("tilt"), F.lit(-1e6).alias("low"),
                F.lit(1e6).alias("high"), F.lit(False).alias("done"))
    )
    for _ in range(MAX_STEPS):
        open_ = state.where(~F.col("done"))
        rate = _rate(F.col("tilt"), most)
        sums = (
            solvable.drop("target", "mean").alias("c")
            .join(open_.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
            .groupBy("s.source", "target", "mean", "tilt", "low", "high")
            .agg(
                F.sum(F.col("rows") * F.col("size") * rate).alias("tokens"),
                F.sum(
                    F.when(rate < most, F.col("rows") * F.col("size") * F.col("x") * rate).otherwise(0.0)
                ).alias("slope"),
            )
        )
        over = F.col("tokens") > F.col("target")
        low = F.when(over, F.col("low")).otherwise(F.col("tilt"))
        high = F.when(over, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - F.log(F.col("tokens") / F.col("target")) * F.col("tokens") / F.col("slope")
        inside = (F.col("slope") > 0) & (F.col("tokens") > 0) & (step > low) & (step < high)
        met = F.abs(F.col("tokens") - F.col("target")) <= TOLERANCE * F.col("target")
        stepped = sums.select(
            "source", "target", "mean",
            F.when(met, F.col("tilt")).when(inside, step).otherwise((low + high) / 2).alias("tilt"),
            low.alias("low"), high.alias("high"),
            (met | (high - low <= F.lit(1e-12))).alias("done"),
        )
        state = materialize(state.where("done").unionByName(stepped))
        if state.where(~F.col("done")).isEmpty():
            break
    tilts = state.select(F.col("source").alias("_source"), "tilt")
    return (
        named.join(tilts, F.col("source").eqNullSafe(F.col("_source")), "left")
        .withColumn("x", F.col("size") / F.col("mean"))
        .withColumn(
            "rate",
            F.when(F.col("target") <= 0, 0.0)
            .when(F.col("tilt").isNull(), F.lit(most))
            .otherwise(_rate(F.col("tilt"), most)),
        )
        .select("source", "size", "rows", "source_size", "target", "rate")
    )


def whole_copies(rated: DataFrame, most: int) -> DataFrame:
    """Copies per (source, size) class: adds ``copies``, whole and at most ``most * rows``.

    Expected copies are summed from the largest size down and rounded along that sum, so a class
    gets its share rounded down or up and a source ends within one long document of its target. What
    is then missing or too much is settled with one class per size octave, largest first; at most 63
    classes of a source meet in one list.
    """
    down = Window.partitionBy("source").orderBy(F.col("size").desc())
    until = F.sum(F.col("rows") * F.col("rate")).over(down.rowsBetween(Window.unboundedPreceding, 0))
    # The sum of a class and the sum before it are the same number, taken by lag.
    summed = rated.withColumn("until", F.floor(until + 0.5 + 1e-9))
    rounded = summed.withColumn(
        "copies",
        F.least(
            F.col("until") - F.coalesce(F.lag("until").over(down), F.lit(0)), F.col("rows") * most
        ).cast("long"),
    ).drop("until")
    rounded = materialize(rounded)
    octave = F.floor(F.log2(F.col("size"))).cast("int")
    positive = rounded.where(F.col("size") > 0)
    room = F.struct(F.col("rows"), F.col("size"))
    picked = positive.groupBy("source", octave.alias("octave")).agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"),
        F.first("target").alias("target"),
        F.max_by(
            F.struct(
                F.col("size"), F.col("copies").alias("less"),
                (F.col("rows") * most - F.col("copies")).alias("more"),
            ),
            room,
        ).alias("pick"),
    )
    listed = picked.groupBy("source").agg(
        (F.first("target") - F.sum("taken")).alias("open"),
        F.sort_array(F.collect_list("pick"), asc=False).alias("picks"),
    )
    fixed = listed.select(
        "source",
        F.expr(
            """
            aggregate(
              picks,
              named_struct('open', cast(open as double), 'fixes', cast(array() as array<struct<size: bigint, delta: bigint>>)),
              (a, p) -> named_struct(
                'open', a.open - p.size * if(a.open >= 0,
                    least(p.more, cast(floor(a.open / p.size + if(p.size = element_at(picks, -1).size, 0.5, 0)) as bigint)),
                   -least(p.less, cast(floor(-a.open / p.size + if(p.size = element_at(picks, -1).size, 0.5, 0)) as bigint))),
                'fixes', concat(a.fixes, array(named_struct('size', p.size, 'delta', if(a.open >= 0,
                    least(p.more, cast(floor(a.open / p.size + if(p.size = element_at(picks, -1).size, 0.5, 0)) as bigint)),
                   -least(p.less, cast(floor(-a.open / p.size + if(p.size = element_at(picks, -1).size, 0.5, 0)) as bigint))))))),
              a -> a.fixes)
            """
        ).alias("fixes"),
    ).select("source", F.explode("fixes").alias("fix")).select(
        F.col("source").alias("_source"), F.col("fix.size").alias("_size"), F.col("fix.delta").alias("delta")
    )
    return rounded.join(
        fixed,
        rounded["source"].eqNullSafe(fixed["_source"]) & (rounded["size"] == fixed["_size"]),
        "left",
    ).select(
        "source", "size", "rows", "source_size", "target", "rate",
        (F.col("copies") + F.coalesce("delta", F.lit(0))).alias("copies"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: int = 2,
) -> DataFrame:
    """Copies of every row of ``docs`` (doc_id, text, source) for the mix.

    Columns: doc_id, source, size (words; 0 for a null or empty text), source_size, target, copies
    (0 to ``most``), taken (copies * size). Rows without words take nothing and get 0 copies where
    their source is below its limit. Documents of one source and size share a rate; which of them
    get the extra copy is decided by a hash of doc_id, the same in every run. Repeated rows are
    separate documents. A null source is a source of its own, the last one. Other columns are not
    read; an empty table gives an empty result.
    """
    sized = materialize(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"),
            F.xxhash64("text").alias("text_id"),
        )
    )
    classes = materialize(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("rows")))
    sources = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = materialize(token_targets(sources, weights, share, float(most)))
    dealt = whole_copies(balance(classes, targets, float(most)), most).alias("c")
    placed = sized.alias("d").join(
        dealt,
        F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.size") == F.col("c.size")),
    ).select("d.*", "source_size", "target", "rows", "copies")
    ranked = numbered(placed, ["source", "size"], blocks_for(F.col("rows")), "place")
    even = F.expr("copies div rows")
    taken = even + (F.col("place") < F.col("copies") - even * F.col("rows")).cast("long")
    return ranked.select(
        "doc_id", "text_id", "source", "size", "source_size", "target",
        taken.cast("int").alias("copies"),
        (taken * F.col("size")).alias("taken"),
    )


def expand(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """Every row of ``docs`` as often as ``mixed`` takes it, with the columns of ``docs``.

    Rows with the same doc_id, source and text share the copies that ``mixed`` dealt to them. Where
    there are several, equal rows are merged into one with a count before they move.
    """
    dealt = mixed.groupBy(
        F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), F.col("text_id").alias("_text")
    ).agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")).where("_copies > 0")
    joined = docs.select(F.struct("*").alias("_row")).join(
        dealt,
        F.col("_row.doc_id").eqNullSafe(F.col("_doc"))
        & F.col("_row.source").eqNullSafe(F.col("_source"))
        & (F.xxhash64("_row.text") == F.col("_text")),
    )
    alone = joined.where("_rows = 1").select("_row", F.col("_copies").alias("_take"))
    keys = ["_doc", "_source", "_text", "_copies", "_rows"]
    merged = joined.where("_rows > 1").groupBy("_row", *keys).agg(F.count(F.lit(1)).alias("_equal"))
    order = Window.partitionBy("_doc", "_source", "_text").orderBy("_row")
    even = F.expr("_copies div _rows")
    before = F.sum("_equal").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_equal")
    extra = F.greatest(F.lit(0), F.least(F.col("_equal"), F.expr("_copies % _rows") - before))
    several = merged.select("_row", (even * F.col("_equal") + extra).alias("_take"))
    return (
        alone.unionByName(several)
        .where("_take > 0")
        .select("_row", F.explode(F.sequence(F.lit(1), F.col("_take"))))
        .select("_row.*")
    )
