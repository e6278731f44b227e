"""Mixing sources to target weights by Pareto order sampling, without Python in tasks.

Each source gets a target in words. A document's expected number of copies is
its source's target over its source's size (times its own weight, if there is
one). The whole part is certain; the fraction p is its chance of one more copy.
For that copy documents are ranked by ``[u / (1 - u)] / [p / (1 - p)]`` with a
reproducible uniform ``u``, and taken in this order until the words that are
still missing are reached, so the sample's size is fixed, not random.

No source is sorted as a whole, as one may hold a third of all rows. The place
where the target is reached is found by two rounds of counts over 4,096 equal
cells of the rank value; only documents of one final cell (a 16-millionth of
the range) are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalmill.llm.common import count_words, staged

_CELLS = 4096


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Adds ``target`` to a table with one row per source (``source``, ``source_size``).

    Sources in code-point order, null last, take ``weights`` in turn and share
    the whole size by them. None gets more than ``most`` times its size; what a
    capped source leaves is shared by weight among the others. With the level
    L at which the targets ``min(cap, L * weight)`` add up to the whole, L is the
    largest share that any tail of the sources, ordered by cap per weight, can get.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*map(F.lit, weights))
    order = Window.orderBy("_ratio", "_place")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (
        sizes.withColumn("_place", place)
        .withColumn("_weight", F.get(cycle, (F.col("_place") - 1) % len(weights)).cast("double"))
        .withColumn("_cap", (F.lit(most) * F.col("source_size")).cast("double"))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("_used", F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0)))
        .withColumn("_share", (F.col("_total") - F.col("_used")) / F.sum("_weight").over(rest))
        .withColumn("_level", F.max("_share").over(everything))
        .withColumn("target", F.least("_cap", F.col("_level") * F.col("_weight")))
        .select("source", "source_size", "target")
    )


def uniform(seed: str, *parts: Column) -> Column:
    """A reproducible number between 0 and 1 from a row's values."""
    joined = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    number = F.conv(F.substring(F.md5(joined), 1, 12), 16, 10).cast("long").cast("double")
    return (number + 0.5) / float(1 << 48)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    seed: str = "mix",
    doc_weight: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, draw, size, source, source_size, target, copies, taken.

    ``copies`` is at most ``most``. Without ``doc_weight`` all documents of a source have
    the same expected number of copies. A weight that is null or not above 0 counts as 0;
    if a source has no other, all its weights count as 1.

    Null text has size 0 and null sources form a source of their own. ``draw`` is the uniform
    number, the same for equal rows (id and text); all or none of them get the last copy.
    An empty table gives an empty result; other columns are ignored.
    """
    gift = F.lit(1.0)
    if doc_weight is not None:
        given = F.col(doc_weight).cast("double")
        gift = F.when(given > 0, given).otherwise(0.0)
    rows = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            count_words(F.col(text_col)).alias("size"),
            uniform(seed, F.col(id_col), F.col(text_col)).alias("_u"),
            gift.alias("_gift"),
        ),
        "mix-rows",
    )
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("_gift")).alias("_gifts")
    )
    means = sizes.select("source", F.try_divide("_gifts", "source_size").alias("_mean"))
    # one row per source; written, so that what follows joins it by its known size instead of making it again
    targets = staged(_with_source(source_targets(sizes.drop("_gifts"), weights, most), means), "mix-targets")
    joined = _with_source(rows, targets)
    own = F.when(F.col("_mean") > 0, F.col("_gift") / F.col("_mean")).otherwise(1.0)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ranked = (
        joined.withColumn("_hoped", F.least(F.lit(float(most)), rate * own))
        .withColumn("_whole", F.floor("_hoped"))
        .withColumn("_p", F.col("_hoped") - F.col("_whole"))
        .withColumn("_a", F.col("_u") * (1.0 - F.col("_p")))
        .withColumn("_b", (1.0 - F.col("_u")) * F.col("_p"))
        .withColumn("_rank", F.col("_a") / (F.col("_a") + F.col("_b")))  # odds ratio z as z / (1 + z)
        .withColumn("_cell", F.least(F.floor(F.col("_rank") * (_CELLS * _CELLS)), F.lit(_CELLS * _CELLS - 1)))
    )
    open_rows = ranked.where((F.col("_whole") < most) & (F.col("size") > 0))
    missing = ranked.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("_whole") * F.col("size"))).alias("_missing")
    )
    coarse = F.floor(F.col("_cell") / _CELLS)
    first = staged(_edge(open_rows, missing.withColumn("_before", F.lit(0).cast("long")), coarse), "mix-edges")
    inside = _with_source(open_rows, first.select("source", F.col("_edge").alias("_at"))).where(coarse == F.col("_at"))
    second = staged(_edge(inside, first.select("source", "_missing", "_before"), F.col("_cell")), "mix-edges")
    last = _with_source(open_rows, second).where(F.col("_cell") == F.col("_edge"))
    upto = Window.partitionBy("source").orderBy("_rank", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    fits = F.col("_before") + F.coalesce(F.sum("size").over(upto), F.lit(0)) + F.col("size") / 2 <= F.col("_missing")
    cuts = last.withColumn("_fits", fits).groupBy("source").agg(F.max(F.when(F.col("_fits"), F.col("_rank"))).alias("_cut"))
    edges = first.select("source", F.col("_edge").alias("_first"))
    edges = _with_source(edges, second.select("source", F.col("_edge").alias("_second")))
    edges = _with_source(edges, cuts)
    more = (
        F.when((F.col("_whole") >= most) | (F.col("size") == 0), False)
        .when(F.col("_first").isNull(), True)
        .otherwise((F.col("_cell") < F.col("_second")) | F.coalesce(F.col("_rank") <= F.col("_cut"), F.lit(False)))
    )
    copies = F.col("_whole") + more.cast("long")
    return _with_source(ranked, edges).select(
        "doc_id", F.col("_u").alias("draw"), "size", "source", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it has copies. Rows without a word go."""
    found = mix(docs, seed=seed, id_col=id_col, text_col=text_col, **options).where("taken > 0")
    taken = found.select(F.col("doc_id").alias("_id"), F.col("draw").alias("_d"), "copies").distinct()
    # input columns travel as one, so that none is taken for a helper
    drawn = docs.select(
        F.struct(*docs.columns).alias("_doc"), F.col(id_col).alias("_own"), uniform(seed, F.col(id_col), F.col(text_col)).alias("_draw")
    )
    joined = drawn.join(taken, (F.col("_draw") == F.col("_d")) & F.col("_own").eqNullSafe(F.col("_id")))
    return joined.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_doc.*")


def _edge(rows: DataFrame, missing: DataFrame, cell: Column) -> DataFrame:
    """Per source the first cell in which the words go past what is missing, and the words before it.

    ``_edge`` is null where all the words together don't reach it.
    """
    cells = rows.groupBy("source", cell.alias("_c")).agg(F.sum("size").alias("_words"))
    order = Window.partitionBy("source").orderBy("_c")
    summed = _with_source(cells, missing).withColumn("_sum", F.col("_before") + F.sum("_words").over(order))
    past = summed.where(F.col("_sum") > F.col("_missing"))
    found = past.groupBy("source").agg(
        F.min("_c").alias("_edge"), F.min_by(F.col("_sum") - F.col("_words"), "_c").alias("_until")
    )
    return _with_source(missing.drop("_edge"), found).select(
        "source", "_missing", F.coalesce("_until", "_before").alias("_before"), "_edge"
    )


def _with_source(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on the source, in which null equals null."""
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
