"""Mixing sources to target weights: capped water-filling and seeded sampling.

``source_targets`` shares a word budget among sources by weight.  No source
may be repeated more than ``max_epochs`` times: a source whose share would
exceed that is clamped and its excess goes to the others in proportion to
their weights, until none is above.  The fixed point is found in one pass:
with sources in ascending order of ``cap / weight``, the clamped ones form a
prefix, and the first source whose share of what the prefix leaves over fits
under its cap ends it.

``take`` turns a source's target into whole and fractional repetitions.  With
``target = (whole + rest) * source_size``, every document is taken ``whole``
times and a seeded random subset once more: documents in the order of a seeded
digest are taken while the middle of their word range lies below
``rest * source_size``, so a source misses its target by at most half of one
document.  The order is cut into ``BUCKETS`` digest ranges; only the range in
which the target falls needs an order inside, and there rows that share an id
and a size count as one, so no source is ever sorted in one task.  Of such rows,
if only some fit, those with the smallest digest of the whole row go in.

Defined cases: NULL text has size 0; a NULL source is a source of its own and
comes last; a source without words has target 0; an empty table gives an empty
result; repeated rows are documents like any other; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialize, words

#: Ranges of the seeded digest (its first three hexadecimal digits).
BUCKETS = 16**3


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    budget: float = 1.5,
    max_epochs: int = 2,
) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size`` rows.

    One row a source: the windows below order sources, not documents.
    ``weights`` are dealt to the sources in code-point order (NULL last),
    repeating; ``budget`` is the mix's size as a share of all sizes.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("_k"), F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("_k", rank).withColumn("_w", pick.cast("double"))
    s = s.withColumn("_cap", (F.col("source_size") * max_epochs).cast("double"))
    by_fill = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("_k").asc())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = (
        s.withColumn("_caps", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_ws", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
        .withColumn("_all", F.sum("source_size").over(everything) * F.lit(budget))
        .withColumn("_n", F.row_number().over(by_fill))
    )
    # share of this source if exactly the sources before it are clamped
    share = F.col("_w") * (F.col("_all") - F.col("_caps")) / F.col("_ws")
    s = s.withColumn("_free", F.when(share <= F.col("_cap"), F.col("_n")))
    s = s.withColumn("_first", F.min("_free").over(everything))
    level = F.first(F.when(F.col("_n") == F.col("_first"), F.struct("_all", "_caps", "_ws")), ignorenulls=True)
    s = s.withColumn("_level", level.over(everything))
    left, weight = F.col("_level._all") - F.col("_level._caps"), F.col("_level._ws")
    free = F.col("_n") >= F.col("_first")
    target = F.when(free, F.col("_w") * left / weight).otherwise(F.col("_cap"))
    return s.select("source", "source_size", target.alias("target"))


def seeded_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit(""))))


def take(docs: DataFrame, seed: int = 4, **targets: float) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies, taken`` added.

    ``docs`` needs ``doc_id, text, source``.  ``copies`` is how often the mix
    takes the document, ``taken`` the words that makes.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    kept = [c for c in docs.columns if c not in added]
    sized = docs.select(
        *kept,
        F.size(words(F.col("text"))).cast("long").alias("size"),
        seeded_key(F.col("doc_id"), seed).alias("_key"),
    ).withColumn("_bucket", F.conv(F.substring("_key", 1, 3), 16, 10).cast("int"))
    thin = materialize(sized.select("source", "size", "_key", "_bucket"), "mix-sizes")

    # at most BUCKETS rows a source: words in each range and in the ranges before it
    ranges = thin.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    targets_df = source_targets(thin.groupBy("source").agg(F.sum("size").alias("source_size")), **targets)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = targets_df.withColumn("_whole", whole.cast("long")).withColumn(
        "_rest", F.col("target") - F.col("_whole") * F.col("source_size")
    )
    # the range that holds the end of the extra copies, and the words before it
    cut = (
        ranges.withColumnRenamed("source", "_s")
        .join(plan, F.col("_s").eqNullSafe(F.col("source")))
        .where(F.col("_before") <= F.col("_rest"))
        .groupBy("source", "source_size", "target", "_whole", "_rest")
        .agg(F.max_by(F.struct("_bucket", "_before"), F.col("_bucket")).alias("_cut"))
    )
    cut = materialize(
        cut.select(
            F.col("source").alias("_src"),
            "source_size",
            "target",
            "_whole",
            "_rest",
            F.col("_cut._bucket").alias("_cb"),
            F.col("_cut._before").alias("_cbefore"),
        ),
        "mix-cut",
    )
    # inside that range only: the last key and size taken, and of how many rows
    inside = thin.join(cut, F.col("source").eqNullSafe(F.col("_src")) & (F.col("_bucket") == F.col("_cb")))
    inside = inside.groupBy("source", "_key", "size", "_cbefore", "_rest").agg(F.count(F.lit(1)).alias("_same"))
    w = Window.partitionBy("source").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_cbefore") + F.coalesce(F.sum(F.col("size") * F.col("_same")).over(w), F.lit(0))
    inside = inside.withColumn("_room", F.col("_rest") * 2 - F.col("size") - start * 2)
    fit = F.when(F.col("size") > 0, F.least("_same", F.floor(F.col("_room") / (F.col("size") * 2)) + 1)).otherwise(F.col("_same"))
    last = (
        inside.where(F.col("_room") >= 0)
        .groupBy("source")
        .agg(
            F.max(F.struct("_key", "size")).alias("_last"),
            F.max_by(F.struct("_same", fit.cast("long").alias("_fit")), F.struct("_key", "size")).alias("_of"),
        )
        .withColumnRenamed("source", "_lsrc")
    )
    plan2 = materialize(
        cut.join(last, F.col("_src").eqNullSafe(F.col("_lsrc")), "left").drop("_lsrc"), "mix-plan"
    )
    here = F.struct(F.col("_key"), F.col("size"))
    rows = sized.join(plan2, F.col("source").eqNullSafe(F.col("_src")))
    before = (F.col("_bucket") < F.col("_cb")) | (
        (F.col("_bucket") == F.col("_cb")) & F.coalesce(here <= F.col("_last"), F.lit(False))
    )
    out = [*kept, "size", "source_size", "target", "_whole"]
    if plan2.where(F.col("_of._fit") < F.col("_of._same")).isEmpty():
        rows = rows.select(*out, before.alias("_extra"))
    else:
        # some of the rows that share the last key and size go in: by a digest of
        # the whole row, and of equal rows as many as there is room for
        tied = F.coalesce((here == F.col("_last")) & (F.col("_of._fit") < F.col("_of._same")), F.lit(False))
        digest = F.when(tied, F.md5(F.to_json(F.struct(*kept)).cast("binary")))
        rows = rows.withColumn("_tied", tied).withColumn("_tie", digest)
        ties = rows.where("_tied").groupBy("source", "_tie", F.col("_of._fit").alias("_fit")).agg(F.count(F.lit(1)).alias("_n"))
        w = Window.partitionBy("source").orderBy("_tie").rowsBetween(Window.unboundedPreceding, -1)
        ties = ties.withColumn("_left", F.col("_fit") - F.coalesce(F.sum("_n").over(w), F.lit(0))).where("_left > 0")
        end = ties.groupBy("source").agg(
            F.max("_tie").alias("_end"), F.max_by("_left", "_tie").alias("_left")
        )
        end = materialize(end.withColumnRenamed("source", "_esrc"), "mix-ties")
        rows = rows.join(F.broadcast(end), F.col("source").eqNullSafe(F.col("_esrc")), "left")
        split = F.col("_tied") & (F.col("_tie") == F.col("_end"))
        whole = rows.where(~split).select(
            *out, F.when(F.col("_tied"), F.col("_tie") < F.col("_end")).otherwise(before).alias("_extra")
        )
        # equal rows are counted and written out again, numbered
        equal = rows.where(split).groupBy("source", "_tie", "_left").agg(
            F.first(F.struct(*out)).alias("_row"), F.count(F.lit(1)).cast("int").alias("_n")
        )
        equal = equal.select("_row", "_left", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i"))
        rows = whole.unionByName(equal.select("_row.*", (F.col("_i") <= F.col("_left")).alias("_extra")))
    copies = (F.col("_whole") + F.col("_extra").cast("long")).cast("long")
    return rows.withColumn("copies", copies).select(
        *kept, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, seed: int = 4, **targets: float) -> DataFrame:
    """The mix itself: each taken document once per copy, numbered from 1."""
    out = take(docs, seed, **targets).where(F.col("copies") > 0)
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
