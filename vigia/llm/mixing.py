"""Mixing sources to target weights by entropy balancing. DataFrame operations only.

Each source has a token target. Among all document rates that meet it and stay within the cap,
entropy balancing takes those closest in entropy to taking every document once; the dual of
that convex problem has one multiplier a source, and its optimum tilts exponentially:

    rate = min(cap, exp(multiplier * size / mean size of the source))

The multipliers come from Newton steps, safeguarded by a bracket, whose gradient and curvature
are sums over the corpus. Documents of one source and size share their rate, so the sums run
over the (source, size) histogram, itself a distributed table built with map-side combination.

Rates become whole copies by systematic rounding: groups ordered by size carry the rounding
error on, then a few single copies are moved to close what is left of each source's gap.
Groups over ``bucket_rows`` documents are split by a hash, so ranking within a group is bounded
whatever one source or one size holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigia.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"


def _sources(hist: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """Per source: its place ``sid`` (code-point order, null last), size and target.

    Water filling: sources reach their cap in the order of cap to weight; the level of the rest
    is what is left to share over the weights that are left.
    """
    one = Window.partitionBy(F.lit(0))  # one row a source
    s = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                   F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("filled"),
                                   F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    s = s.withColumn("sid", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    s = s.withColumn("w", w).withColumn("most", F.col("source_size") * F.lit(cap))
    order = one.orderBy(F.col("most") / F.col("w"), "sid")
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    s = s.withColumn("level", (F.sum("source_size").over(one) - before) / left)
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("most") / F.col("w"), F.struct(F.col("most") / F.col("w"), "sid", "level"))).over(one)["level"])
    return s.withColumn("target", F.least(F.col("most"), F.col("w") * F.col("level"))).select(
        "source", "sid", "source_size", "target", "least",
        (F.col("source_size") / F.col("filled")).alias("mean"))


def _rate(cap: float) -> Column:
    return F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(cap), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(700.0)))))


def _solve(hist: DataFrame, sources: DataFrame, cap: float, steps: int = 60, at_once: int = 4) -> DataFrame:
    """Multipliers of all sources: ``at_once`` Newton steps a job until every gap has closed."""
    x_least = F.col("least") / F.col("mean")
    share = F.col("target") / F.col("source_size")
    lo = F.when(share < 1, F.log(share) / x_least).otherwise(F.lit(0.0))
    hi = F.when(share <= 1, F.lit(0.0)).otherwise(F.log(F.lit(cap)) / x_least)
    state = sources.filter("source_size > 0").select(
        "sid", "target", "mean", "source_size", lo.alias("lo"), hi.alias("hi"),
        F.when(share >= cap * (1 - 1e-12), hi).otherwise(F.log(share)).alias("lam"), F.lit(None).cast("double").alias("gap"))
    rate, x = _rate(cap), F.col("size") / F.col("mean")
    keep = ["sid", "target", "mean", "source_size", "lo", "hi", "lam"]
    for _ in range(0, steps, at_once):
        for _ in range(at_once):
            sums = hist.filter("size > 0").join(state.drop("gap"), "sid").groupBy(*keep).agg(
                F.sum(F.col("n") * F.col("size") * rate).alias("f"),
                F.sum(F.when(rate < cap, F.col("n") * F.col("size") * x * rate).otherwise(0.0)).alias("df"))
            gap = F.col("f") - F.col("target")
            sums = (sums.withColumn("gap", gap)
                    .withColumn("lo", F.when(gap < 0, F.greatest("lo", "lam")).otherwise(F.col("lo")))
                    .withColumn("hi", F.when(gap > 0, F.least("hi", "lam")).otherwise(F.col("hi"))))
            newton = F.col("lam") - F.col("gap") / F.col("df")
            inside = (F.col("df") > 0) & (newton > F.col("lo")) & (newton < F.col("hi"))
            done = F.abs("gap") <= 1e-9 * F.col("target")
            state = sums.withColumn("lam", F.when(done, F.col("lam")).when(inside, newton)
                                    .otherwise((F.col("lo") + F.col("hi")) / 2)).select(*keep, "gap")
        state = written(state, "mixing-multipliers")
        if not state.filter(F.abs("gap") > 1e-9 * F.col("target")).limit(1).count():
            break
    else:
        worst = state.agg(F.max(F.abs("gap") / F.col("target")).alias("worst")).first()["worst"]
        if worst is not None and worst > 1e-6:  # beyond what the bracket can still close in doubles
            raise RuntimeError(f"entropy balancing left a gap of {worst:.2g} of a source's target after {steps} steps")
    # sums of doubles differ in their last bits from run to run; what follows from them does not
    return state.select("sid", F.round("lam", 12).alias("lam"))


def _running(groups: DataFrame) -> DataFrame:
    """``groups`` with ``before`` and ``upto``: the sums of ``want`` (a whole number) over the groups of
    the source up to this one, larger sizes first. Sums run inside ranges of the order, each in a
    task of its own, and over the ranges' few totals."""
    by = ["sid", F.desc("size"), "bucket"]
    laid = written(groups.repartitionByRange(*by).withColumn("part", F.spark_partition_id()), "mixing-ranges")
    totals = laid.groupBy("sid", "part").agg(F.sum("want").alias("total"))
    ahead = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("sid", "part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("ahead"))
    inside = F.sum("want").over(Window.partitionBy("sid", "part").orderBy(F.desc("size"), "bucket").rowsBetween(Window.unboundedPreceding, 0))
    return (laid.withColumn("inside", inside).join(totals, ["sid", "part"]).withColumn("upto", F.col("ahead") + F.col("inside"))
            .withColumn("before", F.col("upto") - F.col("want")).drop("part", "inside", "ahead"))


UNIT = 1 << 20  # parts of a copy, so that running sums are whole numbers


def _rounded(groups: DataFrame, cap: float, moves: int = 3) -> DataFrame:
    """Copies of each group's documents: all get ``base``, ``extra`` of them one more."""
    g = (groups.withColumn("rate", _rate(cap)).withColumn("base", F.floor(F.col("rate") + F.lit(1e-9)))
         .withColumn("want", F.round(F.col("n") * F.greatest(F.col("rate") - F.col("base"), F.lit(0.0)) * UNIT).cast("long")))
    nearest = lambda c: F.shiftright(F.col(c) + UNIT // 2, 20)
    g = _running(g).withColumn("extra", F.greatest(F.lit(0), F.least(F.col("n"), nearest("upto") - nearest("before"))).cast("long")).drop("upto", "before")
    g = written(g, "mixing-rounded")  # every move refers to it several times
    for _ in range(moves):
        gap = g.groupBy("sid").agg((F.max("target") - F.sum(F.col("size") * (F.col("n") * F.col("base") + F.col("extra")))).alias("gap"))
        room = F.when(F.col("gap") > 0, (F.col("extra") < F.col("n")) & (F.col("base") + 1 <= cap)).otherwise(F.col("extra") > 0)
        off = F.abs(F.abs("gap") - F.col("size"))
        move = g.join(gap, "sid").filter(room & (off < F.abs("gap"))).groupBy("sid").agg(
            F.min(F.struct(off.alias("off"), "size", "bucket", F.signum("gap").cast("long").alias("step"))).alias("m"))
        move = move.select("sid", "m.size", "m.bucket", "m.step")
        g = g.join(move, ["sid", "size", "bucket"], "left").withColumn("extra", F.col("extra") + F.coalesce("step", F.lit(0))).drop("step")
    return g.select("sid", "size", "bucket", "base", "extra")


def _mixed(rows: DataFrame, weights: Sequence[float], cap: float, bucket_rows: int) -> DataFrame:
    """``rows`` (source, size, o, payload) with sid's facts and the copies of each row."""
    hist = written(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mixing-sizes")
    sources = written(_sources(hist, weights, cap), "mixing-sources")
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    hist = hist.alias("a").join(sources.select("source", "sid").alias("b"), same).select("a.*", "sid")
    multipliers = _solve(hist.select("sid", "size", "n"), sources, cap)

    parts = hist.select("source", "size", F.ceil(F.col("n") / F.lit(bucket_rows)).alias("parts"), "sid")
    placed = (rows.alias("a").join(parts.alias("b"), same & (F.col("a.size") == F.col("b.size")))
              .select("a.*", "sid", F.pmod("o", "parts").alias("bucket")))
    counted = placed.groupBy("sid", "size", "bucket").agg(F.count("*").alias("n"))
    groups = written(counted.join(sources.select("sid", "mean", "target"), "sid").join(multipliers, "sid", "left"), "mixing-groups")
    plan = written(_rounded(groups, cap), "mixing-copies")
    rank = F.row_number().over(Window.partitionBy("sid", "size", "bucket").orderBy("o"))
    return (placed.withColumn("rank", rank).join(plan, ["sid", "size", "bucket"])
            .withColumn("copies", (F.col("base") + F.when(F.col("rank") <= F.col("extra"), 1).otherwise(0)).cast("long"))
            .join(sources.select("sid", "source_size", "target"), "sid"))


def _size() -> Column:
    return F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size")


def _order() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("o")


def mix_sources(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, bucket_rows: int = 256) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken, copies, source``.

    ``size`` counts words (null and empty texts: 0, taken once, 0 words); a null source is a
    source of its own, last in order. Weights repeat along the sources in code-point order;
    targets share the corpus' total size, none above ``cap`` times its source's. No document is
    taken more than ``cap`` times. Rows that repeat a ``doc_id`` are documents of their own;
    the same input gives the same copies. An empty table gives no rows. Only ``doc_id``,
    ``text`` and ``source`` are read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _size(), _order())
    return _mixed(written(rows, "mixing-rows"), weights, cap, bucket_rows).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "source")


def mixed_documents(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, bucket_rows: int = 256) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it."""
    rows = docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("source"), _size(), _order())
    return (_mixed(rows, weights, cap, bucket_rows)
            .select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"))
            .select("row.*"))
