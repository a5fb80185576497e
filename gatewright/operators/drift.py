"""Feature drift: the population stability index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewright.functions.chunks import ordered_scan

_BLOCK = 16
SLICES = _BLOCK * _BLOCK
#: Size of a quantile sketch, and a little more than twice the error in rank that it usually has.
SKETCH_SIZE, SLACK = 4096, 0.003
#: Rows of a bracket that are ordered, and into how many steps a larger one is cut.
BRACKET_ROWS, NARROW = 1_000_000, 400


def _pairs(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per (feature, value) of every input row, missing values left out."""
    pairs = F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features]))
    return df.select(*by, pairs).filter(F.col("v").isNotNull() & ~F.isnan("v"))


def quantile_edges(counts: DataFrame, bins: int) -> DataFrame:
    """Inner bin edges ``e1`` .. per feature: the smallest value at or above each rank ``k * N / bins``.

    ``counts`` has one row per (feature, value) with its number ``n``. Exact and
    distributed: distinct values are scanned in order, each feature cut into
    slices of about equal size. The cuts are approximate quantiles, which only
    decide the balance; they are fetched first, by a job that runs when this is
    called, so that every part of the plan uses the same ones. That is ``SLICES``
    numbers for each feature the caller lists, however many rows there are.
    """
    points = [i / SLICES for i in range(1, SLICES)]
    found = counts.groupBy("feature").agg(F.sum("n").alias("total"), F.percentile_approx("v", points, 10_000).alias("cuts"))
    rows = [(r.feature, r.total, r.cuts[_BLOCK - 1 :: _BLOCK], r.cuts) for r in found.collect()]
    whole = counts.sparkSession.createDataFrame(rows, "feature string, total bigint, blocks array<double>, cuts array<double>")

    def below(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda cut: cut < F.col("v")))

    # First the block, then the place among its cuts.
    placed = counts.join(whole, "feature").withColumn("slice", below(F.col("blocks")))
    inside = below(F.slice("cuts", F.col("slice") * _BLOCK + 1, F.lit(_BLOCK - 1)))
    placed = placed.withColumn("slice", (F.col("slice") * _BLOCK + inside).cast("bigint")).drop("blocks", "cuts")
    ranked = ordered_scan(placed, ["feature"], ["v"], F.col("slice"), sum_upto={"upto": F.col("n")})
    edges = [
        F.min(F.when(F.col("upto") * bins >= F.col("total") * k, F.col("v"))).alias(f"e{k}") for k in range(1, bins)
    ]
    return ranked.groupBy("feature").agg(*edges)


def value_sketches(df: DataFrame, features: Sequence[str], size: int = SKETCH_SIZE) -> DataFrame:
    """``feature, n, sketch``: a quantile sketch of each feature, to be stored with its data and merged with others."""
    return _pairs(df, features).groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("v", F.lit(size)).alias("sketch"))


def merged_sketches(parts: DataFrame) -> DataFrame:
    """One sketch per feature from those of parts of the data."""
    return parts.groupBy("feature").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def _quantiles(ranks: Sequence[float]) -> Column:
    return F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(min(1.0, max(0.0, r))) for r in ranks]))


def bracketed_edges(df: DataFrame, features: Sequence[str], bins: int, sketches: DataFrame | None = None, most: int = BRACKET_ROWS) -> DataFrame:
    """Inner bin edges ``e1`` .. per feature: the smallest value at or above each rank ``k * N / bins``.

    Exact, without ordering the values. A sketch (``sketches``, or one made here)
    gives a bracket around every edge. A pass over the data counts what lies
    below and up to each bracket: one that does not hold its edge after all is
    widened, and one with more than ``most`` rows is narrowed by a sketch of what
    it holds. Only the values in the last brackets are grouped and ordered. The
    driver holds the brackets, ``bins - 1`` for each feature the caller lists.
    """
    spark, pairs = df.sparkSession, _pairs(df, features)
    if sketches is None:
        sketches = value_sketches(df, features)
    schema = "feature STRING, k INT, target BIGINT, low DOUBLE, high DOUBLE"
    minus, plus = float("-inf"), float("inf")

    def at(brackets: Sequence[tuple]) -> DataFrame:
        # A row per feature and edge the caller lists.
        return pairs.join(F.broadcast(spark.createDataFrame(brackets, schema)), "feature")

    ranks = [k / bins + side * SLACK for k in range(1, bins) for side in (-1, 1)]
    brackets = []
    for r in sketches.filter(F.col("feature").isin(list(features)) & (F.col("n") > 0)).select("feature", "n", _quantiles(ranks).alias("q")).collect():
        brackets += [(r.feature, k, -(-r.n * k // bins), r.q[2 * k - 2], r.q[2 * k - 1]) for k in range(1, bins)]
    settled, inside = [], {}
    while brackets:
        counted = {
            (r.feature, r.k): r
            for r in at(brackets).groupBy("feature", "k").agg(F.count_if(F.col("v") < F.col("low")).alias("below"), F.count_if(F.col("v") <= F.col("high")).alias("upto")).collect()
        }
        wrong, wide = [], []
        for feature, k, target, low, high in brackets:
            found = counted[feature, k]
            rows = found.upto - found.below
            if not found.below < target <= found.upto:
                wrong.append((feature, k, target, minus if found.below >= target else low, plus if found.upto < target else high))
            elif low < high and rows > most and rows * 2 <= inside.get((feature, k), rows * 2):
                inside[feature, k] = rows
                wide.append((feature, k, target, low, high, found.below, rows))
            else:
                settled.append((feature, k, target, low, high, found.below))
        brackets = wrong
        if wide:
            held = at([w[:5] for w in wide]).filter(F.col("v").between(F.col("low"), F.col("high")))
            steps = [i / NARROW for i in range(NARROW + 1)]
            told = {
                (r.feature, r.k): r.q
                for r in held.groupBy("feature", "k").agg(F.kll_sketch_agg_double("v", F.lit(SKETCH_SIZE)).alias("sketch")).select("feature", "k", _quantiles(steps).alias("q")).collect()
            }
            for feature, k, target, low, high, below, rows in wide:
                step = int((target - below) / rows * NARROW)
                points = told[feature, k]
                brackets.append((feature, k, target, points[max(0, step - 2)] if step > 2 else low, points[step + 3] if step + 3 <= NARROW else high))
    exact = {(f, k): low for f, k, _, low, high, _ in settled if low == high}
    rest = [s for s in settled if s[3] < s[4]]
    if rest:
        before = spark.createDataFrame([(f, k, b) for f, k, *_, b in rest], "feature STRING, k INT, below BIGINT")
        held = at([r[:5] for r in rest]).filter(F.col("v").between(F.col("low"), F.col("high")))
        upto = F.sum("n").over(Window.partitionBy("feature", "k").orderBy("v"))
        ranked = held.groupBy("feature", "k", "target", "v").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto).join(F.broadcast(before), ["feature", "k"])
        for r in ranked.filter(F.col("below") + F.col("upto") >= F.col("target")).groupBy("feature", "k").agg(F.min("v").alias("edge")).collect():
            exact[r.feature, r.k] = r.edge
    rows = [(f, *[exact[f, k] for k in range(1, bins)]) for f in sorted({f for f, _ in exact})]
    return spark.createDataFrame(rows, "feature STRING" + "".join(f", e{k} DOUBLE" for k in range(1, bins)))


def _bin(bins: int) -> Column:
    """Number of edges below the value: bins are ``(edge, next edge]``; equal edges leave a bin empty."""
    return sum(((F.col(f"e{k}") < F.col("v")).cast("int") for k in range(1, bins)), F.lit(0))


def psi(
    expected: DataFrame,
    actual: DataFrame,
    features: Sequence[str],
    bins: int = 10,
    by: Sequence[str] = (),
    limit: float = 0.3,
    floor: float = 1e-4,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """Stability index per feature, and per ``by`` group of ``actual``; ``drifted`` above the limit.

    Bins follow the expected data's quantiles, exact ones; ``sketches`` of it, if
    they are stored (:func:`value_sketches`), spare a pass. Everything else is
    counted per bin before the shuffle. Empty shares are lifted to ``floor``. Any
    number of features may be listed; their edges are a row each.
    """
    edges = bracketed_edges(expected, features, bins, sketches)

    def shares(values: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
        binned = values.join(F.broadcast(edges), "feature").withColumn("bin", _bin(bins))
        lifted = [F.greatest(F.count_if(F.col("bin") == b) / F.count(F.lit(1)), F.lit(floor)) for b in range(bins)]
        return binned.groupBy(*groups, "feature").agg(F.array(*lifted).alias(name))

    observed = shares(_pairs(actual, features, by), by, "actual")
    joined = observed.join(shares(_pairs(expected, features), [], "expected"), "feature")
    terms = F.zip_with("actual", "expected", lambda a, e: (a - e) * F.log(a / e))
    score = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    return joined.select(*by, "feature", score.alias("psi"), (score > limit).alias("drifted"))
