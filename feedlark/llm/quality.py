"""Quality rules: fixed limits on text statistics, then robust multivariate outliers.

The statistics of a text are transformed to a vector. For every language and source the centre and
scatter of the vectors are estimated by the minimum covariance determinant (Rousseeuw and Van
Driessen, 1999): concentration steps keep the share `CORE` of rows that lie nearest, beginning with
distances from median and median absolute deviation, until the determinant no longer falls, and a
text is rejected by its Mahalanobis distance. Variances get a floor, since most texts have, for
instance, no repeated line at all, and a scatter of zero would reject every other text.

Everything is an expression, join or aggregate of Spark. Estimates of all cells are rows of a table,
which is joined to the vectors; only the vectors (a few numbers a row) are shuffled, never texts.

Defined results: a null text has no words and fails the base rules; null languages and sources are
values of their own; sources of fewer than `LEAST_ROWS` judged texts are taken together within their
language, then over all languages, and if even those are few, they are not rejected. Repeated rows
count as often as they occur; an empty table stays empty. All columns
of the input are kept, but for those named like an added one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.llm.common import BLANKS, pieces, shield, small, unshield

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
CORE = 0.75  # share of rows that the estimate rests on
STEPS = 4  # concentration steps at most
LEAST_ROWS = 100
MEDIAN_CHI2 = 4.3515  # median of the chi-square distribution with 5 degrees of freedom
CUT_CHI2 = 140.0  # squared distance from which a text is rejected; far out, as clean texts have long tails
ACCURACY = 10_000  # of the quantiles of distances
MOST_CELLS = 100_000  # estimates that are broadcast, of some 200 bytes each

# Feature -> (transformed statistic, floor of its standard deviation)
FEATURES = {
    "length": ("ln(1 + n_words)", 0.3),
    "word_length": ("ln(greatest(word_chars, 1) / greatest(n_words, 1))", 0.1),
    "symbols": ("sqrt(n_symbols / greatest(word_chars, 1))", 0.05),
    "dup_lines": ("ln(1 + n_dup_lines)", 0.5),
    "repeats": ("sqrt(n_repeat_words / greatest(n_words, 1))", 0.1),
}


def _repeat_count(windows: Column) -> Column:
    """Words that stand in a window of three words which occurs at least twice.

    The windows' 64-bit hashes are sorted with their places, so equal windows become neighbours; the
    places found are sorted, and each adds the words that the one before has not covered.
    """
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(sorted_pairs: Column) -> Column:
        last = F.size(sorted_pairs) - 1
        kept = F.filter(
            sorted_pairs,
            lambda p, j: ((j > 0) & (F.get(sorted_pairs, j - 1)["h"] == p["h"]))
            | ((j < last) & (F.get(sorted_pairs, j + 1)["h"] == p["h"])),
        )
        return F.sort_array(F.transform(kept, lambda p: p["i"]))

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n"))
        return F.aggregate(
            places,
            start,
            lambda seen, p: F.struct(p.alias("at"), (seen["n"] + F.least(F.lit(3), p - seen["at"])).alias("n")),
        )["n"]

    # a variable for an array that is used several times: transform over an array of one
    return F.get(F.transform(F.array(F.get(F.transform(F.array(pairs), repeated), F.lit(0))), covered), F.lit(0))


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with the base statistics of whole texts."""
    df, names = shield(df.withColumn("__text", F.col(text)), "__text")
    text = "__text"
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    split = df.withColumn("_words", pieces(F.col(text), BLANKS))
    windows = F.when(
        F.size("_words") > 3,
        F.transform(
            F.sequence(F.lit(0), F.size("_words") - 3),
            lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    split = split.withColumn("_windows", windows).withColumn("_lines", lines)
    several = F.size(F.array_distinct("_windows")) < F.size("_windows")
    counted = split.select(
        *names.values(),
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(several, _repeat_count(F.col("_windows"))).otherwise(0).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return unshield(counted.withColumn("base_failed", failed), names)


def _distance(centre: str = "m") -> Column:
    """Squared Mahalanobis distance: forward substitution with the Cholesky factor of the scatter."""
    z: list[Column] = []
    for i, x in enumerate(FEATURES):
        rest = F.col(x) - F.col(f"{centre}{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * z[k]
        z.append(rest / F.col(f"l{i}{i}"))
    return reduce(lambda a, b: a + b, (v * v for v in z))


def _start(vectors: DataFrame) -> DataFrame:
    """(cell, centre, factor) from medians and median absolute deviations, without correlations."""
    medians = vectors.groupBy("cell").agg(
        *(F.percentile_approx(x, 0.5, ACCURACY).alias(f"m{i}") for i, x in enumerate(FEATURES))
    )
    medians = runtime.materialise(medians, "medians")
    spread = vectors.join(small(medians, MOST_CELLS), "cell").groupBy("cell").agg(
        *(F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, ACCURACY).alias(f"s{i}") for i, x in enumerate(FEATURES))
    )
    floors = [floor for _, floor in FEATURES.values()]
    factor = [
        (F.greatest(1.4826 * F.col(f"s{i}"), F.lit(floors[i])) if i == k else F.lit(0.0)).alias(f"l{i}{k}")
        for i in range(len(floors))
        for k in range(i + 1)
    ]
    return medians.join(spread, "cell").select("cell", *(f"m{i}" for i in range(len(floors))), *factor)


def _concentrate(vectors: DataFrame, estimate: DataFrame) -> DataFrame:
    """One concentration step: the nearest rows of every cell give the next centre and scatter."""
    placed = vectors.join(small(estimate, MOST_CELLS), "cell").withColumn("d2", _distance())
    cuts = placed.groupBy("cell").agg(F.percentile_approx("d2", CORE, ACCURACY).alias("cut"))
    cuts = runtime.materialise(estimate.join(cuts, "cell"), "cuts")
    near = vectors.join(small(cuts, MOST_CELLS), "cell").withColumn("d2", _distance()).filter("d2 <= cut")
    names = list(FEATURES)
    n = len(names)
    sums = near.groupBy("cell").agg(
        *(F.avg(x).alias(f"m{i}") for i, x in enumerate(names)),
        *(F.covar_pop(names[i], names[k]).alias(f"c{i}{k}") for i in range(n) for k in range(i + 1)),
    )
    floors = [floor for _, floor in FEATURES.values()]
    for k in range(n):  # Cholesky, column by column
        here = F.col(f"c{k}{k}") + floors[k] ** 2
        for j in range(k):
            here = here - F.col(f"l{k}{j}") * F.col(f"l{k}{j}")
        sums = sums.withColumn(f"l{k}{k}", F.sqrt(F.greatest(here, F.lit(1e-12))))
        for i in range(k + 1, n):
            below = F.col(f"c{i}{k}")
            for j in range(k):
                below = below - F.col(f"l{i}{j}") * F.col(f"l{k}{j}")
            sums = sums.withColumn(f"l{i}{k}", below / F.col(f"l{k}{k}"))
    kept = [f"l{i}{k}" for i in range(n) for k in range(i + 1)]
    return runtime.materialise(sums.select("cell", *(f"m{i}" for i in range(n)), *kept), "estimate")


def _determinants(estimate: DataFrame) -> float:
    """Sum over the cells of the logarithm of the determinant."""
    logs = reduce(lambda a, b: a + b, (F.log(F.col(f"l{i}{i}")) for i in range(len(FEATURES))))
    return estimate.agg(F.sum(2 * logs)).first()[0] or 0.0


def _cells(judged: DataFrame, language: str, source: str) -> DataFrame:
    """(language, source, cell): small sources of a language form one cell, and so do the rows of all
    languages whose small sources are still few; cell is null where even those are few."""
    small = F.when(F.col("n_cell") < LEAST_ROWS, F.col("n_cell")).otherwise(0)
    sizes = judged.groupBy(language, source).agg(F.count(F.lit(1)).alias("n_cell"))
    sizes = runtime.materialise(sizes, "cells")
    by_language = sizes.groupBy(F.col(language).alias("_l")).agg(F.sum(small).alias("n_left"))
    by_language = runtime.materialise(by_language, "cells")
    left = F.when(F.col("n_left") < LEAST_ROWS, F.col("n_left")).otherwise(0)
    rest = by_language.agg(F.sum(left)).first()[0] or 0
    known = sizes.join(by_language, F.col(language).eqNullSafe(F.col("_l")))

    def name(*parts: str) -> Column:
        return F.xxhash64(*(F.coalesce(F.concat(F.lit("="), F.col(p)), F.lit("-")) for p in parts))

    cell = (
        F.when(F.col("n_cell") >= LEAST_ROWS, name(language, source))
        .when(F.col("n_left") >= LEAST_ROWS, name(language))
        .otherwise(F.lit(0 if rest >= LEAST_ROWS else None).cast("long"))
    )
    return known.select(F.col(language).alias("_l2"), F.col(source).alias("_s2"), cell.alias("cell"))


def robust_quality(
    counted: DataFrame, language: str = "lang", source: str = "source", cut: float = CUT_CHI2
) -> DataFrame:
    """Rows of `with_statistics` with distance (squared, null where not judged) and kept.

    The rows are stored, so drop the text first where it is not needed.
    """
    counted = counted.withColumns({"__language": F.col(language), "__source": F.col(source)})
    language, source = "__language", "__source"
    counted, names = shield(counted, language, source, *STATISTICS, "base_failed")
    stored = runtime.materialise(counted, "statistics")
    judged = stored.filter(~F.col("base_failed"))
    cells = runtime.materialise(_cells(judged, language, source), "cell-names")
    features = [F.expr(e).alias(n) for n, (e, _) in FEATURES.items()]
    same = F.col(language).eqNullSafe(F.col("_l2")) & F.col(source).eqNullSafe(F.col("_s2"))
    vectors = judged.join(small(cells, MOST_CELLS), same).select("cell", *features).filter("cell is not null")
    vectors = runtime.materialise(vectors, "vectors")
    estimate = runtime.materialise(_start(vectors), "estimate")
    last = None
    for _ in range(STEPS):
        estimate = _concentrate(vectors, estimate)
        now = _determinants(estimate)
        if last is not None and now > last - 1e-3:
            break
        last = now
    placed = vectors.join(small(estimate, MOST_CELLS), "cell").withColumn("d2", _distance())
    scale = placed.groupBy("cell").agg(
        (F.greatest(F.percentile_approx("d2", 0.5, ACCURACY), F.lit(1e-9)) / MEDIAN_CHI2).alias("scale")
    )
    final = runtime.materialise(cells.join(estimate.join(scale, "cell"), "cell", "left"), "final")
    values = [c for c in final.columns if c not in ("cell", "_l2", "_s2")]
    told = stored.join(small(final, MOST_CELLS), same, "left").select(*stored.columns, *features, *values)
    distance = F.when(~F.col("base_failed"), _distance() / F.col("scale"))
    told = told.select(*stored.columns, distance.alias("distance"))
    keep = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cut)
    return unshield(told.drop(language, source).withColumn("kept", keep), names)
