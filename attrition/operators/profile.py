"""Table profile (A1-A10): shape, column info, describe, value counts, nulls,
histograms, box-plot statistics, correlations, churn rate.

Each statistic over many columns is one aggregate pass whose single wide row
is then unpivoted (``explode`` of an array of structs), so the number of
scans does not grow with the number of columns.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.functions.exprs import q as qn
from attrition.operators.rfm import estimated_bytes, exact_quantiles, quantile_table
from attrition.schema import ID, LABEL

QUARTILES = [0.25, 0.5, 0.75]


def shape(df: DataFrame) -> DataFrame:
    """n_rows, n_cols."""
    return df.select(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_cols"))


def column_info(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-null count (``info()``)."""
    structs = [
        F.struct(
            F.lit(i).cast("long").alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.count(F.col(f"`{f.name}`")).alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.select(F.inline(F.array(*structs)))


def null_counts(df: DataFrame) -> DataFrame:
    structs = [
        F.struct(F.lit(c).alias("column"), F.count_if(F.col(f"`{c}`").isNull()).alias("null_count"))
        for c in df.columns
    ]
    return df.select(F.inline(F.array(*structs)))


# A column whose (approximate) distinct count is below this keeps the exact
# value -> count buffer of ``percentile``; above it, exact quantiles come from
# selection instead (the same values).
MAP_MAX_DISTINCT = 200_000
# Inputs estimated below this size cannot hold a large map: skip the distinct-count pass.
SMALL_INPUT_BYTES = 8 << 20


def quantile_methods(df: DataFrame, cols: list[str], method: str = "auto") -> dict[str, str]:
    """Exact-quantile strategy per column: 'percentile' or 'cuts' (or 'approx').

    ``auto``: tiny inputs (optimizer estimate <= 8 MB) use ``percentile``
    throughout; others pay one aggregate of ``approx_count_distinct`` for all
    columns and use selection (``cuts``) where the value map would be large (the
    map's size is set by distinct values, not bytes: 10^7 ids fit in 185 MB of
    Parquet but make a 10^7-entry map merged in one task).
    """
    if method in ("percentile", "cuts", "approx"):
        return {c: method for c in cols}
    if method not in ("auto", "window"):
        raise ValueError(method)
    if method == "window" or estimated_bytes(df) <= SMALL_INPUT_BYTES:
        return {c: "percentile" for c in cols}
    row = df.select(*[F.approx_count_distinct(F.col(c), 0.05).alias(f"d{i}") for i, c in enumerate(cols)]).first()
    return {c: "percentile" if row[f"d{i}"] <= MAP_MAX_DISTINCT else "cuts" for i, c in enumerate(cols)}


def _quartiles(x, how: str, exact: list[float] | None = None):
    if how == "percentile":
        return F.percentile(x, F.array(*[F.lit(p) for p in QUARTILES]))
    if how == "approx":
        return F.percentile_approx(x, F.array(*[F.lit(p) for p in QUARTILES]), 100_000)
    return F.array(*[F.lit(v) for v in exact]).cast("array<double>")


def describe(df: DataFrame, cols: list[str], method: str = "auto", id_col: str = ID) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear interpolation), max.

    Quartiles per column (see :func:`quantile_methods`): ``percentile`` (exact;
    buffer = distinct values), ``cuts`` (exact, selection of all such columns
    at once), ``approx`` (``percentile_approx``, inexact, opt-in only).
    Everything else is one aggregate pass.  Not ``df.summary()``: its
    quartiles are approximate.
    """
    how = quantile_methods(df, cols, method)
    chosen = [c for c in cols if how[c] == "cuts"]
    found = exact_quantiles(df, chosen, QUARTILES) if chosen else {}
    structs = []
    for c in cols:
        x = F.col(c).cast("double")
        exact = found.get((None, c), [None] * 3)
        qs = _quartiles(x, how[c], exact)
        structs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("count"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.min(x).alias("min"),
                F.get(qs, 0).alias("p25"),
                F.get(qs, 1).alias("p50"),
                F.get(qs, 2).alias("p75"),
                F.max(x).alias("max"),
            )
        )
    return df.select(F.inline(F.array(*structs)))


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Rows per distinct value, most frequent first (ties by value).

    Partial aggregation runs before the shuffle, so a value holding a third of
    the rows costs one pre-summed row per task.  With ``normalize`` the share of
    the total (one scalar count) is added.
    """
    out = df.groupBy(F.col(col)).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = df.select(F.count(F.lit(1))).scalar()
        out = out.withColumn("share", F.col("count") / total)
    return out.orderBy(F.col("count").desc(), F.col(col).asc())


def churn_rate(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.select(F.avg(F.col(label).cast("double")).alias("churn_rate"))


def _finite(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def histogram(df: DataFrame, cols: list[str], bins: int = 30) -> DataFrame:
    """Equal-width histogram per column: column, bin, bin_lo, bin_hi, count.

    Nulls, NaN and infinities lie in no bin and do not widen the range; a column without
    finite values has null bounds and empty bins.
    Bin i covers [lo + i*w, lo + (i+1)*w) with w = (hi-lo)/bins; the last bin
    is closed.  When hi == lo the range is widened to [lo-0.5, lo+0.5] (as
    NumPy does).  min/max come from one scalar subquery; the counts of all
    bins of all columns come from one more aggregate of conditional counts,
    so empty bins are kept without a join.  The wide aggregate is handed to
    Spark as one SQL expression string (one driver call instead of hundreds).
    """
    mm = df.select(
        F.struct(*[F.struct(F.min(_finite(c)).alias("lo"), F.max(_finite(c)).alias("hi")).alias(f"c{i}") for i, c in enumerate(cols)]).alias("s")
    ).scalar()
    tmp = df.withColumn("_mm", mm)
    bin_exprs, structs = [], []
    for i, c in enumerate(cols):
        lo0, hi0 = f"_mm.c{i}.lo", f"_mm.c{i}.hi"
        lo = f"CASE WHEN {lo0} = {hi0} THEN {lo0} - 0.5 ELSE {lo0} END"
        hi = f"CASE WHEN {lo0} = {hi0} THEN {hi0} + 0.5 ELSE {hi0} END"
        x = f"CAST({qn(c)} AS DOUBLE)"
        x = f"(CASE WHEN abs({x}) < double('infinity') THEN {x} END)"
        # ``least`` passes over nulls, so they are kept out first
        b = f"CASE WHEN {x} IS NOT NULL THEN least(floor(({x} - ({lo})) / (({hi}) - ({lo})) * {bins}), {bins - 1}) END"
        bin_exprs += [f"{b} AS _b{i}", f"{lo} AS _lo{i}", f"{hi} AS _hi{i}"]
        counts = ", ".join(f"count_if(_b{i} = {k})" for k in range(bins))
        structs.append(f"struct('{c}' AS column, first(_lo{i}) AS lo, first(_hi{i}) AS hi, array({counts}) AS counts)")
    wide = tmp.selectExpr(*bin_exprs).selectExpr(f"inline(array({', '.join(structs)}))")
    per_bin = wide.selectExpr("column", "lo", "hi", "posexplode(counts) AS (bin, count)")
    w = f"((hi - lo) / {bins})"
    return per_bin.selectExpr(
        "column",
        "CAST(bin AS BIGINT) AS bin",
        f"lo + bin * {w} AS bin_lo",
        f"lo + (bin + 1) * {w} AS bin_hi",
        "CAST(count AS BIGINT) AS count",
    )


# Most groups whose quartiles are fetched and inlined as literals (no join).
MAX_LITERAL_GROUPS = 64


def _group_quartiles(df: DataFrame, cols: list[str], by: str, how: dict[str, str]) -> DataFrame:
    """``_g`` and ``_q_<column>`` for each group (null is one), exact on either way."""
    mapped = [c for c in cols if how[c] != "cuts"]
    chosen = [c for c in cols if how[c] == "cuts"]
    out = df.groupBy(F.col(by).alias("_g")).agg(
        F.count(F.lit(1)).alias("_rows"), *[_quartiles(F.col(c).cast("double"), how[c]).alias(f"_q_{c}") for c in mapped])
    out = out.drop("_rows")
    if chosen:
        table = quantile_table(df, chosen, QUARTILES, by)
        wide = table.groupBy(F.col("g").alias("_h")).agg(
            *[F.max(F.when(F.col("c") == i, F.col("q"))).alias(f"_q_{c}") for i, c in enumerate(chosen)])
        out = out.join(wide, F.col("_g").eqNullSafe(F.col("_h")), "left").drop("_h")
    return out


def boxplot_stats(df: DataFrame, cols: list[str], by: str = LABEL, method: str = "auto",
                  id_col: str = ID) -> DataFrame:
    """Per column and group: q1, median, q3, whiskers, outlier count.

    Whiskers are the farthest values within 1.5 IQR of the quartiles.  Null is
    a group of its own.  The quartiles (``percentile``, or selection for
    high-cardinality columns; see :func:`quantile_methods`) come back to the
    rows as literals for up to ``MAX_LITERAL_GROUPS`` groups, else by a
    null-safe join on the group (adaptive execution broadcasts the quartile
    table when its measured size allows); the answer is the same.  The whisker
    and outlier pass is one grouped aggregate with partial aggregation, so a
    group holding most rows is pre-summed map-side.
    """
    how = quantile_methods(df, cols, method)
    rows = df.select(by, *cols)
    quart = _group_quartiles(df, cols, by, how)
    few = df.select(by).distinct().limit(MAX_LITERAL_GROUPS + 1).count() <= MAX_LITERAL_GROUPS
    if few:
        found = quart.collect()
        null = F.lit(None).cast("array<double>")
        lit_cols = {}
        for c in cols:
            expr = null
            for r in found:
                values = r[f"_q_{c}"]
                arr = null if values is None else F.array(*[F.lit(v) for v in values]).cast("array<double>")
                expr = F.when(F.col(by).eqNullSafe(F.lit(r["_g"])), arr).otherwise(expr)
            lit_cols[f"_q_{c}"] = expr
        rows = rows.withColumns(lit_cols)
    else:
        rows = rows.join(quart, F.col(by).eqNullSafe(F.col("_g")))
    structs = []
    for c in cols:
        x = F.col(c).cast("double")
        q = F.col(f"_q_{c}")
        q1, q2, q3 = F.get(q, 0), F.get(q, 1), F.get(q, 2)
        lo_f, hi_f = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        structs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.first(q1).alias("q1"),
                F.first(q2).alias("median"),
                F.first(q3).alias("q3"),
                F.min(F.when(x >= lo_f, x)).alias("whisker_lo"),
                F.max(F.when(x <= hi_f, x)).alias("whisker_hi"),
                F.count_if((x < lo_f) | (x > hi_f)).alias("n_outliers"),
            )
        )
    return rows.groupBy(by).agg(F.array(*structs).alias("_s")).select(by, F.inline("_s"))


# Up to this many columns each pair has aggregates of its own; their number grows with the square of the columns.
PAIRWISE_MAX_COLS = 24


def corr_long(df: DataFrame, cols: list[str], method: str = "auto") -> DataFrame:
    """Pearson correlation of every pair, long form (col_a, col_b, corr).

    Rows where both values are present count for a pair (as in pandas).  A column that does not vary on them has a
    null correlation; the diagonal is 1.  ``pairs``: two ``regr_slope`` aggregates for each unordered pair of columns,
    whose product is the squared correlation (``corr`` itself divides by zero on a constant column), used for both
    orientations.  ``gram``: one matrix of moments (:func:`_corr_gram`).  ``auto`` chooses by the number of columns.
    """
    if method == "gram" or (method == "auto" and len(cols) > PAIRWISE_MAX_COLS):
        return _corr_gram(df, cols)
    structs = []
    for a, b in itertools.combinations(cols, 2):
        x, y = f"CAST({qn(a)} AS DOUBLE)", f"CAST({qn(b)} AS DOUBLE)"
        v = f"sign(regr_slope({y}, {x})) * sqrt(regr_slope({y}, {x}) * regr_slope({x}, {y}))"
        structs.append(f"struct('{a}' AS col_a, '{b}' AS col_b, {v} AS corr)")
        structs.append(f"struct('{b}' AS col_a, '{a}' AS col_b, {v} AS corr)")
    for a in cols:
        structs.append(f"struct('{a}' AS col_a, '{a}' AS col_b, CAST(1.0 AS DOUBLE) AS corr)")
    return df.selectExpr(f"inline(array({', '.join(structs)}))")


def _corr_gram(df: DataFrame, cols: list[str]) -> DataFrame:
    """Correlations from one mergeable matrix of moments: two scans, whatever the number of columns.

    The first scan takes the means, the second adds up, for values centred by them (nulls as 0, so
    that each pair counts the rows that have both), six sums for each pair of columns.  A task
    sends one row for each pair, Spark adds them up; the state is columns x columns x 6 doubles.
    """
    names = [qn(c) for c in cols]
    means = df.select(*[F.coalesce(F.avg(_finite(c)), F.lit(0.0)).alias(f"m{i}") for i, c in enumerate(names)]).first()
    mean = np.array(list(means), dtype=float)
    d = len(cols)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, d, d))
        for batch in batches:
            null = np.stack([np.asarray(c.is_null()) for c in batch.columns], axis=1)
            x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns], axis=1) - mean
            x[null] = 0.0
            has = (~null).astype(float)
            with np.errstate(invalid="ignore", over="ignore"):
                total += np.stack([has.T @ has, x.T @ has, has.T @ x, (x * x).T @ has, has.T @ (x * x), x.T @ x])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(d), d)), pa.array(np.tile(np.arange(d), d)), *(pa.array(t.ravel()) for t in total)],
            names=["a", "b", "n", "sa", "sb", "saa", "sbb", "sab"])

    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    sums = ["n", "sa", "sb", "saa", "sbb", "sab"]
    per = rows.mapInArrow(moments, "a long, b long, " + ", ".join(f"{s} double" for s in sums))
    per = per.groupBy("a", "b").agg(*[F.sum(s).alias(s) for s in sums])
    va, vb = F.expr("saa - try_divide(sa * sa, n)"), F.expr("sbb - try_divide(sb * sb, n)")
    # a column varies if its variance is more than rounding leaves of its squares
    varies = (va > F.col("saa") * 1e-14) & (vb > F.col("sbb") * 1e-14)
    corr = F.when(F.col("a") == F.col("b"), F.lit(1.0)).when(varies, F.expr("sab - try_divide(sa * sb, n)") / F.sqrt(va * vb))
    name = F.array(*[F.lit(c) for c in cols])
    return per.select(F.get(name, F.col("a").cast("int")).alias("col_a"), F.get(name, F.col("b").cast("int")).alias("col_b"), corr.alias("corr"))


def profile(df: DataFrame, label: str = LABEL) -> dict[str, DataFrame]:
    """L4: every profile table of a customer frame (lazy; nothing runs here)."""
    feats = [c for c in df.columns if c not in (ID, label)]
    return {
        "shape": shape(df),
        "column_info": column_info(df),
        "describe": describe(df, df.columns),
        "churn_counts": value_counts(df, label),
        "churn_share": value_counts(df, label, normalize=True),
        "null_counts": null_counts(df),
        "histogram": histogram(df, feats),
        "boxplot": boxplot_stats(df, feats, label),
        "corr": corr_long(df, [c for c in df.columns if c != ID]),
        "churn_rate": churn_rate(df, label),
    }
