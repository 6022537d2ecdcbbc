"""Quantile scores (W1-W5): recency by value, frequency and spend by rank.

Semantics follow pandas ``qcut`` with ``q`` equal-probability bins:

* by value (``r_score``): edges are the linearly interpolated quantiles
  0, 1/q, ..., 1 of the column; bins are right-closed, the lowest value is in
  bin 1; duplicate edges are an error.
* by rank (``f_score``, ``m_score``): rows are ranked 1..n by
  ``(value, customer_id)`` (rank "first": ties keep row order, and row order
  is id order), then cut the same way.  For ranks the interpolated edge k is
  ``1 + (n-1)k/q``, so the bin of rank r is ``ceil(q(r-1)/(n-1))`` (at least
  1), which is exact integer arithmetic.  ``ntile`` is a different rule.

Two physical paths give the same bins:

* ``window``: ``row_number`` over a window ordered by (value, id).  A window
  without ``partitionBy`` runs in one partition, so it is for small inputs.
* ``cuts``: select the q-1 rows at the cut ranks (:mod:`selection`: scans with
  partial counts, no row is shuffled), then bin every row by comparing its key
  with those q-1 keys (a narrow projection).

Null values have no rank and no bin on either path.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attrition.operators.selection import cut_ranks_expr, quantile_ranks_expr, select_ranks
from attrition.schema import ID


class DuplicateEdgesError(ValueError):
    pass


# --------------------------------------------------------------------------
# by value (W1)
# --------------------------------------------------------------------------


def _levels(q: int) -> list[float]:
    return [k / q for k in range(q + 1)]


def value_edges_expr(df: DataFrame, col: str, q: int = 5) -> Column:
    """Scalar subquery holding the q+1 exact interpolated quantiles of ``col``.

    ``percentile`` is exact; its buffer is a value -> count map, so its size is
    the number of distinct values (a few thousand for day counts).  A
    duplicated edge raises inside the job, as ``qcut`` does.
    """
    e = F.percentile(F.col(col), F.array(*[F.lit(p) for p in _levels(q)]))
    dup = F.exists(F.sequence(F.lit(1), F.lit(q)), lambda i: F.get(e, i) == F.get(e, i - 1))
    checked = F.when(dup, F.raise_error(F.lit(f"duplicate quantile edges for {col}"))).otherwise(e)
    return df.select(checked.alias("edges")).scalar()


def _bin_from_edges(x: Column, edges: Column, q: int) -> Column:
    """1 + number of inner edges strictly below x (right-closed bins)."""
    below = sum(((x > F.get(edges, k)).cast("int") for k in range(1, q)), F.lit(0))
    return F.when(x.isNull(), F.lit(None)).otherwise((F.lit(1) + below).cast("long"))


def qcut_by_value(df: DataFrame, col: str, q: int = 5, out: str | None = None, reverse: bool = False,
                  method: str = "percentile", id_col: str = ID) -> DataFrame:
    """Bin ``col`` into q quantile bins by value; ``reverse`` labels them q..1.

    ``percentile`` (default): edges from one exact ``percentile`` aggregate
    (buffer = distinct values: right for bounded columns such as day counts).
    ``cuts``: exact edges by selection, for high-cardinality columns at scale
    (edges become literals).
    """
    x = F.col(col).cast("double")
    if method == "percentile":
        edges = value_edges_expr(df, col, q)
    elif method == "cuts":
        e = exact_quantiles(df, [col], _levels(q)).get((None, col), [None])
        if any(v is None for v in e):
            return df.withColumn(out or f"{col}_bin", F.lit(None).cast("long"))
        if len(set(e)) < len(e):
            raise DuplicateEdgesError(f"duplicate quantile edges for {col}: {e}")
        edges = F.array(*[F.lit(float(v)) for v in e])
    else:
        raise ValueError(f"unknown method {method!r}")
    b = _bin_from_edges(x, edges, q)
    if reverse:
        b = F.lit(q + 1) - b
    return df.withColumn(out or f"{col}_bin", b.cast("long"))


# --------------------------------------------------------------------------
# by rank (W2-W4)
# --------------------------------------------------------------------------


def idiv(a: Column, b: Column) -> Column:
    """Integer division floor(a/b) for a >= 0, b >= 1 (exact below 2**53)."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def rank_bin(rn: Column, n: Column, q: int) -> Column:
    """Bin of rank rn among n ranks: greatest(1, ceil(q(rn-1)/(n-1)))."""
    return F.greatest(F.lit(1).cast("long"), idiv(F.lit(q) * (rn - 1) + n - 2, n - 1))


def _rank_bin_window(df: DataFrame, col: str, id_col: str, q: int, out: str, n: Column | None = None) -> DataFrame:
    if n is None:
        n = df.where(F.col(col).isNotNull()).select(F.count(F.lit(1))).scalar()
    checked = F.when(n == 1, F.raise_error(F.lit(f"duplicate quantile edges for {col}"))).otherwise(n)
    w = Window.orderBy(F.col(col).asc_nulls_last(), F.col(id_col).asc())
    rn = F.when(F.col(col).isNotNull(), F.row_number().over(w))
    out_df = df.withColumn("_n", checked.cast("long"))
    out_df = out_df.withColumn(out, F.when(F.col(col).isNotNull(), rank_bin(rn, F.col("_n"), q)).cast("long"))
    return out_df.drop("_n")


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of a plan (no job runs); an upper bound for scans."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Inputs estimated below this size take the single-partition window path
# (the estimate is compressed file size, so one task may hold several times it).
WINDOW_MAX_BYTES = 64 << 20


def choose_method(df: DataFrame, method: str) -> str:
    if method != "auto":
        return method
    return "window" if estimated_bytes(df) <= WINDOW_MAX_BYTES else "cuts"


@dataclass
class RankCuts:
    """Keys (value, id) at the cut ranks; bin = 1 + #(key > cut_k).

    ``shares`` is, for each cut, the part of the rows of its value that lie at
    or below it: the frozen form splits tied new rows in the same proportion.
    """

    col: str
    id_col: str
    q: int
    n: int
    keys: list[tuple] = field(default_factory=list)  # q-1 (value, id) pairs
    shares: list[float] = field(default_factory=list)

    def bin(self, x: Column | None = None, ident: Column | None = None) -> Column:
        x = F.col(self.col) if x is None else x
        ident = F.col(self.id_col) if ident is None else ident
        terms = [((x > F.lit(v)) | ((x == F.lit(v)) & (ident > F.lit(i)))).cast("int") for v, i in self.keys]
        return F.when(x.isNull(), F.lit(None)).otherwise((F.lit(1) + sum(terms, F.lit(0))).cast("long"))

    def frozen_bin(self, x: Column | None = None, ident: Column | None = None) -> Column:
        """Bin of new rows: by value; rows tied with a cut value are split by a hash
        of the id in the proportion that the fitted rows were."""
        x = F.col(self.col) if x is None else x
        ident = F.col(self.id_col) if ident is None else ident
        u = tie_position(self.col, ident)
        terms = [((x > F.lit(v)) | ((x == F.lit(v)) & (u >= F.lit(s)))).cast("int")
                 for (v, _), s in zip(self.keys, self.shares, strict=True)]
        return F.when(x.isNull(), F.lit(None)).otherwise((F.lit(1) + sum(terms, F.lit(0))).cast("long"))


def tie_position(col: str, ident: Column) -> Column:
    """A number in [0, 1) from the column name and the id."""
    key = F.substring(F.md5(F.concat(F.lit(f"{col}-"), ident.cast("string"))), 1, 8)
    return F.conv(key, 16, 10).cast("double") / F.lit(float(2**32))


def cut_ranks(n: int, q: int) -> list[int]:
    """1-based ranks of the last row of bins 1..q-1: floor(1 + (n-1)k/q)."""
    return [1 + ((n - 1) * k) // q for k in range(1, q)]


def _cuts_by_window(df: DataFrame, cols: list[str], id_col: str, q: int) -> list:
    """Small-input form of the selection: the wanted rows of a single-partition ``row_number``."""
    out = []
    for i, col in enumerate(cols):
        keys = df.select(F.col(col).alias("value"), F.col(id_col).alias("id")).where("value IS NOT NULL")
        n = keys.count()
        ranks = cut_ranks(n, q) if n else []
        rn = F.row_number().over(Window.orderBy("value", "id"))
        tie = Window.partitionBy("value")
        rows = keys.withColumn("rank", rn).withColumn("m", F.count(F.lit(1)).over(tie))
        rows = rows.withColumn("r", F.row_number().over(tie.orderBy("id"))).where(F.col("rank").isin(ranks)).collect()
        at = {r["rank"]: r for r in rows}
        out += [(i, k, n, at[rank]["value"], at[rank]["id"], at[rank]["r"], at[rank]["m"]) for k, rank in enumerate(ranks)]
    return out


def fit_cuts(df: DataFrame, cols: list[str], id_col: str = ID, q: int = 5, method: str = "cuts") -> list[RankCuts]:
    """Keys at the cut ranks of several columns; ``auto`` finds them with a window on small inputs.

    q-1 rows of each column reach the driver.
    """
    if choose_method(df, method) == "window":
        rows = _cuts_by_window(df, cols, id_col, q)
    else:
        found = select_ranks(df, cols, lambda n: cut_ranks_expr(n, q), id_col=id_col)
        rows = found.select("c", "k", "n", "value", "id", "r", "m").collect()
    return _rank_cuts(rows, cols, id_col, q)


def _rank_cuts(rows: list, cols: list[str], id_col: str, q: int) -> list[RankCuts]:
    """Cut keys of each column from rows (c, k, n, value, id, r, m)."""
    out = []
    for i, col in enumerate(cols):
        mine = sorted((tuple(r) for r in rows if r[0] == i), key=lambda r: r[1])
        n = mine[0][2] if mine else 0
        if n == 1:
            raise DuplicateEdgesError(f"duplicate quantile edges for {col}")
        out.append(RankCuts(col, id_col, q, n, [(r[3], r[4]) for r in mine], [r[5] / r[6] for r in mine]))
    return out


def fit_rank_cuts(df: DataFrame, col: str, id_col: str = ID, q: int = 5, method: str = "cuts") -> RankCuts:
    return fit_cuts(df, [col], id_col, q, method)[0]


def qcut_by_rank(
    df: DataFrame, col: str, q: int = 5, id_col: str = ID, out: str | None = None, method: str = "auto"
) -> DataFrame:
    """Bin rows into q bins of their rank by (col, id) (pandas rank "first" + qcut)."""
    out = out or f"{col}_bin"
    method = choose_method(df, method)
    if method == "window":
        return _rank_bin_window(df, col, id_col, q, out)
    if method == "cuts":
        return df.withColumn(out, fit_rank_cuts(df, col, id_col, q).bin())
    raise ValueError(f"unknown method {method!r}")


# --------------------------------------------------------------------------
# exact value quantiles by selection (any cardinality, any number of columns and groups)
# --------------------------------------------------------------------------


def interpolated(found: DataFrame, levels: list[float]) -> DataFrame:
    """``g, c, q``: quantiles from the rows at the ranks of ``quantile_ranks_expr``.

    Uses the same interpolation as Spark's ``percentile``:
    ``(hi_pos - h) * lo + (h - lo_pos) * hi`` with ``h = (n-1) p``.
    """
    at = F.map_from_entries(F.collect_list(F.struct("k", F.col("value").cast("double"))))
    per = found.groupBy("g", "c").agg(F.first("n").alias("n"), at.alias("at"))
    out = []
    for i, p in enumerate(levels):
        h = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.element_at("at", F.lit(2 * i)), F.element_at("at", F.lit(2 * i + 1))
        out.append(F.when(F.floor(h) == F.ceil(h), lo).otherwise((F.ceil(h) - h) * lo + (h - F.floor(h)) * hi))
    return per.select("g", "c", F.array(*out).alias("q"))


def quantile_table(df: DataFrame, cols: list[str], levels: list[float], by: str | None = None) -> DataFrame:
    """``g, c, q``: linearly interpolated quantiles of column number c in group g (one array)."""
    return interpolated(select_ranks(df, cols, lambda n: quantile_ranks_expr(n, levels), by=by), levels)


def exact_quantiles(df: DataFrame, cols: list[str], levels: list[float], by: str | None = None) -> dict[tuple, list[float]]:
    """{(group, column): quantiles}; the group is None without ``by``.  A column without values is left out.

    One row for each group and column reaches the driver: use :func:`quantile_table` for many groups.
    """
    return {(r["g"] if by else None, cols[r["c"]]): r["q"] for r in quantile_table(df, cols, levels, by).collect()}


# --------------------------------------------------------------------------
# RFM (W1 + W3) batch-relative and frozen
# --------------------------------------------------------------------------


def rfm_features(df: DataFrame, q: int = 5, method: str = "auto", id_col: str = ID) -> DataFrame:
    """Add r_score (recency by value, reversed), f_score, m_score (by rank), rfm_score.

    Quantiles are relative to this batch, as in the reference.  ``window``: all batch
    statistics (recency edges, row counts) come from one aggregate over the
    input, attached once as a scalar struct.  ``cuts``: recency edges and cut keys by selection,
    so no value map and no sort of the table.
    """
    method = choose_method(df, method)
    if method == "cuts":
        edges, f, m = _rfm_cuts(df, q, id_col)
        r = F.lit(None) if edges is None else F.lit(q + 1) - _bin_from_edges(
            F.col("recency_days").cast("double"), F.array(*[F.lit(float(v)) for v in edges]), q)
        out = df.withColumns({"r_score": r.cast("long"), "f_score": f.bin(), "m_score": m.bin()})
        return out.withColumn("rfm_score", (F.col("r_score") + F.col("f_score") + F.col("m_score")).cast("long"))
    if method != "window":
        raise ValueError(f"unknown method {method!r}")
    e = F.percentile(F.col("recency_days"), F.array(*[F.lit(p) for p in _levels(q)]))
    dup = F.exists(F.sequence(F.lit(1), F.lit(q)), lambda i: F.get(e, i) == F.get(e, i - 1))
    stats = df.select(
        F.struct(
            F.when(dup, F.raise_error(F.lit("duplicate quantile edges for recency_days"))).otherwise(e).alias("edges"),
            F.count("frequency").alias("n_f"),
            F.count("monetary_value").alias("n_m"),
        ).alias("s")
    ).scalar()
    out = df.withColumn("_rfm", stats)
    r_bin = _bin_from_edges(F.col("recency_days").cast("double"), F.col("_rfm.edges"), q)
    out = out.withColumn("r_score", (F.lit(q + 1) - r_bin).cast("long"))
    out = _rank_bin_window(out, "frequency", id_col, q, "f_score", F.col("_rfm.n_f"))
    out = _rank_bin_window(out, "monetary_value", id_col, q, "m_score", F.col("_rfm.n_m"))
    return out.drop("_rfm").withColumn(
        "rfm_score", (F.col("r_score") + F.col("f_score") + F.col("m_score")).cast("long")
    )


RFM_COLS = ["recency_days", "frequency", "monetary_value"]


def _rfm_cuts(df: DataFrame, q: int, id_col: str) -> tuple[list[float] | None, RankCuts, RankCuts]:
    """Recency edges (None without values) and cut keys of frequency and spend, from one selection over the three columns."""
    first = F.col("c") == 0
    found = select_ranks(
        df, RFM_COLS, lambda n: F.when(first, quantile_ranks_expr(n, _levels(q))).otherwise(cut_ranks_expr(n, q)), id_col=id_col, id_where=~first)
    rows = found.collect()
    at = {r["k"]: r for r in rows if r["c"] == 0}
    edges = None
    if at:
        n, edges = at[0]["n"], []
        for i, p in enumerate(_levels(q)):
            h = (n - 1) * p
            lo, hi = at[2 * i]["value"], at[2 * i + 1]["value"]
            edges.append(lo if math.floor(h) == math.ceil(h) else (math.ceil(h) - h) * lo + (h - math.floor(h)) * hi)
        if len(set(edges)) < len(edges):
            raise DuplicateEdgesError(f"duplicate quantile edges for recency_days: {edges}")
    f, m = _rank_cuts([(r["c"] - 1, r["k"], r["n"], r["value"], r["id"], r["r"], r["m"]) for r in rows if r["c"]], RFM_COLS[1:], id_col, q)
    return edges, f, m


@dataclass
class RfmModel:
    """Frozen quantile state fitted on one batch and applied to later ones."""

    q: int
    recency_edges: list[float]
    frequency_cuts: RankCuts
    monetary_cuts: RankCuts

    def to_dict(self) -> dict:
        return {
            "q": self.q,
            "recency_edges": self.recency_edges,
            "frequency_keys": self.frequency_cuts.keys,
            "frequency_shares": self.frequency_cuts.shares,
            "monetary_keys": self.monetary_cuts.keys,
            "monetary_shares": self.monetary_cuts.shares,
        }


def fit_rfm(df: DataFrame, q: int = 5, id_col: str = ID, method: str = "auto") -> RfmModel:
    """Fit the RFM edges once (recency edges and cut keys for f/m; ``method`` picks how
    both are found: small inputs by a value map and a window, others by selection)."""
    if choose_method(df, method) == "window":
        e = df.select(F.percentile("recency_days", F.array(*[F.lit(p) for p in _levels(q)])).alias("e")).first()["e"]
        cuts = None
    else:
        e, *cuts = _rfm_cuts(df, q, id_col)
    if e is None:
        raise ValueError("cannot fit RFM edges on an empty table")
    if len(set(e)) < len(e):
        raise DuplicateEdgesError(f"duplicate quantile edges for recency_days: {e}")
    return RfmModel(q, [float(v) for v in e], *(cuts or fit_cuts(df, RFM_COLS[1:], id_col, q, "window")))


def apply_rfm(df: DataFrame, model: RfmModel) -> DataFrame:
    """Score new rows with frozen edges: r by value; f and m by the cut values,
    rows tied with a cut value split by a hash of the id in the fitted proportion
    (:meth:`RankCuts.frozen_bin`).  Works on streams (literals only).
    """
    q = model.q
    x = F.col("recency_days").cast("double")
    inner = model.recency_edges[1:q]
    r_bin = F.lit(1) + sum(((x > F.lit(e)).cast("int") for e in inner), F.lit(0))
    return df.withColumns(
        {
            "r_score": F.when(x.isNull(), F.lit(None)).otherwise(F.lit(q + 1) - r_bin).cast("long"),
            "f_score": model.frequency_cuts.frozen_bin(),
            "m_score": model.monetary_cuts.frozen_bin(),
        }
    ).withColumn("rfm_score", (F.col("r_score") + F.col("f_score") + F.col("m_score")).cast("long"))
