"""Exact order statistics by selection: values and rows at given ranks.

For every group and every column at once, the rows at some ranks are found
without sorting the table.  One scan builds a mergeable quantile sketch (KLL) of
each column and group; the sketch brackets each wanted rank between two values,
``MARGIN`` of the rows on either side.  While a bracket may hold more than
``BAND_ROWS`` rows, another scan sketches the rows inside the brackets alone, which
makes them some hundred times narrower.  The last scan counts the rows below each
bracket and, by value, the rows inside it; the wanted rank is then read off the
counts.  That is two scans up to 8 * 10^7 rows and three up to 10^9 or more, whatever the
values are; no row is sorted or shuffled, only pre-aggregated counts are.  The
sketch only brackets: a rank that its bracket missed is searched again with a
wider one, so the answer is exact.  Where over ``TIED_ROWS`` rows share the value, the same search over the ids of
those rows gives the row; the first and the last of them are known from the last scan.

Values are ordered as Spark orders them: -infinity, numbers, infinity, NaN (-0.0 equals 0.0).
The state is one small row for each group, column and rank; up to ``LOCAL_ROWS`` of them
are kept on the driver between scans, more are written as Parquet to the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from attrition.session import ensure_checkpoint_dir

SKETCH_K = 4096  # a KLL sketch of this size is off by about 0.0013 of the rows
MARGIN = 0.004
GRID = 512
BAND_ROWS = 1_000_000
TIED_ROWS = 100_000  # more rows of one value than this: the id at a rank is searched for, not sorted for
LOCAL_ROWS = 10_000

KEYS = ["g", "c", "k"]


def cut_ranks_expr(n: Column, q: int) -> Column:
    """1-based ranks of the last row of bins 1..q-1 of n rows."""
    return F.transform(F.sequence(F.lit(1), F.lit(q - 1)), lambda k: (F.lit(1) + _idiv((n - 1) * k, F.lit(q))).cast("long"))


def quantile_ranks_expr(n: Column, levels: list[float]) -> Column:
    """1-based ranks just below and above each interpolated quantile."""
    out = []
    for p in levels:
        h = (n - 1) * F.lit(float(p))
        out += [F.floor(h).cast("long") + 1, F.ceil(h).cast("long") + 1]
    return F.array(*out)


def _idiv(a: Column, b: Column) -> Column:
    return (a - F.pmod(a, b)) / b


class _Kind:
    """Sketch functions for a value type: long, or double without NaN and infinities."""

    def __init__(self, value_type: T.DataType):
        self.whole = isinstance(value_type, T.IntegralType)
        self.sql = "long" if self.whole else "double"
        kind = "bigint" if self.whole else "double"
        self._agg = getattr(F, f"kll_sketch_agg_{kind}")
        self._at = getattr(F, f"kll_sketch_get_quantile_{kind}")

    def finite(self, v: Column) -> Column:
        return F.lit(True) if self.whole else ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))

    def sketch(self, v: Column) -> list[Column]:
        """Sketch, smallest and largest of the finite values, and how many there are."""
        x = F.when(self.finite(v), v)
        return [self._agg(x, SKETCH_K).alias("sketch"), F.min(x).alias("least"), F.max(x).alias("most"), F.count(x).alias("m")]

    def bracket(self, margin: float) -> list[Column]:
        """``lo, hi`` around rank r of m sketched values (null for a rank outside them)."""
        # Spark takes literal ranks only: quantiles of a fixed grid, of which each rank picks two
        grid = self._at("sketch", F.array(*[F.lit(j / GRID) for j in range(GRID + 1)]))
        at = (F.col("r") - 0.5) / F.col("m")
        low, high = at - margin, at + margin
        inside = (F.col("r") >= 1) & (F.col("r") <= F.col("m"))
        lo = F.when(low <= 0, F.col("least")).otherwise(F.get(grid, F.floor(low * GRID).cast("int")))
        hi = F.when(high >= 1, F.col("most")).otherwise(F.get(grid, F.ceil(high * GRID).cast("int")))
        return [F.when(inside, lo).alias("lo"), F.when(inside, hi).alias("hi")]


def _width(margin: float) -> float:
    """The part of the rows that a bracket may hold."""
    return min(2 * margin + 2 / GRID, 1.0)


@dataclass
class _State:
    """A small table computed once: its rows on the driver, or (more than ``LOCAL_ROWS``) a table in the shared folder."""

    df: DataFrame
    n: int
    rows: list | None

    def most(self, value: Column, of_row: Callable) -> float:
        """The largest ``value``; the same from a row, where the rows are here."""
        if self.rows is not None:
            return max((of_row(r) for r in self.rows), default=0)
        return self.df.agg(F.max(value)).first()[0] or 0


def _kept(state: DataFrame) -> _State:
    spark = state.sparkSession
    rows = state.limit(LOCAL_ROWS + 1).collect()
    if len(rows) <= LOCAL_ROWS:
        return _State(spark.createDataFrame(rows, state.schema), len(rows), rows)
    path = f"{ensure_checkpoint_dir(spark)}/ranks-{uuid.uuid4().hex}"
    state.write.parquet(path)
    out = spark.read.schema(state.schema).parquet(path)
    return _State(out, out.count(), None)


def _inside(rows: DataFrame, state: DataFrame, on: list[str], few: bool) -> DataFrame:
    """The rows up to the upper end of each bracket of their group: ``KEYS, lo, v[, id]``.

    ``few``: the state is small, so that it goes to the rows and no row is shuffled.
    """
    wanted = state.groupBy(*[F.col(k).alias(f"_{k}") for k in on]).agg(
        F.collect_list(F.struct("k", "lo", "hi")).alias("wanted"))  # the ranks asked of one column and group
    wanted = F.broadcast(wanted) if few else wanted
    hit = rows.join(wanted, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in on])
    s = F.explode(F.filter("wanted", lambda w: F.col("v") <= w["hi"])).alias("s")
    hit = hit.select("g", "c", "v", *(["id"] if "id" in rows.columns else []), s)
    return hit.withColumns({"k": F.col("s.k"), "lo": F.col("s.lo")}).drop("s")


def _with_state(counted: DataFrame, state: DataFrame, few: bool) -> DataFrame:
    """``counted`` (KEYS and counts) with ``info`` and the rank ``asked`` for of each key.

    They come after the counts: an aggregate that carries only numbers hashes, one that carries a struct sorts all its rows.
    """
    asked = state.select(*[F.col(k).alias(f"_{k}") for k in KEYS], "info", F.col("r").alias("asked"))
    out = counted.join(F.broadcast(asked) if few else asked, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS])
    return out.drop(*[f"_{k}" for k in KEYS])


def _search(rows: DataFrame, state: DataFrame, on: list[str], kind: _Kind, margin: float = MARGIN) -> DataFrame:
    """``KEYS, info, r, m, v[, first_id, last_id]``: the value at rank r of the finite values, its number of rows m,
    and r among them.

    ``state``: KEYS, info (carried along), r, m (finite rows), least, most and a bracket lo, hi.
    """
    has_id = "id" in rows.columns
    kept = _kept(state)
    state, n, few = kept.df, kept.n, kept.rows is not None
    if not n:
        none = [F.lit(None).cast(rows.schema["id"].dataType).alias(c) for c in ("first_id", "last_id")] if has_id else []
        return state.select(*KEYS, "info", "r", "m", F.col("lo").alias("v"), *none)
    asked = state
    full = (F.col("lo") == F.col("least")) & (F.col("hi") == F.col("most"))
    size = kept.most(F.when(full, 1.0).otherwise(_width(margin)) * F.col("m"),
                     lambda r: (1.0 if r["lo"] == r["least"] and r["hi"] == r["most"] else _width(margin)) * r["m"])
    while size > BAND_ROWS and margin < 0.5:
        hit = _inside(rows, state, on, few)
        per = hit.groupBy(*KEYS).agg(
            F.count_if(F.col("v") < F.col("lo")).alias("below"), *kind.sketch(F.when(F.col("v") >= F.col("lo"), F.col("v"))))
        per = _with_state(per, state, few)
        per = per.withColumn("r", F.col("asked") - F.col("below")).where((F.col("r") >= 1) & (F.col("r") <= F.col("m")))
        state = _kept(per.select(*KEYS, "info", F.col("asked").alias("r"), *kind.bracket(margin))).df
        size *= _width(margin)
    hit = _inside(rows, state, on, few)
    ids = [F.min("id").alias("first_id"), F.max("id").alias("last_id")] if has_id else []
    band = hit.withColumn("v", F.when(F.col("v") >= F.col("lo"), F.col("v"))).groupBy(*KEYS, "v").agg(
        F.count(F.lit(1)).alias("m"), *ids)
    upto = F.sum("m").over(Window.partitionBy(*KEYS).orderBy(F.col("v").asc_nulls_first()))
    band = _with_state(band.withColumn("upto", upto), state, few).withColumnRenamed("asked", "r").where(
        F.col("v").isNotNull() & (F.col("upto") >= F.col("r")) & (F.col("upto") - F.col("m") < F.col("r")))
    names = ["first_id", "last_id"] if has_id else []
    done = _kept(band.select(*KEYS, "info", (F.col("r") - F.col("upto") + F.col("m")).alias("r"), "m", "v", *names))
    found = done.df
    if done.n == n:
        return found
    # ranks that their bracket missed: all values, then wider brackets
    seen = found.select(*[F.col(k).alias(f"_{k}") for k in KEYS])
    missed = asked.join(seen, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS], "left_anti")
    missed = missed.withColumns({"lo": F.col("least"), "hi": F.col("most")})
    return found.unionByName(_search(rows, missed, on, kind, 4 * margin))


def select_ranks(df: DataFrame, cols: list[str], ranks: Callable[[Column], Column], by: str | None = None,
                 id_col: str | None = None, id_where: Column | None = None) -> DataFrame:
    """``g, c, k, n, rank, r, m, value[, id]``: the row at the k-th wanted rank of column c in group g.

    Nulls are left out of a column's ranks.  Rows are ordered by (value, id);
    without ``id_col`` only the value is looked up.  ``r`` is the rank among the
    ``m`` rows of that value.  ``ranks`` gives the array of 1-based ranks from the
    row count; ranks outside 1..n are left out.  It may depend on the column's number ``c``, and so may
    ``id_where``: rows that do not meet it may get no id.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df, kind = _cast(df, cols)
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").alias("v")) for i, c in enumerate(cols)])
    keep = [(F.col(by) if by else F.lit(0)).alias("g")] + ([F.col(id_col).alias("id")] if id_col else [])
    rows = df.select(*keep, F.inline(pairs)).where(F.col("v").isNotNull())
    v = F.col("v")
    ends = {"low": F.lit(float("-inf")), "high": F.lit(float("inf")), "nan": F.lit(float("nan"))}
    outside = [(F.lit(0).cast("long") if kind.whole else F.count_if(v == x)).alias(name) for name, x in ends.items()]
    start = rows.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n"), *outside, *kind.sketch(v))
    start = start.select("*", F.posexplode(ranks(F.col("n"))).alias("k", "rank"))
    start = start.where((F.col("rank") >= 1) & (F.col("rank") <= F.col("n")))
    start = start.withColumn("r", F.col("rank") - F.col("low"))
    start = _kept(start.select(*KEYS, F.struct("n", "rank").alias("info"), "low", "high", "nan", "least", "most", "m", "r",
                                *kind.bracket(MARGIN))).df
    # ranks among the infinities and NaN are known already
    after = F.col("r") - F.col("m")
    special = start.where((F.col("r") < 1) | (after > 0)).select(
        *KEYS, "info",
        F.when(F.col("r") < 1, F.col("r") + F.col("low")).when(after <= F.col("high"), after).otherwise(after - F.col("high")).alias("r"),
        F.when(F.col("r") < 1, F.col("low")).when(after <= F.col("high"), F.col("high")).otherwise(F.col("nan")).alias("m"),
        F.when(F.col("r") < 1, ends["low"]).when(after <= F.col("high"), ends["high"]).otherwise(ends["nan"]).cast(kind.sql).alias("v"))
    inner = start.where((F.col("r") >= 1) & (after <= 0)).select(*KEYS, "info", "r", "m", "least", "most", "lo", "hi")
    numbers = rows if kind.whole else rows.where(kind.finite(v))
    found = _search(numbers, inner, ["g", "c"], kind)
    if not id_col:
        out = found.unionByName(special) if not kind.whole else found
        return out.select(*KEYS, "info.*", "r", "m", F.col("v").alias("value"))
    if not kind.whole:
        none = F.lit(None).cast(rows.schema["id"].dataType)
        found = found.unionByName(special.withColumns({"first_id": none, "last_id": none}))
    one = F.when(F.col("r") == 1, F.col("first_id")).when(F.col("r") == F.col("m"), F.col("last_id"))
    needed = F.lit(True) if id_where is None else id_where
    found = found.withColumn("open", one.isNull() & needed).withColumn("id", one)
    kept = _kept(found)
    found = kept.df.drop("open")
    if kept.most(F.col("open").cast("int"), lambda r: int(r["open"])):
        tied = kept.df.where("open").drop("open")
        found = kept.df.where("NOT open").drop("open").unionByName(_tied_ids(rows, tied, kept.rows is not None))
    return found.select(*KEYS, "info.*", "r", "m", F.col("v").alias("value"), "id")


def _tied_ids(rows: DataFrame, found: DataFrame, few: bool) -> DataFrame:
    """``found`` (a small table if ``few``) with the id of the r-th of the m rows that share the value v."""
    s = found.select(*[F.col(k).alias(f"_{k}") for k in KEYS], F.col("v").alias("_v"), F.col("r"), F.col("m"))
    mine = [F.col("g").eqNullSafe(F.col("_g")), F.col("c") == F.col("_c"), F.col("v") == F.col("_v")]
    tied = rows.join(F.broadcast(s) if few else s, mine).select("g", "c", F.col("_k").alias("k"), F.col("id").alias("v"), "r", "m")
    whole = isinstance(rows.schema["id"].dataType, T.IntegralType)
    if not whole or found.agg(F.max("m")).first()[0] <= min(TIED_ROWS, BAND_ROWS):
        at = F.row_number().over(Window.partitionBy(*KEYS).orderBy("v"))
        ids = tied.withColumn("at", at).where("at = r").select(*KEYS, F.col("v").alias("id"))
    else:
        kind = _Kind(T.LongType())
        key = F.struct("g", "c", "k").alias("g")
        tied = tied.select(key, F.lit(0).alias("c"), F.col("v").cast("long").alias("v"), "r")
        start = tied.groupBy("g", "c").agg(F.max("r").alias("r"), *kind.sketch(F.col("v")))
        start = start.select("g", "c", F.lit(0).alias("k"), F.struct(F.lit(0)).alias("info"), "r", "m", "least", "most", *kind.bracket(MARGIN))
        ids = _search(tied.select("g", "c", "v"), start, ["g", "c"], kind)
        ids = ids.select("g.*", F.col("v").cast(rows.schema["id"].dataType).alias("id"))
    ids = ids.select(*[F.col(k).alias(f"_{k}") for k in KEYS], F.col("id").alias("_id"))
    out = found.join(ids, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS])
    return out.withColumn("id", F.col("_id")).select(found.columns)


def _cast(df: DataFrame, cols: list[str]) -> tuple[DataFrame, _Kind]:
    """Whole numbers are ranked as longs, other and mixed columns as doubles (-0.0 as 0.0)."""
    kinds = {type(df.schema[c].dataType) for c in cols}
    if all(issubclass(k, T.IntegralType) for k in kinds):
        kind = _Kind(T.LongType())
        return df.withColumns({c: F.col(f"`{c}`").cast("long") for c in cols}), kind
    return df.withColumns({c: F.col(f"`{c}`").cast("double") + F.lit(0.0) for c in cols}), _Kind(T.DoubleType())
