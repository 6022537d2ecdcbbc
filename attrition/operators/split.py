"""Deterministic splits and folds.

Membership is a function of (seed, customer_id) only, through ``md5``, so it
does not depend on partitioning, task order or retries (unlike
``randomSplit``), and a lost executor recomputes the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attrition.operators.rfm import choose_method
from attrition.operators.selection import select_ranks
from attrition.schema import ID, LABEL

SEED = 42


def hash_key(seed: int = SEED, id_col: str = ID) -> Column:
    """First 8 hex digits of md5('<seed>-<id>'), a uniform 32-bit key as text."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string"))), 1, 8)


def threshold_hex(frac: float) -> str:
    return format(int(frac * 2**32), "08x")


def split_hash(df: DataFrame, frac: float = 0.2, seed: int = SEED, id_col: str = ID) -> DataFrame:
    """Unstratified split: test iff the hash key < frac * 2^32.  Row-local, no shuffle."""
    is_test = hash_key(seed, id_col) < F.lit(threshold_hex(frac))
    return df.withColumn("split", F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def hash_number(seed: int = SEED, id_col: str = ID) -> Column:
    """The hash key as a number 0 .. 2^32 - 1."""
    return F.conv(hash_key(seed, id_col), 16, 10).cast("long")


def _ranked(df: DataFrame, label: str, ranks, seed: int, id_col: str, method: str) -> tuple[DataFrame, Column]:
    """``df`` with helper columns, and the array of: is the row past the label's k-th wanted rank
    of the order (hash key, id)?

    ``window`` ranks all rows (one partition for each label: small inputs);
    ``cuts`` selects the rows at the wanted ranks of all labels at once and
    joins them back, one row for each label.  Both give the same answer.
    """
    keyed = df.withColumn("_h", hash_number(seed, id_col))
    if method == "window":
        n = F.count(F.lit(1)).over(Window.partitionBy(label))
        rn = F.row_number().over(Window.partitionBy(label).orderBy("_h", id_col))
        keyed = keyed.withColumn("_n", n).withColumn("_rn", rn)
        return keyed, F.transform(ranks(F.col("_n")), lambda r: F.col("_rn") > r)
    if method != "cuts":
        raise ValueError(method)
    cuts = select_ranks(keyed, ["_h"], ranks, by=label, id_col=id_col)
    # ranks of 0 are not found: every row is past them
    per = cuts.groupBy(F.col("g").alias("_g")).agg(F.map_from_entries(F.collect_list(F.struct("k", F.struct("value", "id")))).alias("_cuts"))
    keyed = keyed.join(per, F.col(label).eqNullSafe(F.col("_g")), "left")
    row = F.struct(F.col("_h").alias("value"), F.col(id_col).alias("id"))
    places = F.sequence(F.lit(0), F.size(ranks(F.lit(0).cast("long"))) - 1)
    return keyed, F.transform(places, lambda k: F.coalesce(row > F.element_at("_cuts", k), F.lit(True)))


_HELPERS = ("_h", "_n", "_rn", "_g", "_cuts")


def split_stratified(
    df: DataFrame, label: str = LABEL, frac: float = 0.2, seed: int = SEED, id_col: str = ID, method: str = "auto"
) -> DataFrame:
    """Stratified split: per label (null is one), the round(frac * n_label) rows
    with the smallest (hash key, id) go to test."""
    keyed, past = _ranked(df, label, lambda n: F.array(F.floor(F.lit(frac) * n + F.lit(0.5)).cast("long")), seed, id_col,
                          choose_method(df, method))
    return keyed.withColumn("split", F.when(F.get(past, 0), "train").otherwise("test")).drop(*_HELPERS)


def add_fold(df: DataFrame, k: int = 5, seed: int = SEED, label: str | None = None, id_col: str = ID,
             method: str = "auto") -> DataFrame:
    """Fold number 0..k-1.

    Without a label: the 32-bit hash key mod k, row-local.  With a label, the
    same at every size: the label's rows in order of (hash key, id) are cut at
    the ranks ``j * n div k``, so every fold gets the same share of each label (+-1).
    """
    if label is None:
        return df.withColumn("fold", F.pmod(hash_number(seed, id_col), F.lit(k)).cast("long"))

    def ends(n: Column) -> Column:
        return F.array(*[((n * j - F.pmod(n * j, F.lit(k))) / k).cast("long") for j in range(1, k)])

    keyed, past = _ranked(df, label, ends, seed, id_col, choose_method(df, method))
    fold = F.size(F.filter(past, lambda x: x)) if k > 1 else F.lit(0)
    return keyed.withColumn("fold", fold.cast("long")).drop(*_HELPERS)
