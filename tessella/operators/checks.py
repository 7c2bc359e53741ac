"""Contracts on columns and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def with_column_if_absent(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, value)


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` itself; an error where a key occurs twice."""
    if not df.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"keys are not unique: {', '.join(keys)}")
    return df


def require_rows(df: DataFrame, n: int = 1) -> DataFrame:
    if df.limit(n).count() < n:
        raise ValueError(f"fewer than {n} rows remain")
    return df


def exactly(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of an ordered table; an error where there are fewer."""
    return require_rows(df.limit(n), n)


def join_one_to_one(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """An inner join on keys that may occur once on either side, without the columns of ``b`` that ``a`` has too."""
    require_unique(a, *keys)
    require_unique(b, *keys)
    return a.join(b.select(*keys, *[c for c in b.columns if c not in a.columns]), list(keys))


def join_many_to_one(a: DataFrame, b: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """A join on keys that may occur once in ``b``, without the columns of ``b`` that ``a`` has too."""
    require_unique(b, *keys)
    return a.join(b.select(*keys, *[c for c in b.columns if c not in a.columns]), list(keys), how)


def gather(rows: DataFrame, matrix: DataFrame, index: str) -> DataFrame:
    """``rows`` with the row of ``matrix`` that their ``index`` names; an error where one names none, or two rows share an index."""
    outside = rows.select(index).join(matrix.select(index), index, "left_anti").limit(5).collect()
    if outside:
        raise IndexError(f"no rows for {index}: {', '.join(str(r[index]) for r in outside)}")
    return join_many_to_one(rows, matrix, index)


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Names that begin with ``prefix``, in the order of the table; an error where there is none."""
    found = [c for c in df.columns if c.startswith(prefix)]
    if not found:
        raise ValueError(f"no column begins with {prefix}")
    return found


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def profile(df: DataFrame, *keys: str) -> DataFrame:
    """One row: rows, columns, and distinct values and duplicates of each key, in one pass."""
    parts = [F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")]
    parts += [F.countDistinct(k).alias(f"distinct_{k}") for k in keys]
    return df.agg(*parts).select("*", *[(F.col("n_rows") - F.col(f"distinct_{k}")).alias(f"repeats_{k}") for k in keys])
