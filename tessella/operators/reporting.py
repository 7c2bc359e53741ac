"""Comparison tables, wins, skip reasons and Markdown."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import numeric
from tessella.operators.quantiles import number_rows


def compare(tables: dict[str, DataFrame], key: str, columns: list[str]) -> DataFrame:
    """Metric tables side by side, each column prefixed by its configuration; tasks in all of them."""
    out = None
    for name, df in tables.items():
        part = df.select(key, *[F.col(c).alias(f"{name}_{c}") for c in columns])
        out = part if out is None else out.join(part, key)
    return out


def tagged_union(parts: dict[str, DataFrame], tag: str, schema: str | None = None) -> DataFrame:
    """The parts one below the other with their names in ``tag``; columns that a part lacks are null.

    Without any part, an empty table of ``schema`` and the tag; an error if there is no schema either.
    """
    if not parts:
        if schema is None:
            raise ValueError("without parts a schema is needed")
        from pyspark.sql import SparkSession

        return SparkSession.active().createDataFrame([], schema).withColumn(tag, F.lit(None).cast("string"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(tag, F.lit(name)) for name, df in parts.items()])


def with_winner(df: DataFrame, names: list[str], column: str, out: str, largest: bool = True) -> DataFrame:
    return df.withColumn(out, numeric.best_of(names, [F.col(f"{n}_{column}") for n in names], largest))


def win_counts(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Wins of each configuration in one row."""
    return df.agg(*[F.count_if(F.col(column) == n).alias(f"{n}_wins") for n in names], F.count(F.lit(1)).alias("n_tasks"))


def gains(df: DataFrame, new: str, old: str, column: str, k: int, key: str) -> DataFrame:
    """The ``k`` tasks that gain most."""
    return df.withColumn("gain", F.col(f"{new}_{column}") - F.col(f"{old}_{column}")).orderBy(F.desc_nulls_last("gain"), key).limit(k)


def best_configuration(df: DataFrame, name: str, metric: str, preferred: str) -> DataFrame:
    """One row: the preferred configuration where there is one, else that of the largest metric (null is least, then the first name)."""
    return df.orderBy((F.col(name) == preferred).desc(), F.desc_nulls_last(metric), name).limit(1)


def skip_reason(df: DataFrame, least: dict[str, int]) -> DataFrame:
    """The first part that has too few values, and whether the task runs; ``least`` maps columns to minima in order."""
    reason = F.lit("")
    for column, n in reversed(list(least.items())):
        reason = F.when(F.col(column) < n, f"insufficient_{column}").otherwise(reason)
    return df.withColumn("skip_reason", reason).withColumn("status", F.when(F.col("skip_reason") == "", "ok").otherwise("skipped"))


def markdown_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """One line of a Markdown table per row: floats with four places, ``NA`` for null."""
    cells = [F.coalesce(F.when(F.col(c).isNotNull(), F.format_string("%.4f", F.col(c))) if t in ("double", "float") else F.col(c).cast("string"), F.lit("NA")) for c, t in df.dtypes]
    return df.orderBy(*order).select(*order, F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def ordered(df: DataFrame, *by: str) -> DataFrame:
    """``df`` in mixed directions with its ``place`` from 1: ``-name`` is descending; null and NaN come last either way.

    Places are taken by ranges, so the table may be of any size.
    """
    keys, shown = [], df
    for i, c in enumerate(by):
        name = c.removeprefix("-")
        value = F.when(~F.isnan(name), F.col(name)) if dict(df.dtypes)[name] in ("double", "float") else F.col(name)
        shown = shown.withColumns({f"_m{i}": value.isNull(), f"_v{i}": value})
        keys += [F.col(f"_m{i}").asc(), F.desc(f"_v{i}") if c.startswith("-") else F.asc(f"_v{i}")]
    rows, _ = number_rows(shown, keys)
    return rows.select(*df.columns, (F.col("row") + 1).alias("place"))


def write_summary(manifest: DataFrame) -> DataFrame:
    """One row of a run's writes: rows asked for, written, skipped, failed, studies, and bytes in all.

    ``manifest`` has ``study_id, write_ok, status, output_size_bytes``; a null
    ``write_ok`` is a failure.
    """
    ok = F.coalesce(F.col("write_ok"), F.lit(False))
    return manifest.agg(
        F.count(F.lit(1)).alias("requested_rows"), F.count_if(ok & (F.col("status") == "written")).alias("successful_writes"), F.count_if(ok & (F.col("status") == "skipped_existing")).alias("skipped_existing"),
        F.count_if(ok).alias("successful_total"), F.count_if(~ok).alias("failed_writes"), F.countDistinct(F.when(ok, F.col("study_id"))).alias("n_studies"),
        F.coalesce(F.sum(F.when(ok, F.col("output_size_bytes"))), F.lit(0)).alias("total_output_size_bytes"),
    )


def to_markdown(df: DataFrame, order: list[str], limit: int = 200) -> str:
    """A whole small table, for reports; one of more than ``limit`` rows is an error."""
    rows = markdown_rows(df, order).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"the table has more than {limit} rows")
    if not rows:
        return "No rows"
    return "\n".join(["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns), *[r["line"] for r in rows]])


def histogram(df: DataFrame, column: str, bins: int = 16) -> DataFrame:
    """Counts of ``bins`` equal bins between the extremes."""
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))  # one row
    b = F.least(F.floor((F.col(column) - F.col("lo")) / F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / bins).otherwise(1.0)), F.lit(bins - 1))
    return df.filter(F.col(column).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def summary_json(df: DataFrame) -> DataFrame:
    """One JSON text for each row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))
