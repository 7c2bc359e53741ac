"""Readers and writers of tables, texts, checksums and folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessella.operators.checks import trim_names


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def first_existing(spark: SparkSession, paths: list[str]) -> str:
    for p in paths:
        if exists(spark, p):
            return p
    raise FileNotFoundError(", ".join(paths))


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV file (also gzipped) with a header, under a given schema; names are trimmed."""
    return trim_names(spark.read.schema(schema).option("header", True).csv(path))


def read_json_document(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A JSON document; no rows where the file is missing."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("line")).filter("line <> ''")


def parse_checksums(lines: DataFrame) -> DataFrame:
    """``path, sha256`` of lines ``<digest>  ./path``; blank lines are left out."""
    parts = F.split(F.trim("line"), r"\s+")
    return lines.filter(F.size(parts) >= 2).select(F.regexp_replace(F.element_at(parts, -1), "^[./]+", "").alias("path"), F.lower(parts[0]).alias("sha256"))


def list_files(spark: SparkSession, root: str, pattern: str = "*.dcm") -> DataFrame:
    """``path, length`` of the files below ``root``; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root).select("path", "length")


def file_digests(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root).select("path", F.sha2("content", 256).alias("sha256"))


def read_arrays(spark: SparkSession, root: str, name: str = "embeddings") -> DataFrame:
    """``path, row, embedding`` of the two-dimensional array ``name`` in NPZ files."""
    import io

    import numpy as np
    import pandas as pd

    def run(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                a = np.load(io.BytesIO(content), allow_pickle=False)[name]
                if a.ndim != 2:
                    raise ValueError(f"{path}: {name} has {a.ndim} dimensions")
                yield pd.DataFrame({"path": path, "row": np.arange(len(a)), "embedding": list(a.astype(np.float32))})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").option("recursiveFileLookup", True).load(root)
    return files.select("path", "content").mapInPandas(run, "path string, row long, embedding array<float>")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, also for no rows; for the edges of a pipeline."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_csv(df: DataFrame, path: str, max_rows: int | None = None) -> tuple[int, bool]:
    """Write a result as CSV, its first ``max_rows`` rows if given; the rows written, and whether there were more.

    Without an order in ``df`` any rows may be the first; nothing is cut in silence.
    """
    write_csv(df if max_rows is None else df.limit(max_rows), path)
    n = df.sparkSession.read.option("header", True).csv(path).count()
    return n, max_rows is not None and n == max_rows and df.limit(max_rows + 1).count() > max_rows


def append_log(spark: SparkSession, path: str, step: str, status: str, detail: str) -> None:
    """Add a line ``at, step, status, detail`` to a log of steps; a line is a file, so runs may write at once."""
    row = spark.createDataFrame([(step, status, detail)], "step string, status string, detail string")
    out = row.select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("at"), *[F.coalesce(log_text(F.col(c)), F.lit("")).alias(c) for c in row.columns])
    out.coalesce(1).write.mode("append").option("header", True).csv(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).filter("value IS NOT NULL").write.mode("overwrite").text(path)


def log_text(c):
    """A log detail on one line without commas."""
    return F.translate(F.regexp_replace(c, r"[\r\n]+", " "), ",", ";")


def missing_artifacts(spark: SparkSession, paths: list[str], strict: bool = False) -> list[str]:
    """The required files that are not there; an error when ``strict``."""
    missing = [p for p in paths if not exists(spark, p)]
    if missing and strict:
        raise FileNotFoundError(", ".join(missing))
    return missing


def snapshot(spark: SparkSession, files: list[str], target: str) -> DataFrame:
    """Copy small report files to a folder, all or none; ``source, target, length`` of each."""
    missing_artifacts(spark, files, strict=True)
    hadoop, conf, rows = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration(), []
    for f in files:
        source, to = hadoop.Path(f), hadoop.Path(f"{target}/{f.rsplit('/', 1)[-1]}")
        hadoop.FileUtil.copy(source.getFileSystem(conf), source, to.getFileSystem(conf), to, False, conf)
        rows.append((f, to.toString(), to.getFileSystem(conf).getFileStatus(to).getLen()))
    return spark.createDataFrame(rows, "source string, target string, length long")
