"""Readers and schema checks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRANSACTION_COLUMNS = ("atm_id", "date", "dispense")


def require_columns(df: DataFrame, required: Iterable[str], table: str) -> None:
    """Fail with the table name and the missing set; a schema check, no job."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{table} is missing required columns: {missing}")


def union_parts(parts: Sequence[DataFrame], part_col: str | None = None) -> DataFrame:
    """Stack parts aligned by column name; absent columns become NULL, duplicates stay.

    Parts that disagree on a column's type are stacked as STRING for that column, the
    way a spreadsheet read keeps mixed columns as text; coercion happens later.
    """
    if not parts:
        raise ValueError("no parts to union")
    types: dict[str, set[str]] = {}
    for p in parts:
        for f in p.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    mixed = {c for c, ts in types.items() if len(ts) > 1}
    aligned = []
    for i, p in enumerate(parts):
        cols = [F.col(c).cast("string").alias(c) if c in mixed else F.col(c) for c in p.columns]
        if part_col:
            cols.append(F.lit(i + 1).alias(part_col))
        aligned.append(p.select(*cols))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def read_parts(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet",
               part_col: str | None = "part", **options) -> DataFrame:
    """S1 over files: every path is one part (one sheet of the original workbook), a file or a folder.

    CSV files with a header are grouped by it and every group is one scan; Parquet files are one scan over
    their merged columns, unless parts disagree on a type. So the plan grows with the number of
    headers, not of parts; the part number comes from each row's file.
    """
    if not paths:
        raise ValueError("no parts to union")
    if fmt == "csv" and str(options.get("header", "")).lower() == "true":
        return _csv_parts(spark, paths, part_col, options)
    if fmt == "parquet":
        try:
            scan = spark.read.options(**options).option("mergeSchema", "true").parquet(*dict.fromkeys(paths))
        except (AnalysisException, Py4JJavaError) as e:  # Spark's general exception comes as it is in Java
            if not _is_merge_failure(e):
                raise
        else:
            return _numbered(scan, _part_files(spark, paths, ".parquet"), part_col)
    return union_parts([spark.read.format(fmt).options(**options).load(p) for p in paths], part_col)


def _is_merge_failure(e: AnalysisException | Py4JJavaError) -> bool:
    if isinstance(e, AnalysisException):
        return "MERGE" in (e.getCondition() or "")
    return re.match(r"\[\w*MERGE", e.java_exception.getMessage() or "") is not None


def _part_files(spark: SparkSession, paths: Sequence[str], suffix: str = "") -> list[tuple[str, int]]:
    """(file, part number) of all parts; a path given twice is two parts. Hidden files are left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def files(number: int, path: str) -> list[tuple[str, int]]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs, out = p.getFileSystem(conf), []
        if fs.getFileStatus(p).isFile():
            return [(fs.getFileStatus(p).getPath().toString(), number)]
        found = fs.listFiles(p, True)
        while found.hasNext():
            f = found.next().getPath()
            if not f.getName().startswith(("_", ".")):
                out.append((f.toString(), number))
        return out

    with ThreadPoolExecutor(16) as pool:
        return [x for xs in pool.map(files, range(1, len(paths) + 1), paths) for x in xs]


def _numbered(scan: DataFrame, files: list[tuple[str, int]], part_col: str | None) -> DataFrame:
    """The rows of a scan with the number of their part, by a table of files (names, as many as there are files);
    a file that belongs to two parts gives its rows twice."""
    spark = scan.sparkSession
    repeated = len({f for f, _ in files}) < len(files)
    if not part_col and not repeated:
        return scan
    columns = scan.columns
    table = F.broadcast(spark.createDataFrame([(_plain(f), n) for f, n in files], "_file string, _part int"))
    name = F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    out = scan.withColumn("_file", name).join(table, "_file")
    return out.select(*columns, *([F.col("_part").alias(part_col)] if part_col else []))


def _plain(path: str) -> str:
    return "file:/" + path[5:].lstrip("/") if path.startswith("file:") else path


def _csv_parts(spark: SparkSession, paths: Sequence[str], part_col: str | None, options: dict) -> DataFrame:
    """One scan for all files of equal header lines. The first line of each file is read from the driver,
    some at a time; nothing else of the files is."""
    files = _part_files(spark, paths)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def header(file: str) -> str | None:
        p = jvm.org.apache.hadoop.fs.Path(file)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(p.getFileSystem(conf).open(p), options.get("encoding", "UTF-8")))
        try:
            return reader.readLine()
        finally:
            reader.close()

    names = list(dict.fromkeys(f for f, _ in files))
    with ThreadPoolExecutor(16) as pool:
        groups: dict[str, list[str]] = {}
        for f, line in zip(names, pool.map(header, names)):
            groups.setdefault(line or "", []).append(f)
    if not groups:
        raise ValueError("no files in the parts")
    scans = []
    for line, same in groups.items():
        if not line and len(groups) > 1:
            continue  # empty files
        reader = spark.read.options(**options)
        schema = reader.csv(same if str(options.get("inferSchema", "")).lower() == "true" else same[0]).schema
        own = set(same)
        scan = spark.read.options(**options).schema(schema).csv(same)
        scans.append(_numbered(scan, [x for x in files if x[0] in own], part_col))
    return union_parts(scans)


def ingest_counts(df: DataFrame, part_col: str = "part") -> DataFrame:
    """Number of parts and total rows, in one aggregation."""
    return df.agg(F.countDistinct(part_col).alias("n_parts"), F.count(F.lit(1)).alias("n_rows"))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None, **options) -> DataFrame:
    """One table; text formats take an explicit schema."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_transactions(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    df = read_table(spark, path, fmt, **options)
    require_columns(df, TRANSACTION_COLUMNS, "transactions")
    return df
