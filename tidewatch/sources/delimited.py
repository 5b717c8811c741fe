"""CSV readers with declared types. For types found from the values see inference."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.missing import number
from ..functions.names import starting, with_clean_names
from ..operators.dedupe import union_by_name
from ..schemas import ddl

READERS = 16  # files whose first line is read at a time
QUOTED = {"quote": '"', "escape": '"', "multiLine": False}


def read_positional(spark: SparkSession, path: str | list[str], columns: dict[str, str], encoding: str = "UTF-8") -> DataFrame:
    """Fixed types by position; a header that does not fit the names is an error."""
    return spark.read.options(header=True, enforceSchema=False, encoding=encoding, **QUOTED).schema(ddl(columns)).csv(path)


def read_text(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """Every column as text, named by the cleaned header (one header line is read to plan this).

    All files must have the same header: one that differs is an error when it is read. For
    files whose headers differ see read_mixed.
    """
    options = {"header": True, "encoding": encoding, **QUOTED}
    names = spark.read.options(inferSchema=False, **options).csv(path).columns
    held = StructType([StructField(n, StringType()) for n in names])
    return with_clean_names(spark.read.options(enforceSchema=False, **options).schema(held).csv(path))


def headers(spark: SparkSession, paths: list[str], encoding: str = "UTF-8") -> dict[str, list[str]]:
    """Files by header line. Spark lists the files; of each only the first bytes are read, up to its first line's end."""
    files = sorted(spark.read.text(paths).inputFiles())
    with ThreadPoolExecutor(READERS) as pool:
        lines = list(pool.map(lambda file: _first_line(spark, file, encoding), files))
    found: dict[str, list[str]] = {}
    for file, line in zip(files, lines):
        if line is not None:
            found.setdefault(line.lstrip("\ufeff").rstrip("\r"), []).append(unquote(file))
    return found


def _first_line(spark: SparkSession, file: str, encoding: str) -> str | None:
    """The first line of a file, compressed or not; None when it is empty."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        raw = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(raw, encoding)).readLine()
    finally:
        stream.close()


def read_mixed(spark: SparkSession, paths: list[str], columns: dict[str, str], prefixes: tuple[str, ...] = (), encoding: str = "UTF-8", file: str | None = None) -> DataFrame:
    """Files whose headers differ in order or columns, as one table: one scan per header, put together by name.

    `file` names a column for the path of each row's file.
    """
    parts = []
    for files in headers(spark, paths, encoding).values():
        raw = read_text(spark, files, encoding)
        part = typed(raw, columns, prefixes)
        parts.append(part.withColumn(file, F.col("_metadata.file_path")) if file else part)
    if not parts:
        raise ValueError(f"no file holds a header: {paths}")
    return union_by_name(parts)


def typed(df: DataFrame, columns: dict[str, str], prefixes: tuple[str, ...] = (), prefix_type: str = "double") -> DataFrame:
    """Text columns cast to their declared types; bad text and absent columns are missing.

    Every column that starts with one of `prefixes` is kept too.
    """
    present = set(df.columns)
    out: list[Column] = [
        (number(c, t) if c in present else F.lit(None).cast(t)).alias(c) for c, t in columns.items()
    ]
    extra = [c for c in starting(df, *prefixes) if c not in columns] if prefixes else []
    return df.select(*out, *[F.col(c).try_cast(prefix_type).alias(c) for c in extra])


def read_feed(
    spark: SparkSession, path: str | list[str], columns: dict[str, str], prefixes: tuple[str, ...] = (), encoding: str = "UTF-8"
) -> DataFrame:
    """A dirty feed: read as text by header name, then cast."""
    return typed(read_text(spark, path, encoding), columns, prefixes)


def read_banner(
    spark: SparkSession, path: str, columns: dict[str, str], banner: dict[str, list[str]], encoding: str = "UTF-8"
) -> DataFrame:
    """File whose first lines are a banner and a header.

    The names are declared. `banner` lists, for a column, the texts that only
    occur on banner or header lines; such lines are dropped wherever they are,
    so the file stays splittable.
    """
    raw = spark.read.options(header=False, encoding=encoding, **QUOTED).schema(ddl({c: "string" for c in columns})).csv(path)
    for column, texts in banner.items():
        raw = raw.where(F.col(column).isNull() | ~F.col(column).isin(*texts))
    return typed(raw, columns)
