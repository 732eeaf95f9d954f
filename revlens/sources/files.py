"""File scans and sinks.

Scans take declared schemas so no inference pass runs over the data;
sinks are distributed (one file per task); with ``single_file`` the parts
are joined afterwards."""

from __future__ import annotations

import re

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revlens import schemas
from revlens.session import materialize

CSV_OPTS = {"header": "true", "escape": '"', "quote": '"'}


def read_json(spark: SparkSession, path: str, schema: StructType | None = schemas.REVIEWS_RAW) -> DataFrame:
    """S1 (declared schema, permissive: bad lines become null rows) or S2
    (``schema=None``: inferred, one extra pass)."""
    r = spark.read.option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_json_inferred(spark: SparkSession, path: str) -> DataFrame:
    """S2 with the text read and parsed once: lines become VARIANT values,
    written; their common schema is one aggregate over them, and the columns
    are typed extractions.  A line that does not parse is a row of nulls.
    Numbers with decimals are doubles, as inference by ``read.json`` has it."""
    parsed = materialize(spark.read.text(path).select(F.try_parse_json("value").alias("v")))
    kind = parsed.agg(F.schema_of_variant_agg("v")).head()[0]
    if not kind or not kind.startswith("OBJECT<"):
        return parsed.select()
    # whole numbers are BIGINT; a decimal without places is "1.0", or beyond a long
    ddl = re.sub(r"DECIMAL\((\d+),\s*(\d+)\)", lambda m: m[0] if m[2] == "0" and int(m[1]) > 18 else "DOUBLE",
                 kind.replace("OBJECT<", "STRUCT<"))
    ddl = re.sub(r"\bVOID\b", "STRING", ddl)
    return parsed.select(F.try_variant_get("v", "$", ddl).alias("r")).select("r.*")


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True, multi_line: bool = False) -> DataFrame:
    """S3: CSV with header.  ``multi_line`` is needed where quoted fields hold
    line ends; such a file cannot be split, so it is one task."""
    opts = dict(CSV_OPTS, header=str(header).lower(), multiLine=str(multi_line).lower())
    return spark.read.schema(schema).options(**opts).csv(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def _writer(df: DataFrame):
    return df.write.mode("overwrite")


def write_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    """S5 (S8 with ``single_file``)."""
    _writer(df).json(path)
    if single_file:
        join_parts(df.sparkSession, path)


def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False) -> None:
    """CSV, overwrite mode; values are written as is (no whitespace
    trimming) and quotes are doubled so ``read_csv`` restores them."""
    def write(rows: DataFrame, to: str, with_header: bool) -> None:
        (_writer(rows).options(**dict(CSV_OPTS, header=str(with_header).lower()))
            .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
            .csv(to))

    if not (single_file and header):
        write(df, path, header)
    else:
        # the header once, as the writer itself quotes it: a row of names
        names = df.sparkSession.range(1).select(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(df.columns)])
        write(df, path, False)
        write(names.coalesce(1), f"{path.rstrip('/')}/{HEADER}", False)
    if single_file:
        join_parts(df.sparkSession, path)


def write_text(df: DataFrame, path: str, single_file: bool = False) -> None:
    """One line out per row of the single string column."""
    _writer(df).text(path)
    if single_file:
        join_parts(df.sparkSession, path)


HEADER = "_header"


def join_parts(spark: SparkSession, path: str) -> None:
    """The part files of a folder, written in parallel, become one, in
    their order (a header's first).

    No task sees all rows.  A file system that can (HDFS) moves the blocks
    together itself; on any other the bytes are appended as a stream, a buffer
    at a time, and a part goes once it is in."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path_of = jvm.org.apache.hadoop.fs.Path
    folder = path_of(path)
    fs = folder.getFileSystem(conf)

    def parts_of(where) -> list:
        found = [s.getPath() for s in fs.listStatus(where) if s.getPath().getName().startswith("part-") and s.getLen() > 0]
        return sorted(found, key=lambda p: p.getName())

    header = path_of(folder, HEADER)
    parts = (parts_of(header) if fs.exists(header) else []) + parts_of(folder)
    keep = {p.toString() for p in parts}
    for s in fs.listStatus(folder):  # empty parts
        if s.getPath().getName().startswith("part-") and s.getPath().toString() not in keep:
            fs.delete(s.getPath(), False)
    suffix = "".join(f".{x}" for x in (parts[0].getName().split(".")[1:] if parts else ["txt"]))
    joined = path_of(folder, f"_joining{suffix}")
    out = fs.create(joined, True)
    try:
        rest = parts
        if parts:
            first = fs.open(parts[0])
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(first, out, conf, False)
            first.close()
            rest = parts[1:]
        out.close()
        _append(spark, fs, joined, rest, conf)
    finally:
        out.close()
    for p in parts:
        fs.delete(p, False)
    if fs.exists(header):
        fs.delete(header, True)
    fs.rename(joined, path_of(folder, f"part-00000{suffix}"))


def _append(spark: SparkSession, fs, target, parts: list, conf) -> None:
    if not parts:
        return
    jvm = spark._jvm
    try:
        array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
        for i, p in enumerate(parts):
            array[i] = p
        fs.concat(target, array)
        return
    except UnsupportedOperationException:
        pass
    whole = target.suffix(".whole")
    out = fs.create(whole, True)
    for p in [target, *parts]:
        piece = fs.open(p)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(piece, out, conf, False)
        piece.close()
    out.close()
    fs.delete(target, False)
    fs.rename(whole, target)


def values_table(spark: SparkSession, rows: list, columns: list[str]) -> DataFrame:
    """A small in-code dictionary as an inline VALUES relation: the
    optimizer knows its size, so joins against it broadcast on their own."""
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        if isinstance(v, float):
            return f"CAST({v!r} AS DOUBLE)"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in (r if isinstance(r, tuple) else (r,))) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")
