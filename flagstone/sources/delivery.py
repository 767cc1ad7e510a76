"""Reading a delivery: every delimited file of a folder becomes one table.

Listing uses the Hadoop FileSystem of the path (HDFS, S3A, local — whatever
URI scheme the cluster supports), so only file *names* reach the driver; the
data is read by one parallel CSV scan per file. Pass ``schemas`` to skip the
pass over the files that finding types costs (:mod:`.types`).
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import ident, sql_str
from .types import column_facts, in_schema, misfits, typed

# Delivery layout.
DELIVERY_GLOB = "*txt"
DELIVERY_SEP = "|"
DELIVERY_ENCODING = "ISO-8859-1"


# Cells that a delivery reader takes for missing.
NA_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
    "None", "n/a", "nan", "null",
)


def delivery_paths(project: str | None, folder: str, refresh_dt: str) -> tuple[str, str]:
    """``(input, output)`` folders: ``{project}/input/{folder}_{date}/`` and
    ``{project}/raw_qc/{folder}_{date}/`` with ``-`` and ``/`` removed from
    the refresh date; without a project the older ``{folder}_{date}/input/``
    and ``{folder}_{date}/output/``."""
    stamp = re.sub(r"[-/]", "", refresh_dt)
    if not project:
        return (f"{folder}_{stamp}/input/", f"{folder}_{stamp}/output/")
    return (f"{project}/input/{folder}_{stamp}/", f"{project}/raw_qc/{folder}_{stamp}/")


def table_name(path: str) -> str:
    """Table name of a file: its base name up to the first dot."""
    base = path.rstrip("/").rsplit("/", 1)[-1]
    return base.split(".", 1)[0]


def list_files(spark: SparkSession, folder: str, pattern: str = DELIVERY_GLOB) -> list[str]:
    """Paths matching ``pattern`` in ``folder`` (sorted). A matching
    sub-folder counts as one table too (that is how Spark writes a file)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    glob = jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/" + pattern)
    fs = glob.getFileSystem(conf)
    found = fs.globStatus(glob) or []
    return sorted(str(st.getPath().toString()) for st in found)


def read_text(
    spark: SparkSession,
    path: str,
    sep: str = DELIVERY_SEP,
    header: bool = True,
    schema: StructType | None = None,
    encoding: str | None = None,
    na_values: Sequence[str] = (),
    multi_line: bool = False,
) -> DataFrame:
    """One delimited file (or folder / glob) with all cells as text.

    A quote inside a quoted cell is doubled; white space is kept. Cells equal
    to one of ``na_values`` are null. ``schema`` only gives the column names."""
    r = spark.read.option("header", header).option("sep", sep).option("escape", '"').option("multiLine", multi_line)
    r = r.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if encoding:
        r = r.option("encoding", encoding)
    if schema is not None:
        r = r.schema(StructType([StructField(f.name, StringType()) for f in schema.fields]))
    text = r.csv(path)
    if not na_values:
        return text
    absent = ", ".join(sql_str(v) for v in na_values)
    return text.selectExpr(*[f"CASE WHEN {ident(c)} NOT IN ({absent}) THEN {ident(c)} END AS {ident(c)}" for c in text.columns])


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = DELIVERY_SEP,
    header: bool = True,
    schema: StructType | None = None,
    encoding: str | None = None,
    infer_schema: bool = True,
    na_values: Sequence[str] = (),
    multi_line: bool = False,
    on_misfit: str = "fail",
) -> DataFrame:
    """One delimited file (or folder / glob) as a DataFrame, see :func:`read_text`.

    Without a schema, types are found by a pass over the file in which no cell
    is lost (:mod:`.types`); with one, a cell that its type cannot hold is an
    error, or null with ``on_misfit="null"``. ``multi_line`` allows line breaks inside quoted
    cells; a file is then read by one task, so leave it off otherwise."""
    text = read_text(spark, path, sep, header, schema, encoding, na_values, multi_line)
    if schema is not None:
        return in_schema(text, schema, table_name(path), on_misfit)
    if not infer_schema:
        return text
    return typed(text, [f.type() for f in column_facts({"": text})[""]])


def delivery_files(spark: SparkSession, folder: str, pattern: str = DELIVERY_GLOB) -> dict[str, str]:
    """``{table name: path}`` of a delivery. An empty delivery and two files with
    one table name are errors."""
    paths: dict[str, str] = {}
    for path in list_files(spark, folder, pattern):
        name = table_name(path)
        if name in paths:
            raise ValueError(f"two files for table {name!r}: {paths[name]} and {path}")
        paths[name] = path
    if not paths:
        raise FileNotFoundError(f"no files {pattern} in {folder}")
    return paths


def _delivery_texts(spark, paths, sep, encoding, schemas, na_values, multi_line) -> dict[str, DataFrame]:
    """``{table name: text columns}``; the header lines are read side by side."""

    def read(name: str) -> DataFrame:
        return read_text(spark, paths[name], sep, True, (schemas or {}).get(name), encoding, na_values, multi_line)

    with ThreadPoolExecutor(max_workers=8) as pool:
        return dict(zip(paths, pool.map(read, paths), strict=True))


def read_delivery(
    spark: SparkSession,
    folder: str,
    pattern: str = DELIVERY_GLOB,
    sep: str = DELIVERY_SEP,
    encoding: str | None = DELIVERY_ENCODING,
    schemas: Mapping[str, StructType] | None = None,
    infer_schema: bool = True,
    na_values: Sequence[str] = NA_MARKERS,
    multi_line: bool = False,
    on_misfit: str = "fail",
    skip: Collection[str] = (),
) -> dict[str, DataFrame]:
    """``{table name: DataFrame}`` for every matching file of ``folder`` whose table is not in ``skip``.

    The types of all tables without a schema come from one job over the
    delivery. An empty delivery and two files with one table name are errors."""
    paths = {n: p for n, p in delivery_files(spark, folder, pattern).items() if n not in skip}
    texts = _delivery_texts(spark, paths, sep, encoding, schemas, na_values, multi_line)
    known = schemas or {}
    facts = column_facts({n: df for n, df in texts.items() if n not in known}) if infer_schema else {}
    out = {}
    for name, text in texts.items():
        if name in known:
            out[name] = in_schema(text, known[name], name, on_misfit)
        else:
            out[name] = typed(text, [f.type() for f in facts[name]]) if infer_schema else text
    return out


def delivery_misfits(
    spark: SparkSession,
    folder: str,
    schemas: Mapping[str, StructType],
    pattern: str = DELIVERY_GLOB,
    sep: str = DELIVERY_SEP,
    encoding: str | None = DELIVERY_ENCODING,
    na_values: Sequence[str] = NA_MARKERS,
    multi_line: bool = False,
) -> list[DataFrame]:
    """Per table with a schema: its cells that the schema cannot hold."""
    texts = _delivery_texts(spark, delivery_files(spark, folder, pattern), sep, encoding, schemas, na_values, multi_line)
    return [misfits(text, schemas[name], name) for name, text in texts.items() if name in schemas]


def read_table(spark: SparkSession, uri: str, fmt: str = "csv", **options) -> DataFrame:
    """Any Hadoop URI (``file:``, ``hdfs:``, ``s3a:`` …) in any Spark format."""
    return spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()}).load(uri)


def load_config(path: str) -> dict:
    """The JSON rule configuration; a clear error when the file is absent."""
    if not os.path.exists(path):
        raise FileNotFoundError(f"configuration file not found: {path}")
    with open(path, encoding="utf-8") as fh:
        return json.load(fh)
