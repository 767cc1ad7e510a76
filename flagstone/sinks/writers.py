"""Writing flagged tables and reports: delimited files and catalog tables.

An output is written beside its final place first and takes that place by
renames only when it is complete, so a failed run leaves the former output as
it was. Data is written in parallel, one file per partition; a report of one
named file is joined from its parts.
"""

from __future__ import annotations

import logging
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ident, sql_str

log = logging.getLogger(__name__)

RAW_SUFFIX = "_RAW"
QC_SUFFIX = "_QC"
# Suffix of the former table while the new one takes its name.
FORMER_SUFFIX = "__former"
# Parts up to this many bytes in sum are joined into one file.
JOIN_BYTES = 256 << 20
# Compressed ones up to a part of that, as they are unpacked and packed again.
JOIN_COMPRESSED_BYTES = 64 << 20
# End of the names of compressed files: readers know them by it.
COMPRESSED_END = {"gzip": ".gz", "bzip2": ".bz2"}
FAST_GZIP = ("zlib.compress.level", "BEST_SPEED")


def sanitize_table_name(name: str) -> str:
    """Catalog-safe name: every non-word character becomes ``_``."""
    return re.sub(r"\W", "_", name)


def flatten_arrays(df: DataFrame, sep: str = ";") -> DataFrame:
    """Delimited files cannot hold arrays: join array cells into text."""
    cols = []
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.concat_ws(sep, c.cast("array<string>")).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def _hadoop_path(spark: SparkSession, *parts):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(*parts)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def _staging(spark: SparkSession, target):
    """A hidden sibling of ``target``: readers of the parent folder skip it."""
    return _hadoop_path(spark, target.getParent(), f".{target.getName()}.next-{uuid.uuid4().hex[:12]}")


def _swap_in(spark: SparkSession, staged, target) -> None:
    """Let ``staged`` take the place of ``target``. A former output that an earlier
    run left aside, because it ended between the two renames, is put back first."""
    fs = _file_system(spark, target)
    former = _hadoop_path(spark, target.getParent(), f".{target.getName()}.former")
    if fs.exists(former):
        if fs.exists(target):
            fs.delete(former, True)
        else:
            _rename(fs, former, target)
    if fs.exists(target):
        _rename(fs, target, former)
    _rename(fs, staged, target)
    fs.delete(former, True)


def replace_folder(df: DataFrame, path: str, write) -> None:
    """``write(writer, folder)`` to a folder beside ``path``, which it then replaces."""
    spark = df.sparkSession
    target = _hadoop_path(spark, path.rstrip("/"))
    fs, staged = _file_system(spark, target), _staging(spark, target)
    try:
        write(df.write, str(staged.toString()))
        _swap_in(spark, staged, target)
    finally:
        fs.delete(staged, True)


def _parts(fs, folder) -> list:
    return sorted((st for st in fs.listStatus(folder) if not st.getPath().getName().startswith(("_", "."))), key=lambda st: st.getPath().getName())


def _append_batch(df: DataFrame, path: str, batch: str, write) -> None:
    """Add the parts of one batch to a folder; parts that an earlier try of the batch left are replaced."""
    spark = df.sparkSession
    if not re.fullmatch(r"[\w-]+", batch):
        raise ValueError(f"a batch is named by letters, digits, _ and -: {batch!r}")
    target = _hadoop_path(spark, path.rstrip("/"))
    fs, staged = _file_system(spark, target), _staging(spark, target)
    try:
        write(df.write, str(staged.toString()))
        fs.mkdirs(target)
        for st in _parts(fs, target):
            if st.getPath().getName().startswith(f"batch-{batch}.part-"):
                fs.delete(st.getPath(), False)
        for st in _parts(fs, staged):
            _rename(fs, st.getPath(), _hadoop_path(spark, target, f"batch-{batch}.{st.getPath().getName()}"))
    finally:
        fs.delete(staged, True)


def _join_parts(spark: SparkSession, fs, staged, header: bool = True, compressed: bool = False) -> object:
    """The parts of ``staged`` as one file with the header of the first; ``staged``
    itself where they are too large together to pass through one stream."""
    parts = _parts(fs, staged)
    if len(parts) == 1:
        return parts[0].getPath()
    if sum(st.getLen() for st in parts) > (JOIN_COMPRESSED_BYTES if compressed else JOIN_BYTES):
        log.warning("%s: %d parts stay a folder, too large for one file", staged, len(parts))
        return staged
    whole = _hadoop_path(spark, staged, "_whole")
    out, copy = fs.create(whole), spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes
    if compressed:
        jvm = spark.sparkContext._jvm
        conf = jvm.org.apache.hadoop.conf.Configuration(spark.sparkContext._jsc.hadoopConfiguration())
        conf.set(*FAST_GZIP)
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(parts[0].getPath())
        out = codec.createOutputStream(out)
        try:
            for i, st in enumerate(parts):
                source = jvm.java.io.DataInputStream(codec.createInputStream(fs.open(st.getPath())))
                try:
                    if i and header:
                        source.readLine()
                    copy(source, out, 1 << 20, False)
                finally:
                    source.close()
        finally:
            out.close()
        return whole
    try:
        for i, st in enumerate(parts):
            source = fs.open(st.getPath())
            try:
                if i:
                    source.seek(len(source.readLine()) + 1)
                copy(source, out, 1 << 20, False)
            finally:
                source.close()
    finally:
        out.close()
    return whole


def write_delimited(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    sep: str = ",",
    header: bool = True,
    single_file: bool = False,
    encoding: str | None = None,
    batch: str | None = None,
    compression: str | None = None,
) -> None:
    """Delimited text output (``mode`` overwrite or append). White space is kept
    and quotes are doubled, so that :func:`read_delimited` reads the same text;
    text that ``encoding`` cannot hold is an error.

    An overwritten output is whole or as it was. An append with a ``batch``
    name can be tried again: it replaces what the batch has written before.
    ``single_file`` makes ``path`` one file, joined from parts written in
    parallel; parts of more than :data:`JOIN_BYTES` stay a folder.
    ``compression`` (``gzip`` or ``bzip2``) compresses every file; the name of a
    single one must end with ``.gz`` or ``.bz2``, as readers know it by that."""
    spark = df.sparkSession
    if compression is not None and compression not in COMPRESSED_END:
        raise ValueError(f"compression must be one of {sorted(COMPRESSED_END)}, got {compression!r}")
    if compression and single_file and not path.endswith(COMPRESSED_END[compression]):
        raise ValueError(f"a single file of {compression} must end with {COMPRESSED_END[compression]}: {path!r}")
    out = flatten_arrays(df)
    if encoding and encoding.upper() not in ("UTF-8", "UTF8"):
        # encode() fails on characters outside the charset; every charset holds ASCII
        out = out.selectExpr(
            *[
                f"CASE WHEN octet_length({ident(f.name)}) = length({ident(f.name)}) OR encode({ident(f.name)}, {sql_str(encoding)}) IS NOT NULL THEN {ident(f.name)} END AS {ident(f.name)}"
                if isinstance(f.dataType, T.StringType)
                else ident(f.name)
                for f in out.schema.fields
            ]
        )

    def write(writer, folder: str) -> None:
        w = writer.option("header", header).option("sep", sep).option("escape", '"')
        w = w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        if encoding:
            w = w.option("encoding", encoding)
        if compression:
            w = w.option("compression", compression).option(*FAST_GZIP)
        w.csv(folder)

    if mode == "append" and batch is not None:
        _append_batch(out, path, batch, write)
    elif mode == "append":
        write(out.write.mode("append"), path)
    elif mode != "overwrite":
        raise ValueError(f"mode must be 'overwrite' or 'append', got {mode!r}")
    elif not single_file:
        replace_folder(out, path, write)
    else:
        if any("\n" in c for c in out.columns):
            raise ValueError("a column name with a line break cannot head one file of several parts")
        target = _hadoop_path(spark, path.rstrip("/"))
        fs, staged = _file_system(spark, target), _staging(spark, target)
        try:
            write(out.write, str(staged.toString()))
            _swap_in(spark, _join_parts(spark, fs, staged, header, bool(compression)), target)
        finally:
            fs.delete(staged, True)


def replace_table(df: DataFrame, database: str, name: str, suffix: str = "", fmt: str = "parquet") -> str:
    """Replace catalog table ``database.<sanitized name><suffix>`` with ``df``;
    returns the qualified name.

    The rows are stored under another name first, so ``df`` may read the table
    it replaces, and a failed write leaves the table as it was. Should a run end
    between the two renames, the next one finds the former table and puts it back."""
    spark, plain = df.sparkSession, sanitize_table_name(name) + suffix

    def full(end: str = "") -> str:
        return f"`{database}`.`{plain}{end}`"

    staged = f"__next_{uuid.uuid4().hex[:12]}"
    try:
        df.write.format(fmt).saveAsTable(full(staged))
        if spark.catalog.tableExists(full(FORMER_SUFFIX)):
            if spark.catalog.tableExists(full()):
                spark.sql(f"DROP TABLE {full(FORMER_SUFFIX)}")
            else:
                spark.sql(f"ALTER TABLE {full(FORMER_SUFFIX)} RENAME TO {full()}")
        if spark.catalog.tableExists(full()):
            spark.sql(f"ALTER TABLE {full()} RENAME TO {full(FORMER_SUFFIX)}")
        spark.sql(f"ALTER TABLE {full(staged)} RENAME TO {full()}")
        spark.sql(f"DROP TABLE IF EXISTS {full(FORMER_SUFFIX)}")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {full(staged)}")
    return full()


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")
