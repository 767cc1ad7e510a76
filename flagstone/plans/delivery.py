"""A whole delivery run: read the files, store them raw, run the configured
rules, store the flagged tables, write flagged CSV, reports and a summary.

Stored tables are the lineage cuts. The raw copy (``<name>_RAW`` in a
catalog database, or Parquet under the output folder) is read back before the
rules run, so CSV parsing happens once and a lost executor never sends Spark
back to the text files; the flagged copy (``<name>_QC``) is read back before
the reports, which therefore scan stored columns instead of re-running every
rule. All reports on single cells of a table come from one scan of it. A flagged
copy in Parquet also holds the limits that date rules found for the flagged rows
(columns ``__dq_limit_…``, null elsewhere, taken out of all that is handed out), so
date reports only filter it. Rows and flags are counted while the flagged copy is written, so the
summary reads no table at all.
"""

from __future__ import annotations

import logging
import os
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sinks.writers import COMPRESSED_END, QC_SUFFIX, RAW_SUFFIX, ensure_database, replace_folder, replace_table, sanitize_table_name, write_delimited
from ..operators.dates import without_limits
from ..operators.summary import union_all
from ..sources.delivery import delivery_files, delivery_misfits, delivery_paths, read_delimited, read_delivery
from .manifest import Manifest, file_states, fingerprint
from .runner import RuleFn, RunOptions, run_rules, vendor_registry

log = logging.getLogger(__name__)

# Fixed value: name of the summary output.
SUMMARY_NAME = "qc_summary"
# Cells that the given schemas cannot hold.
MISFIT_NAME = "qc_misfit"
# While flagged tables are written: rows that a join has brought together by some of the
# keys of the next one are not shuffled again, unless a skewed key has to be split.
FLAG_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}
# While the steps run: shuffled rows leave the disk with the step that has read them.
RUN_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Stored copies are compressed so closely that a task with as many bytes of them as of other
# files would hold too many rows to count or shuffle them without spilling. So they are read
# in small parts, of a row group each, but not in more parts than a driver can keep track of.
SCAN_KEY, PARTS_KEY = "spark.sql.files.maxPartitionBytes", "spark.sql.files.maxPartitionNum"
SCAN_BYTES, SCAN_PARTS = 8 << 20, 50_000
STORED = {"compression": "zstd", "parquet.block.size": SCAN_BYTES}


@dataclass
class DeliveryResult:
    raw: dict[str, DataFrame]
    flagged: dict[str, DataFrame]
    summary: DataFrame | None
    outputs: dict[str, str]
    rules_run: list[str]


def store(spark: SparkSession, df: DataFrame, name: str, suffix: str, database: str | None, folder: str) -> DataFrame:
    """Write ``df`` as a table (catalog when ``database`` is given, else
    Parquet below ``folder``) and return the stored copy."""
    if database:
        return spark.table(replace_table(df, database, name, suffix))
    path = os.path.join(folder, sanitize_table_name(name) + suffix)
    replace_folder(df, path, lambda writer, folder: writer.options(**STORED).parquet(folder))
    return spark.read.parquet(path)


def stored(spark: SparkSession, name: str, suffix: str, database: str | None, folder: str) -> DataFrame | None:
    """What :func:`store` has written before, or None."""
    if database:
        full = f"`{database}`.`{sanitize_table_name(name) + suffix}`"
        return spark.table(full) if spark.catalog.tableExists(full) else None
    path = os.path.join(folder, sanitize_table_name(name) + suffix)
    return spark.read.parquet(path) if _exists(spark, path) else None


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _run_all(jobs: Mapping[str, Callable[[], object]], parallel_jobs: int) -> dict[str, object]:
    """Run independent Spark actions, ``parallel_jobs`` at a time (Spark
    schedules jobs submitted from several driver threads side by side, so
    many small tables keep the cluster busy); results keyed like ``jobs``."""
    if parallel_jobs <= 1 or len(jobs) <= 1:
        return {k: fn() for k, fn in jobs.items()}
    with ThreadPoolExecutor(max_workers=parallel_jobs) as pool:
        futures = {k: pool.submit(fn) for k, fn in jobs.items()}
        return {k: f.result() for k, f in futures.items()}


@contextmanager
def _session_conf(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the time of a block."""
    former = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in former.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _scan_conf(spark: SparkSession) -> dict[str, str]:
    """At most :data:`SCAN_BYTES` a task, and :data:`SCAN_PARTS` tasks, unless the session has its own number."""
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(SCAN_KEY))
    return {SCAN_KEY: str(min(size, SCAN_BYTES)), PARTS_KEY: spark.conf.get(PARTS_KEY, None) or str(SCAN_PARTS)}


def _check_names(names) -> None:
    """Tables and reports must differ in the names they are stored under."""
    stored: dict[str, str] = {}
    for name in names:
        key = sanitize_table_name(name).lower()
        if key in stored:
            raise ValueError(f"{stored[key]!r} and {name!r} would be stored under one name")
        stored[key] = name


def run_delivery(
    spark: SparkSession,
    vendor: Mapping,
    input_loc: str | None = None,
    output_loc: str | None = None,
    database: str | None = None,
    schemas: Mapping[str, StructType] | None = None,
    options: RunOptions | None = None,
    registry: Mapping[str, RuleFn] | None = None,
    csv_output: bool = True,
    single_file: bool = False,
    parallel_jobs: int = 4,
    multi_line: bool = False,
    resume: bool = False,
) -> DeliveryResult:
    """Run one vendor configuration; independent table writes run
    ``parallel_jobs`` at a time.

    Keys: ``rules``, ``rule_sequence``; ``refresh_dt``, ``folder`` and
    ``project`` locate the delivery (without ``project``: the older layout);
    ``database`` holds the ``_RAW`` and ``_QC`` tables (argument ``database``
    goes first; ``""`` stores Parquet below the output folder); ``flavour``
    chooses the rule set; ``stamp`` true puts the UTC time behind output names;
    ``on_misfit`` says what a cell means that its type in ``schemas`` cannot hold:
    ``fail`` (default) ends the run, ``report`` makes it null and lists it in
    ``qc_misfit``. Reports and the summary are one file each; flagged tables are
    folders of parts unless ``single_file``. ``compression`` (``gzip`` or ``bzip2``)
    compresses all of these; the name of a single file then ends with ``.gz`` or ``.bz2``.

    ``resume`` goes on where an earlier run to the same output ended: a table
    whose file, a flagged table or a report whose tables and configuration are
    the same as then, is not made again (:mod:`.manifest`). Rules of a
    ``registry`` are told apart by their names only."""
    for k in ("rules", "rule_sequence"):
        if k not in vendor:
            raise ValueError(f"vendor configuration needs '{k}'")
    if input_loc is None or output_loc is None:
        for k in ("refresh_dt", "folder"):
            if k not in vendor:
                raise ValueError(f"vendor configuration needs '{k}' to locate the delivery")
        default_in, default_out = delivery_paths(vendor.get("project"), vendor["folder"], vendor["refresh_dt"])
        input_loc = input_loc or default_in
        output_loc = output_loc or default_out
    database = vendor.get("database") if database is None else database
    stamp = time.strftime("_%Y%m%d%H%M%S", time.gmtime()) if vendor.get("stamp") else ""
    on_misfit = vendor.get("on_misfit", "fail")
    if on_misfit not in ("fail", "report"):
        raise ValueError(f"on_misfit must be 'fail' or 'report', got {on_misfit!r}")
    compression = vendor.get("compression") or None
    if compression is not None and compression not in COMPRESSED_END:
        raise ValueError(f"compression must be one of {sorted(COMPRESSED_END)}, got {compression!r}")
    packed = COMPRESSED_END.get(compression, "")
    report_misfits = bool(schemas) and on_misfit == "report"
    manifest = Manifest(spark, output_loc)

    def step(kind: str, name: str, mark: str, suffix: str, place: tuple[str | None, str], make, figures=None) -> tuple[DataFrame, Mapping]:
        """A stored table: the finished one, or made now and recorded."""
        done = manifest.finished(f"{kind} {name}", mark) if resume else None
        held = stored(spark, name, suffix, *place) if done is not None else None
        if held is not None:
            return held, done
        manifest.forget(f"{kind} {name}")
        out = store(spark, make(), name, suffix, *place)
        found = figures() if figures else {}
        manifest.record(f"{kind} {name}", mark, found)
        return out, found

    place = (database, output_loc)
    files = delivery_files(spark, input_loc)
    _check_names(files)
    reading = [multi_line, on_misfit, database]
    marks = {n: fingerprint(p, file_states(spark, p), (schemas or {}).get(n) and schemas[n].json(), reading) for n, p in files.items()}
    ready = {n for n in files if resume and manifest.finished(f"raw {n}", marks[n]) is not None and stored(spark, n, RAW_SUFFIX, *place) is not None}
    null_misfits = "null" if on_misfit == "report" else "fail"
    inputs = read_delivery(spark, input_loc, schemas=schemas, multi_line=multi_line, on_misfit=null_misfits, skip=ready) if len(ready) < len(files) else {}
    if database:
        ensure_database(spark, database)
    with _session_conf(spark, RUN_CONF):
        raw_steps = _run_all(
            {n: (lambda n=n: step("raw", n, marks[n], RAW_SUFFIX, place, lambda: inputs[n])) for n in files},
            parallel_jobs,
        )
    raw = {n: df for n, (df, _) in raw_steps.items()}
    with _session_conf(spark, {**RUN_CONF, **_scan_conf(spark)}):
        mark = fingerprint(marks, vendor["rules"], vendor["rule_sequence"], vendor.get("flavour"), repr(options), sorted(registry or {}))
        stage_place = (None, os.path.join(output_loc, "_stage"))
        opts = replace(options or RunOptions(), stage=lambda name, df: step("stage", name, mark, "", stage_place, lambda: df)[0], keep_limits=not database)
        res = run_rules(raw, vendor["rules"], vendor["rule_sequence"], registry=registry or vendor_registry(vendor), options=opts)
        _check_names([*files, *res.reports, SUMMARY_NAME, MISFIT_NAME])
        counting, counts = res.observed()
        with _session_conf(spark, FLAG_CONF):
            qc_steps = _run_all(
                {
                    n: (lambda n=n, df=df: step("qc", n, mark, QC_SUFFIX, place, lambda: df, lambda: counts[n].get if n in counts else {}))
                    for n, df in counting.items()
                },
                parallel_jobs,
            )
        kept = {n: df for n, (df, _) in qc_steps.items()}
        flagged = {n: without_limits(df) for n, df in kept.items()}

        _run_all({n: (lambda n=n: res.cells[n]) for n in res.cells}, parallel_jobs)
        writes: dict[str, tuple[DataFrame, str, bool]] = {}
        if csv_output:
            for n, df in flagged.items():
                writes[n] = (df, os.path.join(output_loc, sanitize_table_name(n) + stamp + ".csv" + (packed if single_file else "")), single_file)
        for name in res.reports:
            report = res.report(name, kept)
            if report is not None:
                writes[name] = (report, os.path.join(output_loc, sanitize_table_name(name) + stamp + ".csv" + packed), True)
        if report_misfits:
            found = union_all(delivery_misfits(spark, input_loc, schemas, multi_line=multi_line))
            if found is not None:
                writes[MISFIT_NAME] = (found, os.path.join(output_loc, MISFIT_NAME + stamp + ".csv" + packed), True)
        summary = res.observed_summary(spark, {n: figures for n, (_, figures) in qc_steps.items()})
        if summary is not None:
            writes[SUMMARY_NAME] = (summary, os.path.join(output_loc, SUMMARY_NAME + stamp + ".csv" + packed), True)

        def write(name: str, df: DataFrame, path: str, one: bool) -> None:
            at = fingerprint(mark, path, one, *([compression] if compression else []))
            if resume and manifest.finished(f"out {name}", at) is not None and _exists(spark, path):
                return
            manifest.forget(f"out {name}")
            write_delimited(df, path, single_file=one, compression=compression)
            manifest.record(f"out {name}", at)

        _run_all({k: (lambda k=k, w=w: write(k, *w)) for k, w in writes.items()}, parallel_jobs)
    outputs = {k: path for k, (_, path, _) in writes.items()}
    return DeliveryResult(raw, flagged, summary, outputs, res.rules_run)


def upload_file(
    spark: SparkSession,
    path: str,
    database: str,
    table: str,
    sep: str = ",",
    schema: StructType | None = None,
    encoding: str | None = None,
) -> DataFrame:
    """One delimited file into catalog table ``database.table`` (replaced),
    returned as the stored table."""
    ensure_database(spark, database)
    df = read_delimited(spark, path, sep=sep, schema=schema, encoding=encoding)
    return spark.table(replace_table(df, database, table))


class VendorRuns(dict):
    """``{vendor: DeliveryResult}``, and in ``failed`` the errors of the vendors that did not finish."""

    def __init__(self):
        super().__init__()
        self.failed: dict[str, Exception] = {}


def run_vendors(spark: SparkSession, config: Mapping, vendors: str | Sequence[str], **kw) -> VendorRuns:
    """Run several vendors (comma-separated or a list); names are matched
    upper-cased, an unknown vendor is reported and skipped. A vendor that fails
    is logged and kept in ``failed``; the others run. Explicit locations
    and a database are those of a single vendor; of several, each gets a
    sub-folder and a database of its own below them."""
    names = [v.strip() for v in vendors.split(",")] if isinstance(vendors, str) else list(vendors)
    known = {}
    for name in filter(None, names):
        key = name.upper()
        if key not in config or not isinstance(config[key], Mapping):
            log.warning("vendor %s not in configuration, skipped", name)
            continue
        known[key] = config[key]
    apart = len(known) > 1
    out = VendorRuns()
    for key, vendor in known.items():
        own = dict(kw)
        for loc in ("input_loc", "output_loc"):
            if apart and own.get(loc):
                own[loc] = os.path.join(own[loc], key)
        if apart and own.get("database"):
            own["database"] = f"{own['database']}_{sanitize_table_name(key).lower()}"
        try:
            out[key] = run_delivery(spark, vendor, **own)
        except Exception as e:
            log.exception("vendor %s failed", key)
            out.failed[key] = e
    return out
