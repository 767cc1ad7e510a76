"""What a delivery run has finished, so that a restart goes on from there.

Every finished step (a stored table, an anchor, a written report) leaves one
small file below the output folder: a fingerprint of all that the step depends
on, and a few figures of its result. Steps run side by side, so they do not
share a file. A step counts as finished where its file holds the fingerprint
that it has now; stored outputs take their place by renames
(:mod:`flagstone.sinks.writers`), so a finished one is never half written.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Mapping

from pyspark.sql import SparkSession

FOLDER = "_manifest"


def fingerprint(*parts) -> str:
    """Digest of JSON-like values (keys in order, anything else by its text)."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def file_states(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, length, time of change) of a file, or of the files of a folder that are data."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    state = fs.getFileStatus(target)
    found = [state] if state.isFile() else [s for s in fs.listStatus(target) if not s.getPath().getName().startswith(("_", "."))]
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found)


class Manifest:
    """Finished steps of the run that writes to ``output``."""

    def __init__(self, spark: SparkSession, output: str):
        self._spark, self._folder = spark, os.path.join(output, FOLDER)

    def _file(self, step: str):
        jvm = self._spark.sparkContext._jvm
        plain = re.sub(r"\W", "_", step) + "-" + hashlib.sha256(step.encode()).hexdigest()[:8]
        path = jvm.org.apache.hadoop.fs.Path(os.path.join(self._folder, plain + ".json"))
        return path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()), path

    def finished(self, step: str, mark: str) -> Mapping | None:
        """The figures of a step that was finished with this fingerprint, else None."""
        fs, path = self._file(step)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            text = self._spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            held = json.loads(text)
        except ValueError:  # written by a run that ended at this point
            return None
        return held["figures"] if held.get("mark") == mark else None

    def forget(self, step: str) -> None:
        """Before a step is made again: its output may soon be another one."""
        fs, path = self._file(step)
        fs.delete(path, False)

    def record(self, step: str, mark: str, figures: Mapping | None = None) -> None:
        fs, path = self._file(step)
        stream = fs.create(path, True)
        try:
            stream.write(bytearray(json.dumps({"step": step, "mark": mark, "figures": dict(figures or {})}).encode()))
        finally:
            stream.close()
