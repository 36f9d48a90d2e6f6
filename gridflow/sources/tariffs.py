"""Tariff drops: one file, the archive of past drops, and the drop in force."""

import logging

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..fixed_values import GATE_MISSING_FILE
from ..functions import label_time, try_number
from ..operators.enrich import one_row_per_household
from ..operators.lookup import measured_bytes
from ..operators.quality import GateFailed, gate_report, require_passed
from ..schemas import TARIFF
from ..session import run_dir

log = logging.getLogger(__name__)


def read_drop(spark, path, schema=TARIFF):
    """A tariff CSV. Columns are taken by name, others are left out, unreadable cells become null.

    With a schema Spark takes CSV columns by position, so the cells are read as text.
    """
    return _cells(spark.read.option("header", "true").csv(path), schema)


def _cells(rows, schema, *more):
    return rows.select(*[
        (F.col(f.name) if isinstance(f.dataType, T.StringType) else try_number(F.col(f.name), f.dataType.simpleString()))
        .alias(f.name) for f in schema.fields
    ], *more)


def read_drop_text(spark, path):
    """A tariff CSV as text with its row order, for the quality gate.

    The columns are those of the file, so that a missing one can be reported.
    """
    if not storage.exists(spark, path):
        raise FileNotFoundError(GATE_MISSING_FILE % path)
    rows = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    return rows.select("*", file_order().alias("row_order"))


def file_order():
    """A sortable place in the input: file, block in the file, row in the task."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_history(spark, path, schema=TARIFF):
    """All archived drops below `path`; the time of each is the label in its name, `row_order` a row's place in its files.

    Their headers have to agree; a file with other columns fails the read.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", "true").option("enforceSchema", "false")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
        .csv(path)
    )
    # Either tariffs_<label>.csv or any file below a folder drop=<label>.
    label = F.regexp_extract(F.col("_metadata.file_path"), r"(?:tariffs_|drop=|drop%3D)(\d{8}_\d{6})", 1)
    dropped = label_time(label)
    return rows.where(label != "").select(
        *schema.fieldNames(),
        dropped.cast("date").alias("simulated_day_date"),
        dropped.alias("effective_timestamp"),
        file_order().alias("row_order"),
    )


def drop_labels(spark, root):
    """Labels of the published drops, oldest first."""
    return [n.split("=", 1)[1] for n in storage.child_names(spark, root) if n.startswith("drop=")]


class CurrentTariffs:
    """The newest published drop that passes the gate, looked up again on every call.

    A frame fixes its file list when it is made, so a long-running job has to ask again
    per micro-batch. A new drop is gated and reduced to one row per household, the last in
    the file, and that is written once per drop; if the drop is missing, unreadable or
    refused, the newest good one before it counts. `duplicates` counts the rows left out,
    `bytes` is the measured size of the rows that count.
    """

    def __init__(self, spark, root, schema=TARIFF, **gate_options):
        self.spark, self.root, self.schema, self.gate_options = spark, root, schema, gate_options
        self.label, self.refused, self.rows, self.duplicates, self.bytes, self._frame = None, set(), 0, 0, 0, None

    def refresh(self):
        """Row count of the drop now in force, 0 if there never was one."""
        newer = [n for n in drop_labels(self.spark, self.root) if self.label is None or n > self.label]
        for label in reversed(newer):
            if label in self.refused:
                continue
            try:
                self._take(label)
                break
            except Exception as error:  # an unreadable drop must not stop the stream
                log.warning("drop %s not taken: %s", label, error)
                if isinstance(error, GateFailed):
                    self.refused.add(label)
        return self.rows

    def _take(self, label):
        text = read_drop_text(self.spark, f"{self.root}/drop={label}")
        report = require_passed(gate_report(text, **self.gate_options))
        rows = one_row_per_household(_cells(text, self.schema, "row_order"), ["row_order"])
        folder = run_dir(self.spark, f"tariffs-{label}")
        rows.write.parquet(folder)
        frame = self.spark.read.schema(self.schema).parquet(folder)
        count = frame.count()
        if count < report["record_count"]:
            log.warning("drop %s: %d duplicate rows left out", label, report["record_count"] - count)
        self.label, self.rows, self.duplicates = label, count, report["record_count"] - count
        self.bytes, self._frame = measured_bytes(frame), frame

    def frame(self):
        self.refresh()
        if self._frame is None:
            return self.spark.createDataFrame([], self.schema)
        return self._frame


class FixedTariffs:
    """A frame of tariffs, one row per household, in the form that jobs ask for."""

    def __init__(self, tariffs):
        self._frame, self.bytes = tariffs, measured_bytes(tariffs)

    def frame(self):
        return self._frame
