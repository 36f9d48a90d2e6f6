"""Publishing a tariff drop."""

import uuid

from .. import storage
from ..fixed_values import TARIFF_COLUMNS
from ..operators.quality import gate_report, require_passed
from ..sources.tariffs import read_drop_text


def stage_drop(tariffs, root):
    """Write a drop as CSV to a hidden folder and return its path."""
    staging = f"{root}/_staging/{uuid.uuid4().hex}"
    tariffs.select(*TARIFF_COLUMNS).write.option("header", "true").csv(staging)
    return staging


def publish_drop(spark, staging, root, label):
    """Make a staged drop the newest one by one rename; returns its path."""
    final = f"{root}/drop={label}"
    storage.publish(spark, staging, final)
    return final


def gated_publish(tariffs, root, label, **gate_options):
    """Stage a drop, check the staged files, and publish them only if they pass."""
    spark = tariffs.sparkSession
    staging = stage_drop(tariffs, root)
    try:
        report = require_passed(gate_report(read_drop_text(spark, staging), **gate_options))
    except ValueError:
        storage.remove(spark, staging)
        raise
    return publish_drop(spark, staging, root, label), report
