"""The serving table, read back."""

from ..schemas import ZONE_METRICS
from ..sinks.change_log import ChangeLog


def read_metrics(spark, root):
    """The latest-wins table a metrics stream writes below `root`."""
    return ChangeLog(spark, f"{root}/metrics", ZONE_METRICS).latest()


def read_metrics_jdbc(spark, url, table, properties, first=None, last=None, parts=1):
    """The table in a database; with the `first` and `last` window start it is read in
    `parts` ranges at once."""
    if first is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column="window_start", lowerBound=first, upperBound=last,
                           numPartitions=parts, properties=properties)
