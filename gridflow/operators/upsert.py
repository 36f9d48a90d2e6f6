"""Latest-wins views of a change log."""

from pyspark.sql import functions as F


def latest_wins(log, keys, order):
    """One row per key: the one with the greatest `order` columns.

    Written as an aggregate, so each task keeps one row per key before the shuffle, however
    often the key was written. It is a sort aggregate, whose sort spills.
    """
    rest = [c for c in log.columns if c not in keys]
    newest = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return log.groupBy(*keys).agg(newest.alias("_newest")).select(*keys, "_newest.*")
