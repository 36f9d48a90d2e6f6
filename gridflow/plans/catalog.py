"""All registered queries and their oracle SQL."""

from . import queries_orders, queries_readings, queries_streams, queries_tariffs, queries_zones

GROUPS = (queries_readings, queries_zones, queries_tariffs, queries_orders, queries_streams)


def _in_utc(query):
    """Times in the tables carry no zone; all of them are read as UTC."""
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def queries():
    return {name: _in_utc(query) for group in GROUPS for name, query in group.queries().items()}


def oracles():
    return {name: sql for group in GROUPS for name, sql in group.oracles().items()}
