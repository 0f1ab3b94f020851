"""All registered queries and their SQL."""

from __future__ import annotations

from waybill.queries import admission, delivery, observability, orders, streams, telemetry

MODULES = (orders, delivery, telemetry, observability, admission, streams)


def _in_utc(query):
    """The model tables hold UTC instants, so every query runs in a UTC session."""

    def run(spark, folder):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, folder)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


QUERIES = {name: _in_utc(query) for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: text for module in MODULES for name, text in module.ORACLE.items()}
