"""leafstat — page-usage analytics on Spark.

Raw page-view events and a page catalog become five conformed silver tables
(page-day, report-day and pseudonymised user-day facts, the catalog, and the
pages nobody opened).  A catalogue of DataFrame queries answers the usage
questions on top of them.  Every operator is a pure ``DataFrame -> DataFrame``
function so Catalyst and AQE plan the whole job.
"""

from leafstat.session import get_spark

__all__ = ["get_spark"]
