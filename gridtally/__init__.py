"""Smart-meter analytics as Spark DataFrame jobs.

Meter-days with 24 readings go in; hourly, daily and monthly tables and a set of
named reports come out.  Every step is ``DataFrame -> DataFrame`` and runs no job.
"""

__version__ = "0.1.0"
