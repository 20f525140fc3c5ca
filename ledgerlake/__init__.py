"""ledgerlake: relational, maintenance, change-log and report operators on Spark.

Every operator takes and returns DataFrames; the work runs as Spark plans
(joins, aggregates, windows, shuffles, state) so it scales from local mode
to a cluster unchanged.
"""

__version__ = "0.1.0"
