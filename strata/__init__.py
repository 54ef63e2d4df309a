"""strata: bronze -> silver -> gold analytics on Spark.

Entry points: ``plans.lakehouse.Lakehouse`` / ``LandedLakehouse`` (layer stack),
``plans.reports`` and ``plans.questions`` (report frames), ``plans.registry.QUERIES``
(named queries) and ``plans.oracle.SQL`` (their DuckDB equivalents).
"""

__version__ = "0.1.0"
