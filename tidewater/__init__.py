"""tidewater: pipeline observability on stock Apache Spark.

Raw multi-system event files become trusted tables (landing JSON -> bronze ->
silver), and the package then reports on both the data (business KPIs,
cross-system audit rules) and the pipelines that made it (run log,
completeness, monthly close, alerts, retention).

Every operator is a plain function from DataFrames to a DataFrame; sinks live
at the edge (``tidewater.sources.tables``) and jobs are composed in
``tidewater.plans``.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
