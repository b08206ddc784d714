"""Event analytics for PySpark: enrichment, windows, anomaly flags, checks, alerts and gates.

Every operator is a plain ``DataFrame -> DataFrame`` function with its thresholds as
keyword parameters; see the README for the map from operator to module.
"""

__version__ = "0.1.0"
