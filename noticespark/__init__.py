"""Spark-native trade-notice analytics.

Operators are plain functions ``DataFrame -> DataFrame`` (in ``operators``)
or ``Column -> Column`` (in ``functions``); ``sources`` reads landed data and
derives the test projections; ``plans`` composes per-source batch jobs and
sinks; ``streaming`` runs the same batch job incrementally.
"""

__version__ = "0.1.0"
