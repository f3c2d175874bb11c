"""roadlake: a Spark-native road-speed lakehouse.

Readings -> silver (cleaned, calendar features) -> free-flow lookup -> gold
(lag features + 15-minute-ahead label) -> MLlib forest -> streaming collector
and scorer.  Every operator is a ``DataFrame -> DataFrame`` function built on
Spark SQL expressions, windows, joins and Structured Streaming.
"""

__version__ = "0.1.0"
