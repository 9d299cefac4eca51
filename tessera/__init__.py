"""tessera — a Spark-native medallion analytics engine for e-commerce events.

Raw JSON event lines become a typed Silver table, are checked by a rule-based
quality gate, and are summarised into Gold daily metrics, staging marts and
parametrised reports.  Every step is a DataFrame transformation.
"""

__version__ = "0.1.0"
