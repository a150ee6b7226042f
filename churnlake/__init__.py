"""churnlake: Spark-native churn feature, scoring and monitoring jobs.

Every public function takes and returns DataFrames; nothing is collected on the
driver. See README.md for the operator map.
"""

__version__ = "0.1.0"
