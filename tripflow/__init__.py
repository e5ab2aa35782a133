"""tripflow: Spark-native analytics for trip and event records.

Every public function takes DataFrames / Columns plus column names and parameters and
returns DataFrames / Columns, so the work stays inside Catalyst plans and runs the same on
``local[*]`` and on a cluster.  The caller owns the SparkSession.
"""

__version__ = "0.1.0"
