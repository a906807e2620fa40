"""orchard: Spark-native feature preparation, model fitting, scoring and tuning.

Every public operator is a function ``DataFrame -> DataFrame`` (or a small
model object whose ``transform`` is one).  The caller owns the SparkSession.
"""

__version__ = "0.1.0"
