"""churnkit: customer-churn analytics on Spark.

Event log -> cleaned, labelled events -> one-row-per-user feature table ->
exploration reports -> MLlib training, evaluation, tuning and scoring.
Everything is a DataFrame / Spark SQL / pyspark.ml job.
"""

__version__ = "0.1.0"
