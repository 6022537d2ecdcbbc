"""Customer-churn analytics on Spark DataFrames.

Every public function takes and returns a ``pyspark.sql.DataFrame`` unless its
docstring says otherwise; the work is declared with built-in expressions,
aggregates, joins and windows so Catalyst plans it, and MLlib fits the models.
"""

__version__ = "0.1.0"
