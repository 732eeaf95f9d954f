"""revlens: product-review analytics expressed as Spark DataFrame plans.

Every operator is a plain function ``DataFrame -> DataFrame`` or
``Column -> Column`` built from native Spark SQL expressions, joins,
windows and ``pyspark.ml`` stages.  Only batch scoring with a user's own
model (``revlens.operators.models.score_batches``) runs Python on workers.
"""

__version__ = "0.1.0"
