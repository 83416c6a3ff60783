"""outletlab: customer-level analytical and modelling base tables on Spark.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects;
nothing is collected to the driver except metadata (schemas, column lists)
and one-row results that are part of the output (e.g. a model metric).
"""

from outletlab.session import checkpoint_root, get_spark

__all__ = ["get_spark", "checkpoint_root"]
