"""tidepool: log, short-text and numeric event analytics as Spark DataFrame operators.

Every operator is a plain function ``f(df, ...) -> DataFrame`` built from Spark SQL
expressions. Projections work on batch (``spark.read``) and streaming
(``spark.readStream``) frames alike; aggregating operators have streaming
counterparts in :mod:`tidepool.streaming` with the same results, and the runners
there only wire a source to an operator and a sink.
"""

from tidepool.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
