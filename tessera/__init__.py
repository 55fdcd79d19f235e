"""tessera: Spark-native text and raster analytics.

Every public function is either ``Column -> Column`` (``tessera.functions``)
or ``DataFrame -> DataFrame`` (``tessera.operators``); sources and sinks live
in ``tessera.sources``, Structured Streaming jobs in ``tessera.streaming`` and
the registered, oracle-checked queries in ``tessera.plans``.
"""

from tessera.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
