"""tsforge — Spark-native preparation and analysis of (multivariate) time series.

Every operator takes and returns a lazy :class:`pyspark.sql.DataFrame` in the
canonical *long* layout (see :mod:`tsforge.spec`) and is expressed with the
DataFrame API so Catalyst plans it.  Ordered operators run on a chunked scan
(:mod:`tsforge.operators.scan`) so one very long series is split across many
tasks instead of collapsing into a single window partition.
"""

from tsforge.spec import KEYS, LONG_COLUMNS, SeriesSpec

__all__ = ["KEYS", "LONG_COLUMNS", "SeriesSpec"]
__version__ = "0.1.0"
