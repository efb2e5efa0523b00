"""Lineage cuts between pipeline stages.

Operators reuse their input in several branches (per-series statistics joined
back, chunk summaries carried over chunks), so a deep composition would
re-derive shared sub-plans many times.  Workflows therefore materialise the
canonical series and large intermediate stages with a reliable
``checkpoint()`` into the cluster's ``spark.checkpoint.dir`` (a shared folder
that survives executor loss); a local scratch folder is only chosen when the
session has none (tests, local runs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tsforge.session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
