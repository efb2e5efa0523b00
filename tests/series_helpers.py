"""Helpers that the test modules import by name (a conftest can be shadowed by another one)."""


def collect_series(df, var=None):
    q = df if var is None else df.filter(df["var"] == var)
    return [r["value"] for r in q.orderBy("series_id", "var", "pos").collect()]
