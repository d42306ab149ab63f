"""Helpers shared by the tests."""


def by_id(df, *cols):
    """{series_id: row} or {series_id: value} of the only column asked for."""
    rows = {r["series_id"]: r for r in df.collect()}
    return {k: r[cols[0]] for k, r in rows.items()} if len(cols) == 1 else rows
