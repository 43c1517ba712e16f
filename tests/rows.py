"""How tests look at results."""

from __future__ import annotations


def values(df, *columns):
    """Rows as tuples of the wanted columns, in the order of an 'id' column when there is one."""
    if "id" in df.columns:
        df = df.orderBy("id")
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()]
