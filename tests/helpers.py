"""What several test modules use."""

from __future__ import annotations

def pairs(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]
