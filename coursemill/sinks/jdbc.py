"""Results in a relational database, for consumers that read them there.

The published files stay the source of truth: a table is always reloaded from them, so no row is read, changed and
written back, and a repeated publication is harmless. Needs the database's driver on the class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def reload_table(df: DataFrame, url: str, table: str, *, writers: int = 8, **properties: str) -> None:
    """Truncate ``table`` and load ``df`` into it over at most ``writers`` connections."""
    (
        df.coalesce(writers)
        .write.format("jdbc")
        .options(url=url, dbtable=table, truncate="true", **properties)
        .mode("overwrite")
        .save()
    )
