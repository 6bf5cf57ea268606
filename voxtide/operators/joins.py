"""Broadcast with a checked size bound, and small JVM-side lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Dimension tables above this many rows are never broadcast by us.
MAX_BROADCAST_ROWS = 100_000
# ... nor above this many bytes (estimate of a local relation).
MAX_BROADCAST_BYTES = 64 << 20


def _sql_value(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small fixed table as a JVM ``LocalRelation`` (SQL ``VALUES``).

    Unlike ``createDataFrame`` on a Python list it needs no Python worker and
    its size is known exactly to the planner."""
    names = [c.strip().split()[0] for c in ddl.split(",")]
    types = [" ".join(c.strip().split()[1:]) for c in ddl.split(",")]
    cols = ", ".join(f"CAST(c{i} AS {t}) AS {n}" for i, (n, t) in enumerate(zip(names, types)))
    if not rows:
        return spark.sql(f"SELECT {', '.join(f'CAST(NULL AS {t}) AS {n}' for n, t in zip(names, types))}"
                         ).limit(0)
    values = ", ".join("(" + ", ".join(_sql_value(v) for v in r) + ")" for r in rows)
    aliases = ", ".join(f"c{i}" for i in range(len(names)))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({aliases})")


def _local_size(df: DataFrame) -> int | None:
    """Exact byte size when the optimized plan is a local relation, else None."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        if plan.getClass().getSimpleName() != "LocalRelation":
            return None
        return int(str(plan.stats().sizeInBytes()))
    except Exception:  # noqa: BLE001  (no JVM handle, e.g. a remote session)
        return None


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      known_rows: int | None = None) -> DataFrame:
    """Hint a broadcast only when the side is proven small.

    Proof, cheapest first: ``known_rows`` given by the caller; a local relation
    whose exact size the planner knows; otherwise one bounded count
    (``limit(max_rows + 1)``).  Above the bound no hint is given and the
    planner / AQE picks a shuffle join.
    """
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= max_rows else df
    size = _local_size(df)
    if size is not None:
        return F.broadcast(df) if size <= MAX_BROADCAST_BYTES else df
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
