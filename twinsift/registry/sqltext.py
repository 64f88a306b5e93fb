"""Small builders for oracle SQL texts (DuckDB dialect)."""

from __future__ import annotations

from collections.abc import Sequence

from twinsift.operators.people import people_sql

PEOPLE_COLUMNS = ("id", "name", "email", "address")
LINEITEM_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
EVENTS_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def with_people(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with the people CTE (and more CTEs, comma-led)."""
    return f"WITH people AS ({people_sql('customer')}){extra_ctes}\n{body}"


def norm(col: str) -> str:
    return f"trim(lower(coalesce(CAST({col} AS VARCHAR), '')))"


def keep_one_sql(
    source: str,
    columns: Sequence[str],
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    keep: str = "first",
    tie_exclude: Sequence[str] | None = None,
) -> str:
    """Survivor per key in the library's total order: ``order_by`` (descending
    NULLS LAST for keep='last'), then the other columns ascending NULLS FIRST."""
    direction = "DESC NULLS LAST" if keep == "last" else "ASC NULLS FIRST"
    order = [f"{o} {direction}" for o in order_by]
    skip = set(tie_exclude if tie_exclude is not None else list(keys) + list(order_by))
    order += [f"{c} ASC NULLS FIRST" for c in columns if c not in skip]
    cols = ", ".join(columns)
    return (
        f"SELECT {cols} FROM (SELECT {cols}, row_number() OVER (PARTITION BY {', '.join(keys)} "
        f"ORDER BY {', '.join(order)}) AS __rn FROM {source}) WHERE __rn = 1"
    )
