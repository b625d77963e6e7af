"""Read-only SQL across attached layers."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsheet.functions import sqlnames
from groundsheet.layer import Layer
from groundsheet.operators import guard, sqljoins


@dataclass
class Attach:
    """A layer exposed to SQL as ``table``.

    The whole layer is attached; a caller may ask for at most ``max_records`` of its rows.
    """

    table: str
    layer: Layer
    where: str = "1=1"
    max_records: int | None = None


@dataclass
class Attached:
    table: str
    df: DataFrame
    whole: DataFrame
    max_records: int | None

    def truncated(self) -> bool:
        """Whether the cap cut rows off; runs a job that stops after cap + 1 rows."""
        if self.max_records is None:
            return False
        return self.whole.limit(self.max_records + 1).count() > self.max_records


@dataclass
class SqlResult:
    df: DataFrame
    whole: DataFrame
    attached: list[Attached]
    max_rows: int | None

    def fetch(self) -> dict:
        """Rows as JSON values with ``row_count`` and ``truncated``, like a tool answer.

        Reads at most ``max_rows`` + 1 rows.
        """
        if self.max_rows is None:
            raise ValueError("an uncapped result is a DataFrame; use .df")
        rows = self.whole.limit(self.max_rows + 1).select(F.to_json(F.struct("*"))).collect()
        kept = [r[0] for r in rows[: self.max_rows]]
        return {"rows": kept, "row_count": len(kept), "truncated": len(rows) > len(kept)}


def attach(spark: SparkSession, item: Attach) -> Attached:
    """Filter, cap and expose one layer as a temp view."""
    if not guard.is_name(item.table):
        raise guard.Refused(f"{item.table!r} is not a valid table name")
    guard.check_fragment(spark, item.where)
    whole = item.layer.df.where(sqlnames.expression(spark, item.where))
    df = whole if item.max_records is None else whole.limit(item.max_records)
    df.createOrReplaceTempView(item.table)
    return Attached(item.table, df, whole, item.max_records)


def spatial_sql(
    spark: SparkSession,
    sql: str,
    attach_layers: Iterable[Attach] = (),
    max_rows: int | None = None,
) -> SqlResult:
    """Run one SELECT or WITH over the attached layers.

    The result is whole; a caller may ask for at most ``max_rows`` of its rows, and then ``fetch`` them.
    """
    items = list(attach_layers)
    guard.check_query(spark, sql, {i.table for i in items})
    attached = [attach(spark, i) for i in items]
    whole = sqljoins.query(spark, sql)
    return SqlResult(whole if max_rows is None else whole.limit(max_rows), whole, attached, max_rows)
