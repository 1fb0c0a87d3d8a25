"""Registered queries: a Spark callable, its SQL twin, and shared rounding."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.columns import settle


@dataclass(frozen=True)
class Query:
    """``digits`` names the floating columns and the places they are compared to."""

    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    digits: dict[str, int] = field(default_factory=dict)

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(spark, folder)
        columns = []
        for f in df.schema.fields:
            value = F.col(f"`{f.name}`")
            if f.name in self.digits:
                value = settle(value, self.digits[f.name])
            elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
                value = value.cast("bigint")
            columns.append(value.alias(f.name))
        return df.select(*columns)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.digits:
            return self.sql
        settled = ", ".join(
            f"round({c} + {float(f'1.234567e-{d + 3}')!r} + 0.0, {d}) AS {c}"
            for c, d in self.digits.items()
        )
        return f"SELECT * REPLACE ({settled}) FROM ({self.sql}) settled"


# The transaction rows of the star schema, for use in the SQL twins.
T_SQL = """
t AS (
  SELECT l.l_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS order_date,
         o.o_custkey AS customer_id, c.c_mktsegment AS customer_segment,
         n.n_name AS customer_country, r.r_name AS sales_region,
         l.l_partkey AS product_id, p.p_name AS product_name,
         p.p_type AS product_category, p.p_brand AS brand,
         CAST(l.l_quantity AS BIGINT) AS quantity,
         l.l_extendedprice / l.l_quantity AS unit_price_usd,
         l.l_extendedprice AS gross_sales_usd,
         l.l_discount * 100 AS discount_percentage,
         l.l_extendedprice * l.l_discount AS discount_amount_usd,
         l.l_extendedprice * (1 - l.l_discount) AS net_sales_usd,
         l.l_tax * 100 AS tax_rate_percentage,
         l.l_extendedprice * (1 - l.l_discount) * l.l_tax AS tax_usd,
         l.l_extendedprice * (1 - l.l_discount) * (1 + l.l_tax) AS total_order_value_usd,
         o.o_orderpriority AS payment_method, o.o_orderstatus AS order_status,
         date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS delivery_days,
         CASE WHEN l.l_returnflag = 'R' THEN 'Returned' ELSE 'No Return' END AS return_status,
         CASE WHEN l.l_returnflag = 'R' THEN l.l_linestatus END AS return_reason,
         l.l_discount > 0.075 AS coupon_used,
         CASE WHEN l.l_discount > 0.075 THEN p.p_brand END AS coupon_code,
         s.s_name AS supplier
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""


def over_t(sql: str, *ctes: str) -> str:
    """``sql`` with the transaction rows (and further CTEs) in front of it."""
    return "WITH " + ",\n".join([T_SQL, *ctes]) + "\n" + sql
