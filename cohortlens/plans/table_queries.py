"""Sources and sinks: written with one engine call, read back, compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators.profiling import category_mix, missing_profile
from cohortlens.plans.registry import Query, over_t
from cohortlens.session import scratch_path
from cohortlens.sources.contract import DATE, FLAG, FLOAT, INTEGER, TEXT, Contract
from cohortlens.sources.tables import read_features, write_report, write_table
from cohortlens.sources.transactions import (
    read_cells,
    read_transactions,
    star_transactions,
)

_CSV_COLUMNS = {
    "order_id": TEXT,
    "order_date": DATE,
    "quantity": INTEGER,
    "net_sales_usd": FLOAT,
    "coupon_used": FLAG,
    "return_reason": TEXT,
}


def _csv_transactions(spark, folder):
    path = scratch_path(spark, "transactions-csv")
    write_table(star_transactions(spark, folder, list(_CSV_COLUMNS)), path, "csv")
    typed, _ = read_transactions(spark, path, Contract(_CSV_COLUMNS))
    return typed


def _csv_rejects(spark, folder):
    """Order lines written as text; prices lose their cents, flags are no flags."""
    path = scratch_path(spark, "lines-csv")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_extendedprice", "l_returnflag", "l_linestatus"
    )
    write_table(lines, path, "csv")
    contract = Contract(
        {"l_extendedprice": INTEGER, "l_returnflag": FLAG, "l_linestatus": FLOAT}
    )
    _, rejects = read_transactions(spark, path, contract)
    return rejects.groupBy("column", "value", "reason").agg(F.count(F.lit(1)).alias("n"))


def _texts_back(spark, folder):
    """Whole texts with quotes and line breaks, written as CSV and read again."""
    path = scratch_path(spark, "texts-csv")
    write_table(
        spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source"),
        path,
        "csv",
    )
    cells, _ = read_cells(spark, path, multi_line=True, missing_cells=("",))
    return cells.select(F.col("doc_id").cast("bigint"), F.md5("text").alias("text_md5"), "source")


def _malformed_texts(spark, folder):
    """All lines of the documents as records under a header of two cells: few have two.

    Each comma separates cells of its line, and all cells are quoted, so lines that are
    blank or hold quotes or carriage returns are records like the others.
    """
    path = scratch_path(spark, "lines-text")
    lines = spark.read.parquet(f"{folder}/documents.parquet").select(
        F.explode(F.split("text", "\n")).alias("line")
    )
    doubled = F.replace("line", F.lit('"'), F.lit('""'))
    record = F.concat(F.lit('"'), F.replace(doubled, F.lit(","), F.lit('","')), F.lit('"'))
    # the low 33 bits number the rows of a partition: the first of a file brings the header
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.when(first, F.lit("first,second\n")).otherwise(F.lit(""))
    lines.select(F.concat(header, record).alias("value")).write.text(path)
    _, records = read_cells(spark, path, multi_line=True)
    commas = F.length("record") - F.length(F.replace("record", F.lit(",")))
    return records.groupBy(commas.cast("bigint").alias("commas")).agg(F.count(F.lit(1)).alias("n"))


def _csv_truncated(spark, folder):
    path = scratch_path(spark, "prices-csv")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_extendedprice"
    )
    write_table(lines, path, "csv")
    typed, _ = read_transactions(
        spark, path, Contract({"l_orderkey": INTEGER, "l_extendedprice": INTEGER})
    )
    return typed


def _features_back(spark, folder):
    path = scratch_path(spark, "orders-csv")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    write_table(
        orders.select("o_orderkey", F.col("o_orderdate").cast("date"), "o_orderpriority"),
        path,
        "csv",
    )
    df = read_features(
        spark,
        path,
        "csv",
        "o_orderkey bigint, o_orderdate string, o_orderpriority string",
        parse_dates=("o_orderdate", "o_orderpriority"),
    )
    return df


def _table_back(spark, folder):
    path = scratch_path(spark, "customers")
    write_table(spark.read.parquet(f"{folder}/customer.parquet"), path)
    return read_features(spark, path)


def _report_back(spark, folder):
    path = scratch_path(spark, "report")
    df = star_transactions(
        spark, folder, ["product_category", "quantity", "net_sales_usd", "return_reason"]
    )
    write_report(
        {
            "category_mix": category_mix(df),
            "missing": missing_profile(df).select("column", "null_count"),
        },
        path,
    )
    mix = spark.read.json(f"{path}/category_mix").select(
        F.lit("category_mix").alias("section"),
        F.col("product_category").alias("entry"),
        F.col("volume").alias("n"),
    )
    missing = spark.read.json(f"{path}/missing").select(
        F.lit("missing").alias("section"), F.col("column").alias("entry"), F.col("null_count").alias("n")
    )
    return mix.unionByName(missing)


QUERIES = [
    Query(
        "read_transactions",
        _csv_transactions,
        over_t(
            "SELECT CAST(order_id AS VARCHAR) AS order_id, order_date, quantity, "
            "net_sales_usd, coupon_used, return_reason FROM t"
        ),
        {"net_sales_usd": 4},
    ),
    Query(
        "read_transactions_rejects",
        _csv_rejects,
        """SELECT 'l_returnflag' AS "column", l_returnflag AS value, 'not a valid flag' AS reason,
                  count(*) AS n FROM lineitem GROUP BY l_returnflag
           UNION ALL
           SELECT 'l_linestatus', l_linestatus, 'not a valid float', count(*)
           FROM lineitem GROUP BY l_linestatus""",
    ),
    Query(
        "read_cells_texts",
        _texts_back,
        "SELECT doc_id, md5(text) AS text_md5, source FROM documents",
    ),
    Query(
        "read_cells_malformed",
        _malformed_texts,
        r"""SELECT length(line) - length(replace(line, ',', '')) AS commas, count(*) AS n
            FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
            WHERE length(line) - length(replace(line, ',', '')) <> 1
            GROUP BY 1""",
    ),
    Query(
        "read_transactions_truncated",
        _csv_truncated,
        "SELECT l_orderkey, CAST(trunc(l_extendedprice) AS BIGINT) AS l_extendedprice FROM lineitem",
    ),
    Query(
        "read_features",
        _features_back,
        "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, "
        "CAST(NULL AS DATE) AS o_orderpriority FROM orders",
    ),
    Query(
        "write_table",
        _table_back,
        "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, "
        "c_mktsegment FROM customer",
    ),
    Query(
        "write_report",
        _report_back,
        over_t(
            """SELECT 'category_mix' AS section, product_category AS entry,
                      CAST(sum(quantity) AS BIGINT) AS n FROM t GROUP BY product_category
               UNION ALL
               SELECT 'missing', entry, n FROM (
                 UNPIVOT (SELECT count(*) FILTER (WHERE product_category IS NULL) AS product_category,
                                 count(*) FILTER (WHERE quantity IS NULL) AS quantity,
                                 count(*) FILTER (WHERE net_sales_usd IS NULL) AS net_sales_usd,
                                 count(*) FILTER (WHERE return_reason IS NULL) AS return_reason
                          FROM t) ON COLUMNS(*) INTO NAME entry VALUE n)"""
        ),
    ),
]
