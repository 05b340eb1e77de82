"""Map the shared test tables onto operator inputs.

Every input here is derived from the tables by Spark, over whole tables,
so each query's work grows with the data:

* follow edges      lineitem: l_suppkey follows l_partkey (duplicates kept)
* order graph       an order links its customer to the customer of the next
                    order key (equi-join on o_orderkey + 1) and to the parts
                    it orders; parts (negative ids) have no out-edge
* customer chains   customers in key order, cut into chains of ``k``
* points            follower counts (1-D)
* book rows         lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ part ⋈ supplier;
                    open lines (l_linestatus = 'O') are the queries and
                    finished lines ('F') the training set
* tweets            documents rendered as tagged records
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_if_small, piece_count, stored_pieces


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def follow_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst): supplier key follows part key, one row per line item."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"))


def order_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (src, dst) edges, customer -> next customer (no self loops) and
    customer -> part (node -1 - p_partkey, always dangling), over all orders."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("src"))
    nxt = o.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("src").alias("dst"))
    people = o.join(nxt, "o_orderkey").where(F.col("src") != F.col("dst")).select("src", "dst")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (-1 - F.col("l_partkey")).alias("dst"))
    return people.unionByName(o.join(li, "o_orderkey").select("src", "dst")).distinct()


def customer_chains(spark: SparkSession, sf_dir: str, k: int = 100) -> DataFrame:
    """The reference's chain shape laid over real customer keys.

    Position p = c_custkey + 1; p links to p + 1 unless p % k == 0 (end of a
    chain) or the next customer does not exist; ends get a NULL ``dst``.
    Built with an equi-join on the key, so no window and no skew.
    """
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("src"))
    nxt = c.select(F.col("src").alias("dst"), (F.col("src") - 1).alias("prev"))
    j = c.join(nxt, c["src"] == nxt["prev"], "left")
    return j.select(
        "src",
        F.when(((F.col("src") + 1) % k) != 0, F.col("dst")).cast("bigint").alias("dst"))


SUPPLIERS = 500_000      # broadcast up to so many suppliers (key and name)


def book_rows(spark: SparkSession, sf_dir: str, piece: int = 0, pieces: int = 1) -> DataFrame:
    """Mixed-type rating rows, one per line item, with a unique row key. Orders meet
    their customers first, and names are joined last, so lines are shuffled twice
    (by order and by part) and carry keys only. Of several ``pieces``, the rows of
    the orders that fall into ``piece``."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if pieces > 1:
        li, o = (side.where(F.pmod(key, F.lit(pieces)) == piece) for side, key in ((li, "l_orderkey"), (o, "o_orderkey")))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    people = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_custkey", "c_nationkey", F.year("o_orderdate").alias("year"))
    j = (li.join(people, li.l_orderkey == people.o_orderkey).drop("o_orderkey")
         .join(p, F.col("l_partkey") == p.p_partkey)
         .join(broadcast_if_small(s, SUPPLIERS), F.col("l_suppkey") == s.s_suppkey)
         .join(broadcast_if_small(n), F.col("c_nationkey") == n.n_nationkey))
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_key"),
        F.col("c_custkey").cast("double").alias("user_id"),
        F.col("n_name").alias("location"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"),
        "year",
        F.col("s_name").alias("publisher"),
        F.col("l_linestatus").alias("status"))


def book_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book_rows(spark, sf_dir).where(F.col("status") == "O").drop("status")


def book_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book_rows(spark, sf_dir).where(F.col("status") == "F").drop("status")


def book_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(queries, training) from one materialised book-row table, so the
    six-table join runs once, for one piece of the orders after another."""
    pieces = piece_count(table(spark, sf_dir, "lineitem").count())
    rows = stored_pieces((book_rows(spark, sf_dir, i, pieces) for i in range(pieces)), "books")
    return (rows.where(F.col("status") == "O").drop("status"),
            rows.where(F.col("status") == "F").drop("status"))
