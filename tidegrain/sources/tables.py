"""Access to the stored tables and the store-shaped views on them."""

from __future__ import annotations

import hashlib
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrain.functions.numbers import money
from tidegrain.session import shared_dir


#: Staged tables written by this application.
_BUILT: set[str] = set()


class Tables:
    """Lazy readers for one data folder; every property is a plan, nothing is read before an action."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        #: Short name of the folder, for staged tables and views.
        self.tag = hashlib.md5(self.root.encode()).hexdigest()[:12]

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def staged(self, name: str, build, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Table built once per application and data folder, written to the shared folder, then read back.

        The written table cuts the lineage and survives the loss of an executor; a second job reuses it.
        """
        path = f"{shared_dir(self.spark)}/{self.spark.sparkContext.applicationId}/{self.tag}/{name}"
        if path not in _BUILT:
            writer = build().write.mode("overwrite").option("partitionOverwriteMode", "static")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.parquet(path)
            _BUILT.add(path)  # only after a whole write: a failed one is built again
        return self.spark.read.parquet(path)

    # -- store-shaped views -------------------------------------------------------------------

    @cached_property
    def customers(self) -> DataFrame:
        c, n = self.raw("customer"), self.raw("nation")
        key, name = F.col("c_custkey"), F.col("c_name")
        provider = (
            F.when(key % 4 == 0, "gmail.com")
            .when(key % 4 == 1, "yahoo.com")
            .otherwise(F.concat(F.lower("c_mktsegment"), F.lit(".com")))
        )
        return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
            key.alias("customer_id"),
            F.split_part(name, F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part(name, F.lit("#"), F.lit(2)).alias("last_name"),
            F.col("n_name").alias("country"),
            F.col("n_regionkey").cast("bigint").alias("region_id"),
            F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("state"),
            F.when(key % 6 == 0, name).alias("company"),
            F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@"), provider).alias("email"),
            F.concat(
                F.lit("("), F.lpad((key % 1000).cast("string"), 3, "0"), F.lit(") 555-"),
                F.lpad((key % 10000).cast("string"), 4, "0"),
            ).alias("phone"),
            F.when(key % 3 == 0, F.concat(F.lit("fax-"), key.cast("string"))).alias("fax"),
            (key % 10).alias("support_rep_id"),
        )

    @cached_property
    def invoices(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("invoice_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("invoice_date"),
            money("o_totalprice").alias("total"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("invoice_id"),
            F.col("l_linenumber").cast("bigint").alias("line_no"),
            F.col("l_partkey").alias("track_id"),
            F.col("l_suppkey").alias("artist_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            money("l_extendedprice").alias("line_total"),
        )

    @cached_property
    def tracks(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size").cast("bigint")
        return self.raw("part").select(
            key.alias("track_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("genre"),
            F.col("p_brand").alias("media_type"),
            F.concat("p_brand", F.lit("/"), size.cast("string")).alias("album"),
            (size * 12000 + (key % 60) * 1000).alias("milliseconds"),
            (size * 200000).alias("bytes"),
            money("p_retailprice").alias("unit_price"),
            F.when(key % 4 != 0, F.col("p_brand")).alias("composer"),
        )

    @cached_property
    def employees(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("employee_id"),
            F.col("s_name").alias("name"),
            F.when(key != 0, F.floor((key - 1) / 3).cast("bigint")).alias("reports_to"),
            F.make_date((F.lit(1992) + key % 30).cast("int"), (F.lit(1) + key % 12).cast("int"), F.lit(1)).alias("hire_date"),
            F.when(key % 5 != 0, F.concat("s_name", F.lit("@x.com"))).alias("email"),
            F.col("s_nationkey").cast("bigint").alias("nation_id"),
        )

    @cached_property
    def artists(self) -> DataFrame:
        """Employees as artists, and for every third one a newcomer under a negative id, who has sold nothing yet."""
        new = self.employees.where("employee_id % 3 = 0").select(
            (-F.col("employee_id") - 1).alias("employee_id"), F.when(F.col("employee_id") % 2 == 1, F.concat("name", F.lit(" (new)"))).alias("name"))
        return self.employees.select("employee_id", "name").unionByName(new)

    @cached_property
    def invoices_by_country(self) -> DataFrame:
        """Invoices with the billing country: the fact meets the narrow key-country pair."""
        keys = self.customers.select("customer_id", "country")
        return self.invoices.join(keys, "customer_id")
