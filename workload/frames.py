"""The test tables in the roles the operators expect.

Every role takes all rows of its table:

* workspaces, items, tables, log files: nation, customer and supplier, orders, lineitem
* workspaces and items by name: customer, orders
* polls and log entries of small endpoints: events
* trigger replies and polls of a run: orders, lineitem
* load target and source: orders, and orders restated from lineitem
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_TS = "2001-01-01 00:00:00"
EVENTS_NOW = "2024-01-31 00:00:00"
THRESHOLD = 24.0
EVENTS_THRESHOLD = 48.0
PAGES_NOW = "2024-01-02 00:00:18"
PAGES_THRESHOLD = 22.0
PAGES_SINCE = "2024-01-01 00:10:00"
RETURNS_FROM_KEY = 1_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_name(number: str) -> F.Column:
    return F.concat(F.lpad(F.col(number).cast("string"), 20, "0"), F.lit(".json"))


# -- freshness ---------------------------------------------------------------------------


def region_workspaces(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("workspace_id"),
        F.concat(F.lit("WS_"), F.initcap("r_name"), F.lit("_DEV")).alias("workspace_name"),
    )


def warehouse_items(spark, sf_dir):
    """Customers; those in debt are of another type.  Suppliers are items without tables."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("workspace_id"),
        F.col("c_custkey").alias("item_id"),
        F.when(F.col("c_acctbal") < 0, "Lakehouse").otherwise("Warehouse").alias("item_type"),
        F.concat_ws("_", F.lit("WH"), "c_mktsegment", F.col("c_custkey")).alias("item_name"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("workspace_id"),
        (-1 - F.col("s_suppkey")).alias("item_id"),
        F.lit("Warehouse").alias("item_type"),
        F.concat_ws("_", F.lit("WH"), F.lit("SUPPLIER"), F.col("s_suppkey")).alias("item_name"),
    )
    return customers.unionByName(suppliers)


def order_tables(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("item_id"),
        F.col("o_orderkey").alias("table_id"),
        F.concat_ws("/", F.lit("Tables"), "o_orderstatus", F.col("o_orderkey")).alias(
            "table_path"
        ),
    )


def line_files(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("table_id"),
        file_name("l_partkey").alias("file_name"),
        F.col("l_shipdate").alias("modified"),
    )


def event_tables(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("item_id"),
        "event_type",
        F.concat(F.lit("Tables/events/"), "event_type").alias("table_path"),
    ).distinct()


def event_files(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("item_id"),
        "event_type",
        file_name("event_id").alias("file_name"),
        F.col("ts").alias("modified"),
    )


# -- names -------------------------------------------------------------------------------


def customer_workspaces(spark, sf_dir):
    name = F.concat(
        F.lit("WS_"), F.initcap("c_mktsegment"), F.lit("_N"), F.col("c_nationkey").cast("string")
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("workspace_id"),
        F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(name).alias("workspace_name"),
    )


def order_items(spark, sf_dir):
    """Names of unspecified priority have one part too many; type ``warehouse`` is no match."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("workspace_id"),
        F.col("o_orderkey").alias("item_id"),
        F.when(status == "F", "Warehouse")
        .when(status == "O", "SQLEndpoint")
        .otherwise("warehouse")
        .alias("item_type"),
        F.concat_ws(
            "_",
            F.when(status == "F", "wh").otherwise("LH"),
            F.replace("o_orderpriority", F.lit(" "), F.lit("_")),
            F.col("o_orderkey"),
        ).alias("item_name"),
    )


def page_listing(spark, sf_dir):
    """Page addresses as a folder listing: host, then path."""
    address = F.regexp_replace("url", "^https?://", "")
    rest = F.substr(address, F.instr(address, "/") + 1)
    return table(spark, sf_dir, "pages").select(
        F.substring_index(address, "/", 1).alias("item_id"),
        F.concat(F.lit("Tables/"), rest).alias("path"),
        (~rest.rlike("[.?#]")).alias("is_directory"),
    )


def page_logs(spark, sf_dir):
    """Host as item, language and scheme of the address as table."""
    address = F.regexp_replace("url", "^https?://", "")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.substring_index(address, "/", 1).alias("item_id"),
        F.concat(
            F.lit("Tables/"),
            F.substring_index(F.substring_index(address, "/", 2), "/", -1),
            F.lit("/"),
            F.substring_index("url", ":", 1),
        ).alias("table_path"),
    )


def odd_database_replies(spark, sf_dir):
    """One database per part; the kind of its reply goes by the part's size."""
    name = F.concat(F.lit('"displayName":"ProcessDB'), "p_partkey", F.lit('"'))
    bodies = {
        0: F.concat(F.lit('{"value":[{'), name, F.lit(',"properties":{"serverFqdn":null,"databaseName":null}}]}')),
        1: F.concat(F.lit('{"value":[{'), name, F.lit(',"properties":{"databaseName":"db"}}]}')),
        2: F.concat(F.lit('{"value":[{'), name, F.lit(',"properties":null}]}')),
        3: F.concat(F.lit('{"value":[{'), name, F.lit("}]}")),
        4: F.concat(F.lit('{"value":[{"displayName":null},{"displayName":{"a":1}},7,{'), name, F.lit(',"properties":{"serverFqdn":{"a":1}}}]}')),
        5: F.lit('{"value":null}'),
        6: F.lit("<html>"),
        7: F.concat(F.lit('{"value":[{'), name, F.lit(',"properties":{"serverFqdn":"a,1","databaseName":"db"}}],"more":[1]}')),
    }
    body = F.lit(None).cast("string")
    for kind, text in bodies.items():
        body = F.when(F.col("p_size") % 8 == kind, text).otherwise(body)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("workspace_id"), body.alias("body"))


def database_replies(spark, sf_dir):
    def database(name, fqdn):
        properties = F.struct(fqdn.alias("serverFqdn"), name.alias("databaseName"))
        return F.struct(name.alias("displayName"), properties.alias("properties"))

    number = F.col("p_partkey").cast("string")
    host = F.concat("p_brand", F.lit(",1433"))
    first = F.concat(F.lit("ProcessDB_"), "p_brand")
    second = F.when(
        F.col("p_type").isin("ECONOMY", "PROMO"), F.concat(F.lit("ProcessDB"), number)
    ).otherwise(F.col("p_type"))
    third = F.when(F.col("p_size") > 40, "OtherDB").otherwise(
        F.concat(F.lit("ProcessDB"), F.col("p_size").cast("string"))
    )
    databases = [
        database(first, host),
        database(second, host),
        database(third, F.lit(None).cast("string")),
    ]
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("workspace_id"),
        F.to_json(F.struct(F.array(*databases).alias("value"))).alias("body"),
    )


# -- loads -------------------------------------------------------------------------------


def restated_orders(spark, sf_dir):
    """One order per line-item order, and one more, under a new key, for its returns."""
    returned = F.col("l_returnflag") == "R"
    key = F.col("l_orderkey") + F.when(returned, RETURNS_FROM_KEY).otherwise(0)
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(key.alias("o_orderkey"))
        .agg(
            F.min("l_suppkey").alias("o_custkey"),
            F.max("l_linestatus").alias("o_orderstatus"),
            F.max("l_extendedprice").alias("o_totalprice"),
            F.max("l_shipdate").alias("o_orderdate"),
        )
        .withColumn("o_orderpriority", F.lit("RESTATED"))
    )


def repriced_orders(spark, sf_dir):
    """The finished orders at double price."""
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .withColumn("o_totalprice", F.col("o_totalprice") * 2)
    )


# -- runs --------------------------------------------------------------------------------


def event_polls(spark, sf_dir):
    body = (
        F.when(F.col("event_type") == "view", F.lit('{"progressState": "inProgress"}'))
        .when(F.col("event_type") == "click", F.col("props"))
        .when(F.col("event_type") == "signup", F.concat(F.lit("<p>"), "props", F.lit("</p>")))
        .when(F.col("value") > 100, F.lit('{"progressState": null}'))
        .otherwise(F.lit('{"progressState": "success"}'))
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("endpoint_id"),
        F.col("ts").cast("date").cast("string").alias("batch_id"),
        F.col("ts").alias("poll_ts"),
        F.col("event_id").alias("poll_no"),
        (F.col("event_type") != "error").alias("ok"),
        body.alias("body"),
    )


def order_replies(spark, sf_dir):
    priority = F.col("o_orderpriority")
    number = F.col("o_orderkey").cast("string")
    body = (
        F.when(priority == "2-HIGH", F.lit('{"queued": true}'))
        .when(priority == "3-MEDIUM", F.concat(F.lit("<html>"), number, F.lit("</html>")))
        .otherwise(F.concat(F.lit('{"batchId": "b'), number, F.lit('"}')))
    )
    failure = F.lit("connection reset by the remote host while the reply was being read: ")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("endpoint_id"),
        F.when(F.col("o_orderstatus") == "P", 409).otherwise(200).alias("http_status"),
        body.alias("body"),
        F.when(F.col("o_totalprice") > 450000, F.concat(failure, number)).alias("error"),
    )


def line_polls(spark, sf_dir):
    state = (
        F.when(F.col("l_linestatus") == "O", "inProgress")
        .when(F.col("l_returnflag") == "A", "success")
        .otherwise("failure")
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("endpoint_id"),
        F.concat(F.lit("b"), F.col("l_orderkey").cast("string")).alias("batch_id"),
        F.col("l_shipdate").alias("poll_ts"),
        F.col("l_linenumber").alias("poll_no"),
        (F.col("l_returnflag") != "R").alias("ok"),
        F.concat(F.lit('{"progressState": "'), state, F.lit('"}')).alias("body"),
    )


def event_log(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").cast("timestamp_ntz").alias("ExecutionTime"),
        F.lit("WS_EVENTS").alias("WorkspaceName"),
        F.concat(F.lit("LH_"), F.col("user_id").cast("string")).alias("EndpointName"),
        F.when(F.col("event_type") == "view", "Starting")
        .otherwise(F.col("event_type"))
        .alias("Status"),
        F.col("event_id").cast("string").alias("BatchId"),
        (F.col("value") < 1).alias("IsDryRun"),
    )
