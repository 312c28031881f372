"""Customer tables derived from the test tables, once in Spark and once as SQL for the comparison."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.cluster import scratch_dir
from holdfast.schema import COMPLAINT_DAYS, TELCO_SCHEMA

COMPLAINTS_UNTIL = datetime(2024, 1, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _twice_if(condition: Column) -> Column:
    return F.explode(F.when(condition, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))


def dirty_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded and blank texts, unparsable numbers and repeated rows, all from one scan."""
    k = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .withColumn("copy", _twice_if(k % 10 == 0))
        .select(
            F.when(k % 50 == 0, F.lit("   "))
            .otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
            .alias("customerID"),
            F.when(k % 7 == 0, F.lit(""))
            .otherwise(F.concat(F.col("c_mktsegment"), F.lit(" ")))
            .alias("Contract"),
            F.when(k % 11 == 0, F.lit("n/a"))
            .otherwise(F.col("c_acctbal").cast("string"))
            .alias("MonthlyCharges"),
        )
    )


DIRTY_SQL = """
dirty AS (
  SELECT CASE WHEN c_custkey % 50 = 0 THEN '   ' ELSE '  ' || c_name || ' ' END AS "customerID",
         CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment || ' ' END AS "Contract",
         CASE WHEN c_custkey % 11 = 0 THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS "MonthlyCharges"
  FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 10 = 0)
)"""


def telco(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer table of the declared shape plus the complaint count.

    Orders before 2001 describe the customer, orders after tell churn. Orders and events are counted
    per customer before any join, so a customer with very many of them costs no more than others.
    """
    before = F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")

    def orders_with(condition: Column) -> Column:
        return F.count_if(before & condition)

    orders = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.min(F.when(before, F.col("o_orderdate"))).alias("first_order"),
            F.round(F.sum(F.when(before, F.col("o_totalprice"))), 2).alias("spent"),
            F.count_if(~before).alias("later"),
            F.count_if(before).alias("n"),
            orders_with(F.col("o_orderstatus") == "F").alias("n_f"),
            orders_with(F.col("o_orderstatus") == "O").alias("n_o"),
            orders_with(F.col("o_orderstatus") == "P").alias("n_p"),
            orders_with(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
            F.max(F.when(before, F.col("o_orderpriority"))).alias("priority"),
        )
    )
    until = F.lit(COMPLAINTS_UNTIL.isoformat(sep=" ")).cast("timestamp_ntz")
    recent = (F.col("ts") >= until - F.expr(f"INTERVAL {COMPLAINT_DAYS} DAYS")) & (F.col("ts") < until)
    events = table(spark, sf_dir, "events")
    activity = events.groupBy(F.col("user_id").alias("active_user")).agg(
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.nullif(F.count_if((F.col("event_type") == "error") & recent), F.lit(0)).alias("complaints"),
    )
    rows = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(activity, F.col("c_custkey") == F.col("active_user"), "left")
    )

    def yes_no(condition: Column) -> Column:
        return F.when(condition, "Yes").otherwise("No")

    tenure = F.datediff(F.lit("2001-01-01").cast("date"), F.col("first_order").cast("date"))
    months = F.greatest(tenure.cast("double") / F.lit(30.0), F.lit(1.0))
    return rows.select(
        F.col("c_custkey").cast("string").alias("customerID"),
        F.when(F.col("c_custkey") % 2 == 0, "Female").otherwise("Male").alias("gender"),
        (F.col("c_acctbal") < 0).cast("int").alias("SeniorCitizen"),
        yes_no(F.col("n_urgent") > 1).alias("Partner"),
        yes_no(F.col("n_regionkey") < 2).alias("Dependents"),
        tenure.alias("tenure"),
        yes_no(F.col("n") > 5).alias("PhoneService"),
        F.when(F.col("n") > 12, "Yes").when(F.col("n") > 5, "No").otherwise("No phone service")
        .alias("MultipleLines"),
        F.col("n_name").alias("InternetService"),
        yes_no(F.col("n_f") > 2).alias("OnlineSecurity"),
        yes_no(F.col("n_o") > 2).alias("OnlineBackup"),
        yes_no(F.col("n_p") > 2).alias("DeviceProtection"),
        yes_no(F.col("n_urgent") > 2).alias("TechSupport"),
        F.when(F.col("views") > 12, "Yes").when(F.col("views") <= 12, "No").alias("StreamingTV"),
        F.when(F.col("clicks") > 12, "Yes").when(F.col("clicks") <= 12, "No").alias("StreamingMovies"),
        F.col("c_mktsegment").alias("Contract"),
        yes_no(F.col("purchases") > 0).alias("PaperlessBilling"),
        F.col("priority").alias("PaymentMethod"),
        (F.col("spent") / months).alias("MonthlyCharges"),
        F.col("spent").alias("TotalCharges"),
        F.when(F.col("later") > 0, "No").otherwise("Yes").alias("Churn"),
        F.col("complaints").cast("int").alias("NumComplaints90Days"),
    )


TELCO_SQL = """
order_facts AS (
  SELECT o_custkey,
         min(CASE WHEN early THEN o_orderdate END) AS first_order,
         round(sum(CASE WHEN early THEN o_totalprice END), 2) AS spent,
         count(*) FILTER (WHERE NOT early) AS later,
         count(*) FILTER (WHERE early) AS n,
         count(*) FILTER (WHERE early AND o_orderstatus = 'F') AS n_f,
         count(*) FILTER (WHERE early AND o_orderstatus = 'O') AS n_o,
         count(*) FILTER (WHERE early AND o_orderstatus = 'P') AS n_p,
         count(*) FILTER (WHERE early AND o_orderpriority = '1-URGENT') AS n_urgent,
         max(CASE WHEN early THEN o_orderpriority END) AS priority
  FROM (SELECT *, o_orderdate < TIMESTAMP '2001-01-01' AS early FROM orders)
  GROUP BY o_custkey
),
event_facts AS (
  SELECT user_id,
         count(*) FILTER (WHERE event_type = 'view') AS views,
         count(*) FILTER (WHERE event_type = 'click') AS clicks,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
         nullif(count(*) FILTER (WHERE event_type = 'error' AND ts >= TIMESTAMP '2023-11-02'
                                 AND ts < TIMESTAMP '2024-01-31'), 0) AS complaints
  FROM events GROUP BY user_id
),
telco AS (
  SELECT CAST(c_custkey AS VARCHAR) AS "customerID",
         CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         CAST(c_acctbal < 0 AS INTEGER) AS "SeniorCitizen",
         CASE WHEN n_urgent > 1 THEN 'Yes' ELSE 'No' END AS "Partner",
         CASE WHEN n_regionkey < 2 THEN 'Yes' ELSE 'No' END AS "Dependents",
         CAST(date_diff('day', CAST(first_order AS DATE), DATE '2001-01-01') AS INTEGER) AS tenure,
         CASE WHEN n > 5 THEN 'Yes' ELSE 'No' END AS "PhoneService",
         CASE WHEN n > 12 THEN 'Yes' WHEN n > 5 THEN 'No' ELSE 'No phone service' END AS "MultipleLines",
         n_name AS "InternetService",
         CASE WHEN n_f > 2 THEN 'Yes' ELSE 'No' END AS "OnlineSecurity",
         CASE WHEN n_o > 2 THEN 'Yes' ELSE 'No' END AS "OnlineBackup",
         CASE WHEN n_p > 2 THEN 'Yes' ELSE 'No' END AS "DeviceProtection",
         CASE WHEN n_urgent > 2 THEN 'Yes' ELSE 'No' END AS "TechSupport",
         CASE WHEN views > 12 THEN 'Yes' WHEN views <= 12 THEN 'No' END AS "StreamingTV",
         CASE WHEN clicks > 12 THEN 'Yes' WHEN clicks <= 12 THEN 'No' END AS "StreamingMovies",
         c_mktsegment AS "Contract",
         CASE WHEN purchases > 0 THEN 'Yes' ELSE 'No' END AS "PaperlessBilling",
         priority AS "PaymentMethod",
         spent / greatest(CAST(date_diff('day', CAST(first_order AS DATE), DATE '2001-01-01') AS DOUBLE)
                          / CAST(30.0 AS DOUBLE), CAST(1.0 AS DOUBLE)) AS "MonthlyCharges",
         spent AS "TotalCharges",
         CASE WHEN later > 0 THEN 'No' ELSE 'Yes' END AS "Churn",
         CAST(complaints AS INTEGER) AS "NumComplaints90Days"
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN order_facts ON c_custkey = o_custkey
  LEFT JOIN event_facts ON c_custkey = user_id
)"""


def dirty_telco(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table as texts, with padding, blanks, bad numbers, lost keys and repeated rows."""
    clean = telco(spark, sf_dir).select(*TELCO_SCHEMA.fieldNames())
    k = F.col("customerID").cast("long")
    dirt = {
        "customerID": F.when(k % 50 == 0, "   ").otherwise(F.concat(F.lit("  "), "customerID", F.lit(" "))),
        "Contract": F.when(k % 7 == 0, "").otherwise(F.concat("Contract", F.lit(" "))),
        "MonthlyCharges": F.when(k % 11 == 0, "n/a").otherwise(F.col("MonthlyCharges").cast("string")),
        "tenure": F.when(k % 13 == 0, "unknown").otherwise(F.col("tenure").cast("string")),
        "Churn": F.when(k % 17 == 0, " ").otherwise(F.col("Churn")),
    }
    return clean.withColumn("copy", _twice_if(k % 10 == 0)).select(
        *[dirt.get(c, F.col(c).cast("string")).alias(c) for c in clean.columns]
    )


DIRTY_TELCO_SQL = f"""
{TELCO_SQL},
dirty_telco AS (
  SELECT * REPLACE (
    CASE WHEN k % 50 = 0 THEN '   ' ELSE '  ' || "customerID" || ' ' END AS "customerID",
    CASE WHEN k % 7 = 0 THEN '' ELSE "Contract" || ' ' END AS "Contract",
    CASE WHEN k % 11 = 0 THEN NULL ELSE "MonthlyCharges" END AS "MonthlyCharges",
    CASE WHEN k % 13 = 0 THEN NULL ELSE tenure END AS tenure,
    CASE WHEN k % 17 = 0 THEN ' ' ELSE "Churn" END AS "Churn")
  FROM (SELECT *, CAST("customerID" AS BIGINT) AS k FROM telco
        UNION ALL SELECT *, CAST("customerID" AS BIGINT) AS k FROM telco WHERE CAST("customerID" AS BIGINT) % 10 = 0)
),
cleaned_telco AS (
  SELECT DISTINCT nullif(trim("customerID"), '') AS "customerID", gender,
         CAST("SeniorCitizen" AS DOUBLE) AS "SeniorCitizen", "Partner", "Dependents",
         CAST(tenure AS DOUBLE) AS tenure, "PhoneService", "MultipleLines", "InternetService",
         "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
         "StreamingMovies", nullif(trim("Contract"), '') AS "Contract", "PaperlessBilling",
         "PaymentMethod", "MonthlyCharges", "TotalCharges", nullif(trim("Churn"), '') AS "Churn"
  FROM dirty_telco WHERE trim("customerID") <> ''
)"""


def write_csv(df: DataFrame, spark: SparkSession) -> str:
    """Write a CSV folder with headers and unchanged outer spaces into the scratch space."""
    path = f"{scratch_dir(spark)}/raw"
    df.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


def write_csv_lines(lines: DataFrame, spark: SparkSession, header: str) -> str:
    """Write ready-made CSV lines (one string column) as they are, with a header in every file."""
    path = f"{scratch_dir(spark)}/raw"
    lines.toDF(header).write.csv(
        path, header=True, sep="\u0001", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return path
