"""One query per operator. Each takes (spark, sf_dir) and runs over whole tables."""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from holdfast.checks.views import (
    COMPLAINTS_UNTIL,
    dirty_customer,
    dirty_telco,
    table,
    telco,
    write_csv,
    write_csv_lines,
)
from holdfast.cluster import scratch_dir
from holdfast.functions.columns import finite_or_null, present
from holdfast.operators.categories import (
    category_ranking,
    encode_categories,
    fit_category_index,
    index_by_ranking,
)
from holdfast.operators.cleansing import (
    blank_to_null,
    cast_numeric,
    cleanse,
    drop_duplicate_rows,
    drop_missing_key,
    trim_strings,
)
from holdfast.operators.complaints import add_complaints, complaint_counts
from holdfast.operators.features import (
    assemble_features,
    derive_features,
    derive_sql,
    fit_preprocessing,
    index_label,
    project_features,
    query_table,
    training_medians,
)
from holdfast.operators.forest import (
    area_under_roc,
    load_models,
    save_models,
    score,
    train_forest,
)
from holdfast.operators.medians import exact_medians
from holdfast.operators.quality import (
    ReconciliationError,
    content_digest,
    null_counts,
    preview,
    reconcile,
    reconcile_content,
    row_count,
    rows_with_null,
    schema_report,
    write_reconciled,
)
from holdfast.operators.splitting import hash_split, random_split
from holdfast.plans.etl import run_etl
from holdfast.plans.scoring import score_table
from holdfast.plans.training import train_churn
from holdfast.plans.whole import run_all
from holdfast.schema import (
    CLEANED_SCHEMA,
    COMPLAINTS,
    COUNTED_TABLE,
    DERIVED_FEATURES,
    KEY,
    NUMERICAL_FEATURES,
    TELCO_SCHEMA,
    with_complaints,
)
from holdfast.sources.files import load_cleaned, read_csv, write_parquet

Query = Callable[[SparkSession, str], DataFrame]

CUSTOMER_SCHEMA = StructType(
    [
        StructField("c_custkey", LongType()),
        StructField("c_name", StringType()),
        StructField("c_nationkey", IntegerType()),
        StructField("c_acctbal", DoubleType()),
        StructField("c_mktsegment", StringType()),
    ]
)
LINE_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("n", IntegerType()),
        StructField("amt", DoubleType()),
        StructField("flag", StringType()),
    ]
)
ORDERS_EXPECTED = StructType(
    [
        StructField("o_orderkey", LongType()),
        StructField("o_custkey", IntegerType()),
        StructField("o_totalprice", StringType()),
        StructField("o_orderdate", TimestampNTZType()),
        StructField("o_clerk", StringType()),
    ]
)


# Sources and sinks


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_csv(table(spark, sf_dir, "customer"), spark)
    return read_csv(spark, path, CUSTOMER_SCHEMA)


def csv_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad numbers, short and long lines, padded and exponent numbers, thousands separators."""
    k, name = F.col("c_custkey"), F.col("c_name")
    lines = table(spark, sf_dir, "customer").select(
        F.when(k % 8 == 0, F.concat(name, F.lit(",xx,4.5,No")))
        .when(k % 8 == 1, F.concat(name, F.lit(",3")))
        .when(k % 8 == 2, F.concat(name, F.lit(",4,5.5,Yes,EXTRA")))
        .when(k % 8 == 3, F.concat(name, F.lit(",5, 7.5 ,No")))
        .when(k % 8 == 4, F.concat(name, F.lit(",9.0,1e3,Yes")))
        .when(k % 8 == 5, F.concat(name, F.lit(',6,"1,200",')))
        .when(k % 8 == 6, F.concat(name, F.lit(", , ,Yes")))
        .otherwise(F.concat(F.lit("  "), name, F.lit(" ,"), F.col("c_nationkey"), F.lit(",0.25,No")))
    )
    return read_csv(spark, write_csv_lines(lines, spark, "WRONG,header,names,here"), LINE_SCHEMA)


def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = StructType(
        [
            StructField("l_orderkey", LongType()),
            StructField("l_linenumber", IntegerType()),
            StructField("l_extendedprice", DoubleType()),
            StructField("l_discount", DoubleType()),
            StructField("l_returnflag", StringType()),
        ]
    )
    lines = load_cleaned(spark, sf_dir, declared, "lineitem.parquet")
    return lines.filter((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.05)).select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    base = scratch_dir(spark)
    write_parquet(lines, base, "lines", ["l_returnflag"])
    return load_cleaned(spark, base, lines.schema, "lines").select(*lines.columns)


def partition_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null, blank and number-like partition values: the first two come back as null, the last as text."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(k % 4 == 0, "02").when(k % 4 == 1, "").when(k % 4 == 2, F.col("c_mktsegment")).alias("part_value"),
    )
    base = scratch_dir(spark)
    write_parquet(rows, base, "parts", ["part_value"])
    return load_cleaned(spark, base, rows.schema, "parts")


def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derivation as text, over a table with the complaint count and one without."""
    customers = telco(spark, sf_dir)
    without = customers.drop(COMPLAINTS).withColumn(KEY, F.concat(KEY, F.lit("-absent")))
    texts = [project_features(query_table(df, derive_sql(df.schema))) for df in (customers, without)]
    return texts[0].unionByName(texts[1])


# Projections and scalar functions


def trimmed_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim_strings(dirty_customer(spark, sf_dir))


def blank_as_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blank_to_null(trim_strings(dirty_customer(spark, sf_dir)))


def numeric_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_numeric(dirty_customer(spark, sf_dir), NUMERICAL_FEATURES)


def daily_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_features(telco(spark, sf_dir)).select(KEY, "MonthlyCharges", "avg_daily_charge")


def complaints_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_column = telco(spark, sf_dir)
    without = derive_features(with_column.drop("NumComplaints90Days"))
    return derive_features(with_column).select(KEY, "complaints_90d").unionByName(
        without.select(F.concat(KEY, F.lit("-absent")).alias(KEY), "complaints_90d")
    )


def large_complaint_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts beyond the int range, as numbers and as text, by column and by SQL text; text that is no
    number stays missing."""
    k = F.col("c_custkey")
    number = F.when(k % 3 == 0, k * 3_000_000_000).when(k % 3 == 1, k)
    customers = table(spark, sf_dir, "customer").select(k, number.alias(COMPLAINTS))
    texts = customers.withColumn(COMPLAINTS, F.when(k % 5 == 0, "many").otherwise(F.col(COMPLAINTS).cast("string")))

    def both(df: DataFrame) -> DataFrame:
        by_sql = query_table(df, derive_sql(df.schema)).select(k, F.col("complaints_90d").alias("by_sql"))
        return derive_features(df).select(k, F.col("complaints_90d").alias("by_column")).join(by_sql, "c_custkey")

    return both(customers).withColumn("kind", F.lit("number")).unionByName(
        both(texts).withColumn("kind", F.lit("text"))
    )


def feature_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_features(derive_features(telco(spark, sf_dir)))


def present_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for columns the table lacks are skipped in casts, key check and projection."""
    orders = table(spark, sf_dir, "orders")
    kept = drop_missing_key(cast_numeric(orders, ["o_orderkey", "tenure"]), "customerID")
    return kept.select(*present(kept, ["gender", "o_orderkey", "o_orderstatus", "Contract"]))


# Filters, de-duplication, aggregations


def key_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_missing_key(blank_to_null(trim_strings(dirty_customer(spark, sf_dir))))


def null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_with_null(blank_to_null(trim_strings(dirty_customer(spark, sf_dir))), "Contract")


def whole_row_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_duplicate_rows(dirty_customer(spark, sf_dir))


def dedupe_hot_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all rows are copies of one row."""
    hot = F.col("l_orderkey") % 3 == 0
    lines = table(spark, sf_dir, "lineitem")
    return drop_duplicate_rows(
        lines.select(*[F.when(~hot, F.col(c)).alias(c) for c in ("l_orderkey", "l_linenumber", "l_shipdate")])
    )


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["customer", "orders", "lineitem", "events", "documents"]
    counts = [row_count(table(spark, sf_dir, n)).withColumn("table_name", F.lit(n)) for n in names]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def key_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = blank_to_null(trim_strings(dirty_telco(spark, sf_dir)))
    return null_counts(clean, ["customerID", "Churn", "Contract", "StreamingTV", "NotThere"])


def category_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/ranking"
    return category_ranking(table(spark, sf_dir, "part"), ["p_type", "p_brand"], path)


def wide_category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of a column with nearly as many values as rows, joined from its ranking; null comes last."""
    pair = F.concat(F.col("l_partkey"), F.lit("-"), F.col("l_suppkey"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 7 != 0, pair).alias("pair")
    )
    ranking = category_ranking(lines, ["pair"], f"{scratch_dir(spark)}/ranking")
    return index_by_ranking(lines, ranking, ["pair"]).select("l_orderkey", "l_linenumber", "pair_idx")


def auc_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact area under ROC of text length as a score for quality. The join is on unique keys."""
    scored = (
        table(spark, sf_dir, "documents")
        .select("doc_id", F.col("n_chars").cast("double").alias("score"))
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .select("score", F.col("quality").cast("double").alias("label"))
    )
    auc = area_under_roc(scored, score_col="score")
    return spark.createDataFrame([(round(auc, 9),)], "auc DOUBLE")


# Data-quality checks


def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected against actual types of `orders`, with the nulls found in the columns that exist."""
    orders = table(spark, sf_dir, "orders")
    report = schema_report(spark, orders.schema, ORDERS_EXPECTED)
    nulls = null_counts(orders, ORDERS_EXPECTED.fieldNames())
    long_form = nulls.unpivot([], nulls.columns, "column", "nulls")
    return report.join(F.broadcast(long_form), "column", "left").withColumnRenamed("column", "column_name")


def telco_schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleansed customer table against the declared raw schema: the two integers are double now."""
    clean = cleanse(dirty_telco(spark, sf_dir))
    report = schema_report(spark, clean.schema, TELCO_SCHEMA)
    nulls = null_counts(clean, clean.columns)
    long_form = nulls.unpivot([], nulls.columns, "column", "nulls")
    return report.join(F.broadcast(long_form), "column", "left").withColumnRenamed("column", "column_name")


def write_and_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, written, found = write_reconciled(
        table(spark, sf_dir, "orders"), scratch_dir(spark), "orders_copy", ["o_orderstatus"]
    )
    return spark.createDataFrame([(written, found)], "rows_written LONG, rows_read_back LONG")


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table after a replacement that went through and one whose rows were written, but refused; with versions
    left where they were written and with versions moved."""
    orders, base, found = table(spark, sf_dir, "orders"), scratch_dir(spark), []

    def refuse(folder: str) -> None:
        reconcile(-1, spark.read.parquet(folder))

    for settle in (True, False):
        name = f"orders_{settle}"
        write_parquet(orders.where("o_orderkey % 2 = 0"), base, name, settle=settle)
        write_parquet(orders, base, name, ["o_orderstatus"], settle=settle)
        with contextlib.suppress(ReconciliationError):
            write_parquet(orders.where("o_orderkey % 2 = 1"), base, name, verify=refuse, settle=settle)
        found.append(load_cleaned(spark, base, orders.schema, name).select(*orders.columns, F.lit(settle).alias("settled")))
    return found[0].unionByName(found[1])


def content_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the digest taken at the write says of the table read back, and of tables with as many rows in which two
    rows have swapped a value, one row stands twice, or a row has another partition value."""
    orders = table(spark, sf_dir, "orders")
    parts = ["o_orderstatus"]
    seen = orders.agg(*content_digest(orders, parts)).first().asDict()
    base = scratch_dir(spark)
    write_reconciled(orders, base, "orders_copy", parts)
    first = orders.agg(F.min(F.struct("o_orderkey", "o_custkey")), F.max(F.struct("o_orderkey", "o_custkey"))).first()
    key = F.col("o_orderkey")
    low, high = (F.lit(r["o_orderkey"]) for r in first)
    swapped = F.when(key == low, F.lit(first[1]["o_custkey"])).when(key == high, F.lit(first[0]["o_custkey"]))
    tables = {
        "read back": load_cleaned(spark, base, orders.schema, "orders_copy"),
        "swapped": orders.withColumn("o_custkey", F.coalesce(swapped, "o_custkey")),
        "twice": orders.where(key != high).unionByName(orders.where(key == low)),
        "moved": orders.withColumn("o_orderstatus", F.when(key == low, "?").otherwise(F.col("o_orderstatus"))),
    }
    facts = []
    for name, df in tables.items():
        try:
            facts.append((name, reconcile_content(seen, df, parts), True))
        except ReconciliationError:
            facts.append((name, df.count(), False))
    return spark.createDataFrame(facts, "table_name STRING, row_count LONG, same BOOLEAN")


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "orders"), 5, ["o_orderkey"])


# Features


def complaint_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = complaint_counts(table(spark, sf_dir, "events"), COMPLAINTS_UNTIL)
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return add_complaints(customers, counts, "c_custkey")


def derived_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_features(telco(spark, sf_dir))


def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = index_label(cleanse(dirty_telco(spark, sf_dir)))
    return labelled.select(KEY, "MonthlyCharges", "Churn", "label")


def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequency index of two columns; null gets the index after the last value."""
    parts = table(spark, sf_dir, "part").withColumn(
        "p_type", F.when(F.col("p_partkey") % 9 != 0, F.col("p_type"))
    )
    model = fit_category_index(parts, ["p_type", "p_brand"])
    return model.transform(parts).select("p_partkey", "p_type_idx", "p_brand_idx")


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").withColumn(
        "p_type", F.when(F.col("p_partkey") % 9 != 0, F.col("p_type"))
    )
    encoded, _ = encode_categories(parts, ["p_type"])
    return encoded.select("p_partkey", F.inline(_filled_slots("p_type_enc")))


def wide_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot of a column with nearly as many values as rows, none of which the driver holds, in a sparse vector."""
    pair = F.concat(F.col("l_partkey"), F.lit("-"), F.col("l_suppkey"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 7 != 0, pair).alias("pair")
    )
    encoded, _ = encode_categories(lines, ["pair"], held_values=100)
    slots = F.unwrap_udt("pair_enc")
    pairs = F.arrays_zip(slots["indices"].alias("pos"), slots["values"].alias("value"))
    return encoded.select("l_orderkey", "l_linenumber", slots["size"].alias("slots"), F.inline(pairs))


def _filled_slots(vector: str) -> Column:
    """(pos, value) of a vector's slots other than zero."""
    slots = F.transform(vector_to_array(vector), lambda x, i: F.struct(i.alias("pos"), x.alias("value")))
    return F.filter(slots, lambda slot: slot["value"] != 0)


def cleaned_base(spark: SparkSession, sf_dir: str) -> str:
    """The customer table cleansed and written, as the training step finds it."""
    base = scratch_dir(spark)
    write_parquet(cleanse(telco(spark, sf_dir)), base, "telco_cleaned", ["Churn"])
    return base


def _derived_from(spark: SparkSession, base: str) -> DataFrame:
    return derive_features(load_cleaned(spark, base, with_complaints(CLEANED_SCHEMA, marked=True)))


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived_from(spark, cleaned_base(spark, sf_dir))


def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-zero slots of every customer's vector; everything is fitted on the training side only.

    A slot filled with the approximate median shows as null here; `imputed_medians` checks its value.
    """
    rows = _derived(spark, sf_dir)
    train, _ = hash_split(rows)
    vectors = fit_preprocessing(train).transform(rows)
    filled = F.array(*[finite_or_null(c).isNull() for c in (*NUMERICAL_FEATURES, *DERIVED_FEATURES)])
    value = F.when(~F.coalesce(F.get("filled", "pos"), F.lit(False)), F.col("value"))
    return vectors.select(KEY, filled.alias("filled"), F.inline(_filled_slots("features"))).select(
        KEY, "pos", value.alias("value")
    )


def assembled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and vector length of all labelled rows, fitted on all of them."""
    rows, _ = assemble_features(_derived(spark, sf_dir))
    return rows.select(KEY, "label", F.size(vector_to_array("features")).alias("features"))


def imputed_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per number: training rows with and without a value, and the fill value."""
    train, _ = hash_split(_derived(spark, sf_dir))
    fills = training_medians(train, [*NUMERICAL_FEATURES, *DERIVED_FEATURES])
    facts = []
    for name in (*NUMERICAL_FEATURES, *DERIVED_FEATURES):
        value = finite_or_null(name)
        facts.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(value).alias("present"),
                F.count_if(value.isNull()).alias("missing"),
                F.lit(fills[name]).alias("median"),
            )
        )
    return train.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))


def hash_split_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = hash_split(table(spark, sf_dir, "customer"), "c_custkey")
    return train.select("c_custkey", F.lit("train").alias("side")).unionByName(
        test.select("c_custkey", F.lit("test").alias("side"))
    )


def hash_split_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows at ratios that are no whole percents."""
    customers = table(spark, sf_dir, "customer")
    ratios = [(0.805, "0.805"), (0.996, "0.996"), (0.004, "0.004")]
    sides = [hash_split(customers, "c_custkey", r)[0].select("c_custkey", F.lit(name).alias("ratio")) for r, name in ratios]
    return sides[0].unionByName(sides[1]).unionByName(sides[2])


def random_split_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side of every row, and of every copy of rows that repeat, in two layouts."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    key = F.when(F.col("l_orderkey") % 3 > 0, F.col("l_orderkey")).alias("k")
    # As few tasks as the table is read in, and more of them, that hold the copies of a row together or apart.
    many = lines.repartition(max(13, 2 * lines.rdd.getNumPartitions()), "l_returnflag", "l_orderkey")
    found = []
    for name, df in (("few", lines.select(key, "l_returnflag")), ("many", many.select(key, "l_returnflag"))):
        for side, rows in zip(("train", "test"), random_split(df), strict=True):
            counted = rows.groupBy("k", "l_returnflag").agg(F.count(F.lit(1)).alias("copies"))
            found.append(counted.withColumn("side", F.lit(side)).withColumn("layout", F.lit(name)))
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


def exact_medians_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians of columns with ties, holes and a wide spread, all at once."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice",
        "l_quantity",
        F.when(F.col("l_orderkey") % 3 > 0, F.col("l_tax")).alias("l_tax"),
        F.expr("pow(10.0D, l_linenumber * 40 - 150) * l_partkey").alias("spread"),
    )
    return spark.createDataFrame(list(exact_medians(lines, lines.columns).items()), "column_name STRING, median DOUBLE")


def area_by_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact area under ROC over all lines, a third of which share one score."""
    score = F.when(F.col("l_orderkey") % 3 == 0, 0.0).otherwise(F.col("l_extendedprice"))
    lines = table(spark, sf_dir, "lineitem").select(score.alias("score"), (F.col("l_returnflag") == "R").cast("double").alias("label"))
    return spark.createDataFrame([(round(area_under_roc(lines, "score"), 12),)], "area DOUBLE")


def random_split_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whatever the sides are, every row is on exactly one of them."""
    train, test = random_split(table(spark, sf_dir, "orders").select("o_orderkey"))
    sides = train.withColumn("in_train", F.lit(1)).unionByName(test.withColumn("in_train", F.lit(0)))
    per_key = sides.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("times"), F.sum("in_train").alias("in_train"))
    return per_key.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("times") > 1).alias("rows_on_both_sides"),
        (F.sum("in_train") > 0.75 * F.count(F.lit(1))).alias("train_is_larger"),
    )


# Modelling


def _fitted(spark: SparkSession, sf_dir: str):
    base = cleaned_base(spark, sf_dir)
    train, test = hash_split(index_label(_derived_from(spark, base)))
    preprocessing = fit_preprocessing(train)
    vectors = preprocessing.transform(train).select("label", "features")
    return preprocessing, train_forest(vectors), preprocessing.transform(test)


def _marked(rows: DataFrame) -> DataFrame:
    """Adds a two-valued feature that tells most of the label: churn, turned round for every fourth key."""
    churned, turned = F.col("Churn") == "Yes", F.col(KEY).cast("long") % 4 == 0
    return rows.withColumn("mark", (churned != turned).cast("double"))


def _single_split(rows: DataFrame) -> tuple[PipelineModel, PipelineModel]:
    """One tree with one split on a two-valued feature, of all rows: its leaves are the groups' shares."""
    preprocessing = Pipeline(
        stages=[VectorAssembler(inputCols=["mark"], outputCol="features", handleInvalid="error")]
    ).fit(rows)
    vectors = preprocessing.transform(rows)
    return preprocessing, train_forest(vectors, num_trees=1, max_depth=1, bootstrap=False)


def _churn_share(probability: str = "probability") -> Column:
    return F.round(F.get(vector_to_array(probability), F.lit(1)), 9)


def single_split_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf probabilities and labels of a tree with one split, by the value it splits on."""
    rows = index_label(_marked(_derived(spark, sf_dir)))
    preprocessing, forest = _single_split(rows)
    scored = score(forest, preprocessing.transform(rows))
    return scored.groupBy("mark").agg(
        F.count(F.lit(1)).alias("customers"),
        F.min(_churn_share()).alias("lowest"),
        F.max(_churn_share()).alias("highest"),
    )


def single_split_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scored by a tree with one split that has seen the training rows only."""
    train, test = hash_split(index_label(_marked(_derived(spark, sf_dir))))
    preprocessing, forest = _single_split(train)
    scored = score(forest, preprocessing.transform(test))
    return scored.select(KEY, "label", "prediction", _churn_share().alias("churn_probability"))


def forest_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, forest, _ = _fitted(spark, sf_dir)
    model = forest.stages[-1]
    facts = (
        model.getNumTrees,
        model.numClasses,
        model.numFeatures,
        max(tree.depth for tree in model.trees) <= 10,
    )
    return spark.createDataFrame([facts], "trees INT, classes INT, features INT, depth_within_limit BOOLEAN")


def forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored test rows; what must hold for every row whatever the trees look like."""
    _, forest, test = _fitted(spark, sf_dir)
    scored = score(forest, test)
    p = vector_to_array("probability")
    return scored.select(
        KEY,
        "label",
        F.size(vector_to_array("rawPrediction")).alias("raw_scores"),
        (F.abs(F.get(p, F.lit(0)) + F.get(p, F.lit(1)) - 1) < 1e-9).alias("sums_to_one"),
        (F.col("prediction") == (F.get(p, F.lit(1)) > F.get(p, F.lit(0))).cast("double")).alias("is_likeliest"),
    )


def forest_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area against the rank sum of the same scores, and what the test rows hold.

    Scores are counted first and then summed up within ranges of scores, so no task sees all of them.
    """
    _, forest, test = _fitted(spark, sf_dir)
    scored = score(forest, test).select("label", F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("score"))
    counts = scored.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    counts = counts.withColumn("range", F.floor(F.col("score") * 10))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    ranges = counts.groupBy("range").agg(F.sum("neg").alias("in_range"))
    ranges = ranges.withColumn("below", F.coalesce(F.sum("in_range").over(before.orderBy("range")), F.lit(0)))
    inside = F.sum("neg").over(before.partitionBy("range").orderBy("score"))
    lower = counts.withColumn("inside", F.coalesce(inside, F.lit(0))).join(ranges, "range")
    wins = F.sum(F.col("pos") * (F.col("below") + F.col("inside") + F.col("neg") / 2))
    area = area_under_roc(score(forest, test))
    return lower.agg(
        F.sum(F.col("pos") + F.col("neg")).alias("test_rows"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        (F.abs(wins / (F.sum("pos") * F.sum("neg")) - F.lit(area)) < 1e-9).alias("areas_agree"),
    )


def saved_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both models saved and loaded again predict the same for every test row."""
    preprocessing, forest, test = _fitted(spark, sf_dir)
    base = scratch_dir(spark)
    save_models(base, preprocessing, forest)
    again, forest_again = load_models(base)
    mine = score(forest, test).select(
        *preprocessing_inputs(test), F.col("prediction").alias("mine"), F.col("probability").alias("p")
    )
    both = score(forest_again, again.transform(mine))
    same = (F.col("mine") == F.col("prediction")) & (vector_to_array("p") == vector_to_array("probability"))
    return both.select(KEY, same.alias("same"))


def preprocessing_inputs(df: DataFrame) -> list[str]:
    """The columns a table had before preprocessing added its own."""
    added = ("_filled", "_idx", "_enc")
    return [c for c in df.columns if c != "features" and not c.endswith(added)]


# Whole steps


def cleansed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse(dirty_customer(spark, sf_dir))


def cleansed_telco(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse(dirty_telco(spark, sf_dir))


def etl_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark)
    run_etl(spark, write_csv(dirty_telco(spark, sf_dir), spark), base)
    return load_cleaned(spark, base)


ODD_COUNTS = ("abc", "2.0", "3000000000", "", "7", "x1")


def _odd_lines(spark: SparkSession, sf_dir: str) -> str:
    """A customer file with unreadable, large, fractional and blank complaint counts, and some unreadable charges."""
    k = F.col("c_custkey")
    counts = F.element_at(F.array(*[F.lit(text) for text in ODD_COUNTS]), (k % len(ODD_COUNTS) + 1).cast("int"))
    values = {
        KEY: k.cast("string"),
        "tenure": F.when(k % 4 == 0, "two").when(k % 4 == 1, "9.5").otherwise("12"),
        "MonthlyCharges": F.when(k % 5 == 0, "n/a").otherwise("20.5"),
        "TotalCharges": F.lit("1e3"),
        "Churn": F.when(k % 2 == 0, "Yes").otherwise("No"),
        COMPLAINTS: counts,
    }
    names = with_complaints(TELCO_SCHEMA).fieldNames()
    line = F.concat_ws(",", *[values.get(name, F.lit("")) for name in names])
    return write_csv_lines(table(spark, sf_dir, "customer").select(line), spark, ",".join(names))


def unreadable_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per column: the fields that held text and became null, as the run reports them."""
    report = run_etl(spark, _odd_lines(spark, sf_dir), scratch_dir(spark))
    return spark.createDataFrame(list(report.unreadable.items()), "column_name STRING, unreadable LONG")


def unreadable_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaint counts after the whole run: none reads as 0 that was not blank."""
    base = scratch_dir(spark)
    run_etl(spark, _odd_lines(spark, sf_dir), base)
    return _derived_from(spark, base).select(KEY, "complaints_90d", "tenure", "MonthlyCharges")


def etl_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = run_etl(spark, write_csv(dirty_telco(spark, sf_dir), spark), scratch_dir(spark))
    facts = (
        report.rows_read,
        report.rows_without_key,
        report.duplicate_rows,
        report.rows_written,
        report.rows_read_back,
        report.null_labels,
        report.columns_checked,
    )
    return spark.createDataFrame(
        [facts],
        "rows_read LONG, rows_without_key LONG, duplicate_rows LONG, rows_written LONG,"
        " rows_read_back LONG, null_labels LONG, columns_checked INT",
    )


def churn_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = cleaned_base(spark, sf_dir)
    report = train_churn(spark, base, f"{base}/models")
    facts = (report.train_rows, report.test_rows, report.num_features, 0.0 <= report.auc <= 1.0)
    return spark.createDataFrame([facts], "train_rows LONG, test_rows LONG, features INT, auc_in_range BOOLEAN")


def trained_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole training step, with a forest of one split that SQL gives as well: sizes of both sides and the area as
    reported, and the test rows scored by the models it saved."""
    base = scratch_dir(spark)
    rows = _marked(cleanse(telco(spark, sf_dir)))
    write_parquet(rows, base, "telco_cleaned", ["Churn"])
    schema = StructType([*CLEANED_SCHEMA.fields, StructField("mark", DoubleType())])
    stump = functools.partial(train_forest, num_trees=1, max_depth=1, bootstrap=False)
    report = train_churn(spark, base, f"{base}/models", ["mark"], [], schema, learner=stump)
    preprocessing, forest = load_models(f"{base}/models")
    _, test = hash_split(index_label(derive_features(load_cleaned(spark, base, schema))))
    return score(forest, preprocessing.transform(test)).select(
        KEY,
        "label",
        "prediction",
        _churn_share().alias("churn_probability"),
        F.lit(report.train_rows).alias("train_rows"),
        F.lit(report.test_rows).alias("test_rows"),
        F.lit(round(report.auc, 9)).alias("area"),
    )


def csv_to_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark)
    etl, trained = run_all(spark, write_csv(dirty_telco(spark, sf_dir), spark), base, f"{base}/models")
    facts = (etl.rows_written, trained.train_rows, trained.test_rows)
    return spark.createDataFrame([facts], "rows_written LONG, train_rows LONG, test_rows LONG")


def csv_to_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complaint count of a file with the 22nd column, after the whole run."""
    base = scratch_dir(spark)
    customers = telco(spark, sf_dir).select(*with_complaints(TELCO_SCHEMA).fieldNames())
    run_all(spark, write_csv(customers, spark), base, f"{base}/models")
    return _derived_from(spark, base).select(KEY, "complaints_90d")


def events_to_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complaint count of an event table, after the whole run on a file without it."""
    base = scratch_dir(spark)
    path = write_csv(telco(spark, sf_dir).drop(COMPLAINTS), spark)
    run_all(spark, path, base, f"{base}/models", table(spark, sf_dir, "events"), COMPLAINTS_UNTIL)
    counted = load_cleaned(spark, base, with_complaints(CLEANED_SCHEMA), COUNTED_TABLE)
    return derive_features(counted).select(KEY, "complaints_90d")


def batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer, labelled or not, gets one prediction from the saved models; these hold one split, so
    the probabilities are shares that SQL gives as well."""
    base = cleaned_base(spark, sf_dir)
    save_models(f"{base}/models", *_single_split(index_label(_marked(_derived_from(spark, base)))))
    customers = _marked(load_cleaned(spark, base, with_complaints(CLEANED_SCHEMA))).drop("Churn")
    path = score_table(customers, f"{base}/models", base)
    p = F.col("churn_probability")
    return spark.read.parquet(path).select(
        KEY,
        F.col("prediction").isin(0.0, 1.0).alias("is_class"),
        ((p >= 0) & (p <= 1)).alias("is_probability"),
        (F.col("prediction") == (p > 0.5).cast("double")).alias("agrees"),
        F.round(p, 9).alias("churn_probability"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        csv_round_trip,
        csv_permissive,
        parquet_scan,
        partitioned_write,
        partition_values,
        sql_view,
        trimmed_strings,
        blank_as_null,
        numeric_casts,
        daily_charges,
        complaints_default,
        large_complaint_counts,
        feature_projection,
        present_columns,
        key_not_null,
        null_rows,
        whole_row_dedupe,
        dedupe_hot_row,
        row_counts,
        key_null_counts,
        category_ranks,
        auc_by_length,
        schema_check,
        telco_schema_check,
        write_and_reconcile,
        replaced_table,
        content_differences,
        unreadable_fields,
        unreadable_complaints,
        preview_rows,
        complaint_count,
        derived_features,
        label_index,
        category_index,
        wide_category_index,
        one_hot,
        wide_one_hot,
        feature_vectors,
        assembled_features,
        imputed_medians,
        hash_split_sides,
        hash_split_ratios,
        random_split_cover,
        random_split_sides,
        exact_medians_by_column,
        area_by_price,
        forest_training,
        forest_scores,
        forest_auc,
        single_split_forest,
        single_split_scores,
        saved_models,
        cleansed_customers,
        cleansed_telco,
        etl_table,
        etl_report,
        churn_training,
        trained_scores,
        csv_to_models,
        csv_to_features,
        events_to_features,
        batch_scores,
    )
}
