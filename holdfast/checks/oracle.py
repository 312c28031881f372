"""SQL that must give the same rows as the query of the same name."""

from __future__ import annotations

from holdfast.checks.views import DIRTY_SQL, DIRTY_TELCO_SQL, TELCO_SQL
from holdfast.schema import CATEGORICAL_FEATURES, DERIVED_FEATURES, NUMERICAL_FEATURES, TELCO_SCHEMA

_HEAD = "CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT)"
_SPLIT = _HEAD.format(key='"customerID"')
_CUSTOMER_SPLIT = _HEAD.format(key="CAST(c_custkey AS VARCHAR)")
# Ratios of 2^32 hash values: 0.8, 0.805, 0.996, 0.004.
_TRAIN_BELOW = 3435973837
_RATIO_BELOW = {"0.805": 3457448673, "0.996": 4277787427, "0.004": 17179869}
_DAILY = '"MonthlyCharges" / CAST(30.0 AS DOUBLE)'
_SHARE = """round(avg(CAST("Churn" = 'Yes' AS DOUBLE)), 9)"""
_MARKED = """marked AS (SELECT *, CAST(("Churn" = 'Yes') <> (CAST("customerID" AS BIGINT) % 4 = 0) AS DOUBLE) AS mark
                FROM telco)"""
_COLUMNS = ", ".join(f'"{c}"' for c in CATEGORICAL_FEATURES)
_POSITIONS = ", ".join(f"('{c}', {i})" for i, c in enumerate(CATEGORICAL_FEATURES))
_NUMBERS = [
    'CAST("SeniorCitizen" AS DOUBLE)',
    "CAST(tenure AS DOUBLE)",
    '"MonthlyCharges"',
    '"TotalCharges"',
    _DAILY,
    'CAST(coalesce("NumComplaints90Days", 0) AS DOUBLE)',
]
_TELCO_REPORT = " UNION ALL ".join(
    f"SELECT '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS expected, '{kind}' AS actual,"
    f" '{'ok' if kind == f.dataType.simpleString() else 'type'}' AS status,"
    f' count(*) - count("{f.name}") AS nulls FROM cleaned_telco'
    for f in TELCO_SCHEMA.fields
    for kind in ["double" if f.name in NUMERICAL_FEATURES else "string"]
)

# Category values ranked on training rows, with the vector slot each one takes.
_SLOTS = f"""
train AS (SELECT * FROM telco WHERE {_SPLIT} < {_TRAIN_BELOW}),
ranked AS (
  SELECT col, v, row_number() OVER (PARTITION BY col ORDER BY count(*) DESC, v) - 1 AS idx
  FROM (UNPIVOT (SELECT {_COLUMNS} FROM train) ON {_COLUMNS} INTO NAME col VALUE v)
  GROUP BY col, v
),
starts AS (
  SELECT col, {len(_NUMBERS)} + coalesce(sum(size) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING
                                                         AND 1 PRECEDING), 0) AS start
  FROM (SELECT col, count(*) AS size FROM ranked GROUP BY col)
  JOIN (VALUES {_POSITIONS}) AS p(col, ord) USING (col)
),
slots AS (SELECT col, v, CAST(start + idx AS INTEGER) AS pos FROM ranked JOIN starts USING (col))"""

_NUMBER_SLOTS = "\nUNION ALL\n".join(
    f'SELECT "customerID", {i} AS pos, {n} AS value FROM telco' for i, n in enumerate(_NUMBERS)
)
_NUMBER_FACTS = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS column_name, count({n}) AS present, count(*) - count({n}) AS missing,"
    f" CAST(quantile_disc({n}, 0.5) AS DOUBLE) AS median FROM train"
    for name, n in zip((*NUMERICAL_FEATURES, *DERIVED_FEATURES), _NUMBERS)
)

ORACLE: dict[str, str] = {
    "csv_round_trip": "SELECT * FROM customer",
    "csv_permissive": """
        SELECT CASE WHEN c_custkey % 8 = 7 THEN '  ' || c_name || ' ' ELSE c_name END AS id,
               CASE c_custkey % 8 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 5 WHEN 5 THEN 6
                    WHEN 7 THEN c_nationkey END AS n,
               CASE c_custkey % 8 WHEN 0 THEN CAST(4.5 AS DOUBLE) WHEN 2 THEN 5.5 WHEN 3 THEN 7.5
                    WHEN 4 THEN 1000 WHEN 7 THEN 0.25 END AS amt,
               CASE c_custkey % 8 WHEN 0 THEN 'No' WHEN 2 THEN 'Yes' WHEN 3 THEN 'No' WHEN 4 THEN 'Yes'
                    WHEN 6 THEN 'Yes' WHEN 7 THEN 'No' END AS flag
        FROM customer""",
    "parquet_scan": """
        SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
        WHERE l_returnflag = 'R' AND l_discount >= CAST(0.05 AS DOUBLE)""",
    "partitioned_write": "SELECT * FROM lineitem",
    "partition_values": """
        SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '02' WHEN 2 THEN c_mktsegment END AS part_value
        FROM customer""",
    "sql_view": f"""
        WITH {TELCO_SQL}
        SELECT "customerID", {_DAILY} AS avg_daily_charge,
               coalesce("NumComplaints90Days", 0) AS complaints_90d,
               "Churn", "MonthlyCharges", "TotalCharges", tenure FROM telco
        UNION ALL
        SELECT "customerID" || '-absent', {_DAILY}, 0, "Churn", "MonthlyCharges", "TotalCharges", tenure
        FROM telco""",
    "trimmed_strings": f"""
        WITH {DIRTY_SQL}
        SELECT trim("customerID") AS "customerID", trim("Contract") AS "Contract",
               trim("MonthlyCharges") AS "MonthlyCharges" FROM dirty""",
    "blank_as_null": f"""
        WITH {DIRTY_SQL}
        SELECT nullif(trim("customerID"), '') AS "customerID", nullif(trim("Contract"), '') AS "Contract",
               nullif(trim("MonthlyCharges"), '') AS "MonthlyCharges" FROM dirty""",
    "numeric_casts": f"""
        WITH {DIRTY_SQL}
        SELECT "customerID", "Contract", TRY_CAST("MonthlyCharges" AS DOUBLE) AS "MonthlyCharges" FROM dirty""",
    "daily_charges": f"""
        WITH {TELCO_SQL}
        SELECT "customerID", "MonthlyCharges", {_DAILY} AS avg_daily_charge FROM telco""",
    "complaints_default": f"""
        WITH {TELCO_SQL}
        SELECT "customerID", coalesce("NumComplaints90Days", 0) AS complaints_90d FROM telco
        UNION ALL SELECT "customerID" || '-absent', 0 FROM telco""",
    "large_complaint_counts": """
        WITH c AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_custkey * 3000000000
                                     WHEN 1 THEN c_custkey END AS n FROM customer)
        SELECT c_custkey, coalesce(n, 0) AS by_column, coalesce(n, 0) AS by_sql, 'number' AS kind FROM c
        UNION ALL
        SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN coalesce(n, 0) END,
               CASE WHEN c_custkey % 5 <> 0 THEN coalesce(n, 0) END, 'text' FROM c""",
    "feature_projection": f"""
        WITH {TELCO_SQL}
        SELECT "customerID", {_DAILY} AS avg_daily_charge,
               coalesce("NumComplaints90Days", 0) AS complaints_90d,
               "Churn", "MonthlyCharges", "TotalCharges", tenure FROM telco""",
    "present_columns": "SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, o_orderstatus FROM orders",
    "key_not_null": f"""
        WITH {DIRTY_SQL}
        SELECT trim("customerID") AS "customerID", nullif(trim("Contract"), '') AS "Contract",
               nullif(trim("MonthlyCharges"), '') AS "MonthlyCharges" FROM dirty WHERE trim("customerID") <> ''""",
    "null_rows": f"""
        WITH {DIRTY_SQL}
        SELECT nullif(trim("customerID"), '') AS "customerID", CAST(NULL AS VARCHAR) AS "Contract",
               nullif(trim("MonthlyCharges"), '') AS "MonthlyCharges" FROM dirty WHERE trim("Contract") = ''""",
    "whole_row_dedupe": f"WITH {DIRTY_SQL} SELECT DISTINCT * FROM dirty",
    "dedupe_hot_row": """
        SELECT DISTINCT CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey END AS l_orderkey,
               CASE WHEN l_orderkey % 3 <> 0 THEN l_linenumber END AS l_linenumber,
               CASE WHEN l_orderkey % 3 <> 0 THEN l_shipdate END AS l_shipdate FROM lineitem""",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}"
        for n in ("customer", "orders", "lineitem", "events", "documents")
    ),
    "key_null_counts": f"""
        WITH {DIRTY_TELCO_SQL}
        SELECT count(*) FILTER (WHERE trim("customerID") = '') AS "customerID",
               count(*) FILTER (WHERE trim("Churn") = '') AS "Churn",
               count(*) FILTER (WHERE trim("Contract") = '') AS "Contract",
               count(*) FILTER (WHERE "StreamingTV" IS NULL) AS "StreamingTV" FROM dirty_telco""",
    "category_ranks": """
        SELECT col AS "column", v AS value, count(*) AS n,
               row_number() OVER (PARTITION BY col ORDER BY count(*) DESC, v) - 1 AS index
        FROM (UNPIVOT (SELECT p_type, p_brand FROM part) ON p_type, p_brand INTO NAME col VALUE v)
        GROUP BY col, v""",
    "auc_by_length": """
        WITH ranked AS (
          SELECT quality, rank() OVER (ORDER BY n_chars)
                 + (count(*) OVER (PARTITION BY n_chars) - 1) / CAST(2.0 AS DOUBLE) AS r
          FROM documents JOIN labels USING (doc_id)
        ), s AS (
          SELECT sum(r) FILTER (WHERE quality = 1) AS rank_sum,
                 CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE) AS pos,
                 CAST(count(*) FILTER (WHERE quality = 0) AS DOUBLE) AS neg FROM ranked
        )
        SELECT round((rank_sum - pos * (pos + 1) / 2) / (pos * neg), 9) AS auc FROM s""",
    "schema_check": """
        SELECT column_name, expected, actual, status, nulls
        FROM (VALUES ('o_orderkey', 'bigint', 'bigint', 'ok'), ('o_custkey', 'int', 'bigint', 'type'),
                     ('o_totalprice', 'string', 'double', 'type'),
                     ('o_orderdate', 'timestamp_ntz', 'timestamp_ntz', 'ok'),
                     ('o_clerk', 'string', NULL, 'missing')) AS e(column_name, expected, actual, status)
        LEFT JOIN (
          SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS nulls FROM orders
          UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey) FROM orders
          UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM orders
          UNION ALL SELECT 'o_orderdate', count(*) - count(o_orderdate) FROM orders
        ) USING (column_name)""",
    "telco_schema_check": f"""
        WITH {DIRTY_TELCO_SQL} {_TELCO_REPORT}""",
    "write_and_reconcile": "SELECT count(*) AS rows_written, count(*) AS rows_read_back FROM orders",
    "replaced_table": "SELECT * FROM orders CROSS JOIN (VALUES (true), (false)) AS s(settled)",
    "content_differences": """
        SELECT table_name, count(*) AS row_count, any_value(same) AS same FROM orders
        CROSS JOIN (VALUES ('read back', true), ('swapped', false), ('twice', false), ('moved', false)) AS t(table_name, same)
        GROUP BY table_name""",
    "unreadable_fields": """
        SELECT 'SeniorCitizen' AS column_name, CAST(0 AS BIGINT) AS unreadable
        UNION ALL SELECT 'tenure', count(*) FILTER (WHERE c_custkey % 4 < 2) FROM customer
        UNION ALL SELECT 'MonthlyCharges', count(*) FILTER (WHERE c_custkey % 5 = 0) FROM customer
        UNION ALL SELECT 'TotalCharges', 0
        UNION ALL SELECT 'NumComplaints90Days', count(*) FILTER (WHERE c_custkey % 6 IN (0, 1, 5)) FROM customer""",
    "unreadable_complaints": """
        SELECT CAST(c_custkey AS VARCHAR) AS "customerID",
               CASE c_custkey % 6 WHEN 2 THEN 3000000000 WHEN 3 THEN 0 WHEN 4 THEN 7 END AS complaints_90d,
               CASE WHEN c_custkey % 4 >= 2 THEN CAST(12 AS DOUBLE) END AS tenure,
               CASE WHEN c_custkey % 5 > 0 THEN CAST(20.5 AS DOUBLE) END AS "MonthlyCharges" FROM customer""",
    "random_split_sides": """
        WITH k AS (SELECT CASE WHEN l_orderkey % 3 > 0 THEN l_orderkey END AS k, l_returnflag FROM lineitem),
        t AS (SELECT *, row_number() OVER (PARTITION BY k, l_returnflag) - 1 AS n,
                     coalesce(length(CAST(k AS VARCHAR)) || ':' || CAST(k AS VARCHAR), '-')
                     || length(l_returnflag) || ':' || l_returnflag AS row_text FROM k),
        s AS (SELECT k, l_returnflag, CASE WHEN CAST('0x' || substr(md5('42 ' || n || ' ' || row_text), 1, 8) AS BIGINT)
                     < 3435973837 THEN 'train' ELSE 'test' END AS side FROM t)
        SELECT k, l_returnflag, count(*) AS copies, side, layout
        FROM s CROSS JOIN (VALUES ('few'), ('many')) AS l(layout) GROUP BY k, l_returnflag, side, layout""",
    "exact_medians_by_column": """
        WITH l AS (SELECT l_extendedprice, l_quantity, CASE WHEN l_orderkey % 3 > 0 THEN l_tax END AS l_tax,
                          pow(CAST(10 AS DOUBLE), l_linenumber * 40 - 150) * l_partkey AS spread FROM lineitem)
        SELECT 'l_extendedprice' AS column_name, CAST(quantile_disc(l_extendedprice, 0.5) AS DOUBLE) AS median FROM l
        UNION ALL SELECT 'l_quantity', quantile_disc(l_quantity, 0.5) FROM l
        UNION ALL SELECT 'l_tax', quantile_disc(l_tax, 0.5) FROM l
        UNION ALL SELECT 'spread', quantile_disc(spread, 0.5) FROM l""",
    "area_by_price": """
        WITH s AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS score,
                          l_returnflag = 'R' AS hit FROM lineitem),
        r AS (SELECT hit, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / CAST(2.0 AS DOUBLE) AS r
              FROM s),
        t AS (SELECT sum(r) FILTER (WHERE hit) AS rank_sum, CAST(count(*) FILTER (WHERE hit) AS DOUBLE) AS pos,
                     CAST(count(*) FILTER (WHERE NOT hit) AS DOUBLE) AS neg FROM r)
        SELECT round((rank_sum - pos * (pos + 1) / 2) / (pos * neg), 12) AS area FROM t""",
    "preview_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "complaint_count": """
        SELECT c_custkey, n AS "NumComplaints90Days" FROM customer LEFT JOIN (
          SELECT user_id, count(*) AS n FROM events
          WHERE event_type = 'error' AND ts >= TIMESTAMP '2023-11-02' AND ts < TIMESTAMP '2024-01-31'
          GROUP BY user_id) ON c_custkey = user_id""",
    "derived_features": f"""
        WITH {TELCO_SQL}
        SELECT *, {_DAILY} AS avg_daily_charge, coalesce("NumComplaints90Days", 0) AS complaints_90d
        FROM telco""",
    "label_index": f"""
        WITH {DIRTY_TELCO_SQL}
        SELECT "customerID", "MonthlyCharges", "Churn",
               CAST(CASE "Churn" WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 END AS DOUBLE) AS label
        FROM cleaned_telco WHERE "Churn" IN ('No', 'Yes')""",
    "category_index": """
        WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_type END AS p_type, p_brand FROM part),
        t AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS idx FROM p
              WHERE p_type IS NOT NULL GROUP BY p_type),
        b AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS idx FROM p GROUP BY p_brand)
        SELECT p_partkey, CAST(coalesce(t.idx, (SELECT count(*) FROM t)) AS DOUBLE) AS p_type_idx,
               CAST(b.idx AS DOUBLE) AS p_brand_idx
        FROM p LEFT JOIN t USING (p_type) LEFT JOIN b USING (p_brand)""",
    "wide_category_index": """
        WITH l AS (SELECT l_orderkey, l_linenumber,
                          CASE WHEN l_partkey % 7 <> 0 THEN l_partkey || '-' || l_suppkey END AS pair FROM lineitem),
        t AS (SELECT pair, row_number() OVER (ORDER BY count(*) DESC, pair) - 1 AS idx FROM l
              WHERE pair IS NOT NULL GROUP BY pair)
        SELECT l_orderkey, l_linenumber, CAST(coalesce(t.idx, (SELECT count(*) FROM t)) AS DOUBLE) AS pair_idx
        FROM l LEFT JOIN t USING (pair)""",
    "one_hot": """
        WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_type END AS p_type FROM part),
        t AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS idx FROM p
              WHERE p_type IS NOT NULL GROUP BY p_type)
        SELECT p_partkey, CAST(t.idx AS INTEGER) AS pos, CAST(1 AS DOUBLE) AS value
        FROM p JOIN t USING (p_type)""",
    "wide_one_hot": """
        WITH l AS (SELECT l_orderkey, l_linenumber,
                          CASE WHEN l_partkey % 7 <> 0 THEN l_partkey || '-' || l_suppkey END AS pair FROM lineitem),
        t AS (SELECT pair, row_number() OVER (ORDER BY count(*) DESC, pair) - 1 AS idx FROM l
              WHERE pair IS NOT NULL GROUP BY pair)
        SELECT l_orderkey, l_linenumber, CAST((SELECT count(*) FROM t) AS INTEGER) AS slots, CAST(idx AS INTEGER) AS pos,
               CAST(1 AS DOUBLE) AS value FROM l JOIN t USING (pair)""",
    "feature_vectors": f"""
        WITH {TELCO_SQL}, {_SLOTS}
        SELECT * FROM (
          {_NUMBER_SLOTS}
          UNION ALL
          SELECT "customerID", pos, CAST(1.0 AS DOUBLE) AS value
          FROM (UNPIVOT (SELECT "customerID", {_COLUMNS} FROM telco) ON {_COLUMNS} INTO NAME col VALUE v)
          JOIN slots USING (col, v)
        ) WHERE value IS NULL OR value <> 0""",
    "assembled_features": f"""
        WITH {TELCO_SQL},
        found AS (SELECT DISTINCT col, v
                  FROM (UNPIVOT (SELECT {_COLUMNS} FROM telco) ON {_COLUMNS} INTO NAME col VALUE v))
        SELECT "customerID", CAST(CASE "Churn" WHEN 'Yes' THEN 1 ELSE 0 END AS DOUBLE) AS label,
               CAST({len(_NUMBERS)} + (SELECT count(*) FROM found) AS INTEGER) AS features FROM telco""",
    "imputed_medians": f"WITH {TELCO_SQL}, train AS (SELECT * FROM telco WHERE {_SPLIT} < {_TRAIN_BELOW}) {_NUMBER_FACTS}",
    "hash_split_sides": f"""
        SELECT c_custkey, CASE WHEN {_CUSTOMER_SPLIT} < {_TRAIN_BELOW}
                               THEN 'train' ELSE 'test' END AS side FROM customer""",
    "hash_split_ratios": " UNION ALL ".join(
        f"SELECT c_custkey, '{ratio}' AS ratio FROM customer WHERE {_CUSTOMER_SPLIT} < {below}"
        for ratio, below in _RATIO_BELOW.items()
    ),
    "random_split_cover": """
        SELECT count(*) AS rows, CAST(0 AS BIGINT) AS rows_on_both_sides, true AS train_is_larger FROM orders""",
    "forest_training": f"""
        WITH {TELCO_SQL}, labelled AS (SELECT * FROM telco WHERE {_SPLIT} < {_TRAIN_BELOW}),
        found AS (SELECT DISTINCT col, v
                  FROM (UNPIVOT (SELECT {_COLUMNS} FROM labelled) ON {_COLUMNS} INTO NAME col VALUE v))
        SELECT 50 AS trees, 2 AS classes, CAST({len(_NUMBERS)} + count(*) AS INTEGER) AS features,
               true AS depth_within_limit FROM found""",
    "forest_scores": f"""
        WITH {TELCO_SQL}
        SELECT "customerID", CAST(CASE "Churn" WHEN 'Yes' THEN 1 ELSE 0 END AS DOUBLE) AS label,
               2 AS raw_scores, true AS sums_to_one, true AS is_likeliest
        FROM telco WHERE {_SPLIT} >= {_TRAIN_BELOW}""",
    "forest_auc": f"""
        WITH {TELCO_SQL}
        SELECT count(*) AS test_rows, count(*) FILTER (WHERE "Churn" = 'Yes') AS positives,
               count(*) FILTER (WHERE "Churn" = 'No') AS negatives, true AS areas_agree
        FROM telco WHERE {_SPLIT} >= {_TRAIN_BELOW}""",
    "single_split_forest": f"""
        WITH {TELCO_SQL}, {_MARKED}
        SELECT mark, count(*) AS customers, {_SHARE} AS lowest, {_SHARE} AS highest FROM marked GROUP BY mark""",
    "single_split_scores": f"""
        WITH {TELCO_SQL}, {_MARKED},
        leaves AS (SELECT mark, {_SHARE} AS share FROM marked WHERE {_SPLIT} < {_TRAIN_BELOW} GROUP BY mark)
        SELECT "customerID", CAST("Churn" = 'Yes' AS DOUBLE) AS label, CAST(share > 0.5 AS DOUBLE) AS prediction,
               share AS churn_probability
        FROM marked JOIN leaves USING (mark) WHERE {_SPLIT} >= {_TRAIN_BELOW}""",
    "saved_models": f"""
        WITH {TELCO_SQL} SELECT "customerID", true AS same FROM telco WHERE {_SPLIT} >= {_TRAIN_BELOW}""",
    "cleansed_customers": f"""
        WITH {DIRTY_SQL}
        SELECT DISTINCT nullif(trim("customerID"), '') AS "customerID", nullif(trim("Contract"), '') AS "Contract",
               TRY_CAST(trim("MonthlyCharges") AS DOUBLE) AS "MonthlyCharges"
        FROM dirty WHERE trim("customerID") <> ''""",
    "cleansed_telco": f"WITH {DIRTY_TELCO_SQL} SELECT * FROM cleaned_telco",
    "etl_table": f"WITH {DIRTY_TELCO_SQL} SELECT * FROM cleaned_telco",
    "etl_report": f"""
        WITH {DIRTY_TELCO_SQL},
        facts AS (SELECT count(*) AS rows_read, count(*) FILTER (WHERE trim("customerID") = '') AS rows_without_key
                  FROM dirty_telco),
        kept AS (SELECT count(*) AS rows_written, count(*) FILTER (WHERE "Churn" IS NULL) AS null_labels
                 FROM cleaned_telco)
        SELECT rows_read, rows_without_key, rows_read - rows_without_key - rows_written AS duplicate_rows,
               rows_written, rows_written AS rows_read_back, null_labels, 20 AS columns_checked FROM facts, kept""",
    "churn_training": f"""
        WITH {TELCO_SQL}, {_SLOTS}
        SELECT count(*) FILTER (WHERE {_SPLIT} < {_TRAIN_BELOW}) AS train_rows,
               count(*) FILTER (WHERE {_SPLIT} >= {_TRAIN_BELOW}) AS test_rows,
               CAST({len(_NUMBERS)} + (SELECT count(*) FROM slots) AS INTEGER) AS features,
               true AS auc_in_range FROM telco""",
    "trained_scores": f"""
        WITH {TELCO_SQL}, {_MARKED},
        sides AS (SELECT *, {_SPLIT} < {_TRAIN_BELOW} AS in_train FROM marked),
        leaves AS (SELECT mark, {_SHARE} AS share FROM sides WHERE in_train GROUP BY mark),
        scored AS (SELECT "customerID", "Churn" = 'Yes' AS churned, share FROM sides JOIN leaves USING (mark)
                   WHERE NOT in_train),
        ranked AS (SELECT *, rank() OVER (ORDER BY share) + (count(*) OVER (PARTITION BY share) - 1) / CAST(2.0 AS DOUBLE)
                   AS r FROM scored),
        facts AS (SELECT sum(r) FILTER (WHERE churned) AS rank_sum, CAST(count(*) FILTER (WHERE churned) AS DOUBLE) AS pos,
                         CAST(count(*) FILTER (WHERE NOT churned) AS DOUBLE) AS neg, count(*) AS test_rows,
                         (SELECT count(*) FROM sides WHERE in_train) AS train_rows FROM ranked)
        SELECT "customerID", CAST(churned AS DOUBLE) AS label, CAST(share > 0.5 AS DOUBLE) AS prediction,
               share AS churn_probability, train_rows, test_rows,
               round((rank_sum - pos * (pos + 1) / 2) / (pos * neg), 9) AS area FROM scored, facts""",
    "csv_to_models": f"""
        WITH {DIRTY_TELCO_SQL}
        SELECT count(*) AS rows_written,
               count(*) FILTER (WHERE "Churn" IS NOT NULL AND {_SPLIT} < {_TRAIN_BELOW}) AS train_rows,
               count(*) FILTER (WHERE "Churn" IS NOT NULL AND {_SPLIT} >= {_TRAIN_BELOW}) AS test_rows
        FROM cleaned_telco""",
    "csv_to_features": f"""
        WITH {TELCO_SQL} SELECT "customerID", coalesce("NumComplaints90Days", 0) AS complaints_90d FROM telco""",
    "events_to_features": f"""
        WITH {TELCO_SQL} SELECT "customerID", coalesce("NumComplaints90Days", 0) AS complaints_90d FROM telco""",
    "batch_scores": f"""
        WITH {TELCO_SQL}, {_MARKED}, leaves AS (SELECT mark, {_SHARE} AS share FROM marked GROUP BY mark)
        SELECT "customerID", true AS is_class, true AS is_probability, true AS agrees, share AS churn_probability
        FROM marked JOIN leaves USING (mark)""",
}
