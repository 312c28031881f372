"""Train on BASE with CORES cores and print the area: run by test_plans in sessions of their own.

    train_job.py BASE CORES EVENT_LOG_FOLDER PARALLELISM
"""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from holdfast.plans import train_churn

base, cores, folder, parallelism = sys.argv[1:]
spark = (
    SparkSession.builder.master(f"local[{cores}]")
    .config("spark.sql.shuffle.partitions", cores)
    .config("spark.default.parallelism", parallelism)
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.compress", "false")
    .config("spark.eventLog.rolling.enabled", "false")
    .config("spark.eventLog.dir", f"file://{folder}")
    .getOrCreate()
)
report = train_churn(spark, base, tempfile.mkdtemp(prefix="models-"), layout_tasks=7)
print(report.train_rows, report.auc)
spark.stop()
