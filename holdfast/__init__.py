"""Customer-churn data preparation and modelling on PySpark."""
