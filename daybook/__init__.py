"""daybook: a PySpark engine for daily price bars, from landed JSON to reports."""
