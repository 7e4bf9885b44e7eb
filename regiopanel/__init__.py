"""Dense region-by-day indicator panels on PySpark."""
