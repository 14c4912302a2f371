"""Clinical star analytics on PySpark."""
