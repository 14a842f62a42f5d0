"""Column-level functions: every one returns a ``Column`` built from
``pyspark.sql.functions`` so it stays JVM-side and composes in any plan."""
