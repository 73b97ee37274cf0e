"""Training-data operators on Spark.

Nothing else in ``kiln`` imports this subpackage; ``__spark_entry__.py`` adds
its queries only where it can be imported.
"""
