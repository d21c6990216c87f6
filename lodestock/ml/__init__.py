"""Features, models and their evaluation on ``pyspark.ml``."""
