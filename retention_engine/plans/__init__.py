"""Named, registered queries: each pairs a Spark plan (``fn(spark, sf_dir) -> DataFrame``) with an
independent ANSI-SQL statement of the same result (used as the correctness oracle)."""
