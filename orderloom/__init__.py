"""Orders lakehouse on Spark: bronze landing, silver loads, a gold star schema."""
