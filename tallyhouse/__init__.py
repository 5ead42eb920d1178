"""Commerce analytics on Spark: bronze mirrors, silver entities, gold marts."""
