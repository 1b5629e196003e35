"""Dimensional warehouse loading on Spark: SCD2 history, facts, load control, checks."""
