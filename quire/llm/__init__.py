"""Operators a training-data pipeline needs.  Nothing outside this package
imports it; ``__spark_entry__`` registers its queries only when it is there."""
