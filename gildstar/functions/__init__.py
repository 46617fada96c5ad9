"""Column -> Column helpers; all stay inside Spark's own expressions."""
