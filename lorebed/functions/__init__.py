"""Scalar functions: native Column expressions, and pandas UDFs where Spark has no equivalent."""
