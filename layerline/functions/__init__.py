"""Column builders. All of them stay inside Spark's generated code; there are no Python UDFs."""
