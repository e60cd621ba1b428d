"""Column expressions: every one is built from JVM functions, none is a Python UDF."""
