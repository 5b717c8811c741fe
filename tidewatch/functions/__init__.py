"""Column functions. All of them are built-in expressions; none is a Python UDF."""
