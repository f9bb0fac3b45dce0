"""Column functions; every one is a built-in expression, there is no Python UDF."""
