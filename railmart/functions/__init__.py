"""Column expressions; every function maps Column to Column and stays inside the JVM."""
