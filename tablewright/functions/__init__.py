"""Column expressions: every function takes and returns Columns and stays inside the JVM."""
