"""Column expressions. Each takes and returns ``Column`` and stays inside the JVM."""
