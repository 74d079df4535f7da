"""PySpark jobs that turn landed sports reference payloads into audited tables."""
