"""Network-security and content analytics as PySpark DataFrame operators."""
