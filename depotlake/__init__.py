"""Supply-chain lakehouse jobs for PySpark: bronze, silver and gold as DataFrame functions."""
