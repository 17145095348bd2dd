"""A contract-driven lakehouse analytics engine on PySpark."""
