"""Table replication and change-data processing as PySpark jobs."""

__version__ = "0.1.0"
