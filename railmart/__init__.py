"""Rail and air carbon corridors as Spark DataFrame jobs."""

__version__ = "0.1.0"
