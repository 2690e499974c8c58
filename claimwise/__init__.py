"""Motor-claims analytics as Spark DataFrame -> DataFrame operators and jobs."""

__version__ = "0.1.0"
