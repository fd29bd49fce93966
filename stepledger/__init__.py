"""A PySpark-native engine for grading and curating step-by-step call records."""

__version__ = "0.2.0"
