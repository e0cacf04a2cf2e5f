"""examloom: a PySpark-native engine for exam-paper content and its quality queries."""

__version__ = "0.1.0"
