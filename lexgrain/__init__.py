"""lexgrain: a PySpark-native engine for collections of statutory text."""

__version__ = "0.1.0"
