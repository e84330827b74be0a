"""Condition monitoring of rotating machines as Spark DataFrame operators."""
