"""Lap, event and interval analytics expressed as Spark DataFrame operators."""
