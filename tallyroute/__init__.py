"""Tabular placement, ranking and routing analytics as Spark DataFrame operators."""
