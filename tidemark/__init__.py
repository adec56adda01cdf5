"""Tidemark: as-of history analytics over dated events, written as Spark DataFrame operators."""
