"""Readers for the driver tables and the file/table inputs of the pipelines."""
