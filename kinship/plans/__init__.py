"""Composite queries, one module per task family. Every function takes and
returns DataFrames and stays lazy."""
