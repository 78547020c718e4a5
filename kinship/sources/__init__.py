"""Inputs: typed schemas, the driver-table views, text scans and the data generator."""
