"""Whole jobs built from the operators, and the queries of the driver contract."""
