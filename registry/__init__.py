"""Queries over the driver's test data and the SQL they are compared with."""
