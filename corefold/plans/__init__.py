"""Whole plans made of the operators, the queries over the driver's tables, and the command line."""
