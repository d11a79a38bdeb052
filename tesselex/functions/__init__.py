"""Scalar functions as Columns: everything here stays inside generated code."""
