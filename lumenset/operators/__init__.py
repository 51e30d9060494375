"""Operators over manifest DataFrames."""
