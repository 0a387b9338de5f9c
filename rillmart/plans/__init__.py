"""The named jobs of the warehouse, each a thin composition of operators.

Every plan takes and returns DataFrames. Given batch input it computes finished
history; given streams (with event time declared) the stateless plans and the window
aggregations run unchanged.
"""
