"""Scalar expressions: durations, local dates, guarded arithmetic. No Python UDFs."""
