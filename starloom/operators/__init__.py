"""Warehouse operators: pure DataFrame functions with explicit clocks."""
