"""Compositions of the operators: scenario state, the query registry and
the equivalent SQL used as a correctness oracle."""
