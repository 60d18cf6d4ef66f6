"""Column helpers shared by the operators (all JVM-side expressions)."""

from .clock import ts
from .money import avg_half_up, money, prefix_equal

__all__ = ["avg_half_up", "money", "prefix_equal", "ts"]
