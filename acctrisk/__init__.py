"""Account renewal-risk analytics as lazy PySpark DataFrame operators."""

from acctrisk.params import DEFAULT, ScoringParams

__all__ = ["DEFAULT", "ScoringParams"]
