"""Student credit ledger on Spark: who is on track to graduate, and in which subject."""

from .plans.graduation import Graduation, Inputs, Outputs, run
from .rules import DEFAULT_RULES, Rules
from .session import configure

__all__ = ["DEFAULT_RULES", "Graduation", "Inputs", "Outputs", "Rules", "configure", "run"]
