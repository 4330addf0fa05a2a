"""Predicates on the symbol-role bit set."""

from pyspark.sql import Column, functions as F

from ..constants import ROLE_DEFINITION

ROLE_POLICIES = ("strict", "scip")


def has_definition_bit(role: Column) -> Column:
    return role.bitwiseAND(F.lit(ROLE_DEFINITION)) != 0


def is_reference_role(role: Column, policy: str = "strict") -> Column:
    """``strict`` needs some role bit; ``scip`` counts every non-definition occurrence."""
    if policy not in ROLE_POLICIES:
        raise ValueError(f"role policy must be one of {ROLE_POLICIES}, got {policy!r}")
    not_definition = ~has_definition_bit(role)
    return not_definition & (role != 0) if policy == "strict" else not_definition


def is_mention_role(role: Column, policy: str = "strict") -> Column:
    return (role != 0) if policy == "strict" else role.isNotNull()


def is_definition_role(role: Column, bitwise: bool = False) -> Column:
    return has_definition_bit(role) if bitwise else role == ROLE_DEFINITION
