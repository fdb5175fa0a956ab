"""vaultshift — subscription-billing migration checks and import files, as Spark jobs."""

from vaultshift.operators.rules import UserRule
from vaultshift.plans.pipeline import Migration, MigrationOptions

__all__ = ["Migration", "MigrationOptions", "UserRule"]
