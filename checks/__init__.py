"""Registered queries over the given tables and the SQL that must agree with them."""

from checks import access, cleaning, flows, integrity, quality, readers, stored, whole_files  # noqa: F401
from checks.registry import CHECKS

__all__ = ["CHECKS"]
