"""Certificate audit as Spark jobs: pick, extract, verify, compare, append."""

from .config import AuditOptions

__all__ = ["AuditOptions"]
