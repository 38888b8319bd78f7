"""Reconcile the same tables as exported by two systems, on Spark."""

from twinledger.model import TablePair, TableSpec
from twinledger.session import build_session, recommended_conf

__all__ = ["TablePair", "TableSpec", "build_session", "recommended_conf"]
