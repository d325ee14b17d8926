"""Readers and writers."""

from tillwright.sources.readers import FORMATS, read_source
from tillwright.sources.writers import audit_row, dry_run, write_table

__all__ = ["FORMATS", "read_source", "write_table", "dry_run", "audit_row"]
