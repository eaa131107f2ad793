"""Readers and sinks."""

from .catalog import ensure_namespace, read_table, replace_table  # noqa: F401
from .files import read_bronze  # noqa: F401
from .jdbc import sync_tables, write_jdbc  # noqa: F401
