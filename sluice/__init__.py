"""Land JSON event streams as clean, keyed tables on Spark and report on them."""

from .session import configure, create_session
from .specs import DatasetSpec, TableColumn, all_specs, get_spec, register, wire

__all__ = [
    "DatasetSpec",
    "TableColumn",
    "all_specs",
    "configure",
    "create_session",
    "get_spec",
    "register",
    "wire",
]
