from tidemark.registry import behavior  # noqa: F401 - registers its queries
from tidemark.registry.oracle import ORACLE
from tidemark.registry.queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
