"""oncolake: cancer-registry reports to clinical resources, as Spark DataFrame operators."""

from oncolake.config import DEFAULT, MappingConfig

__all__ = ["DEFAULT", "MappingConfig"]
