"""Readers, sinks, declared schemas and literal dimensions."""

from . import dimensions, files, observations, schemas, tables

__all__ = ["dimensions", "files", "observations", "schemas", "tables"]
