"""Registered queries of the engine and their DuckDB SQL."""

from __future__ import annotations

from . import archive, citations, formats, relational, streams, vocabulary

QUERIES = relational.QUERIES | archive.QUERIES | formats.QUERIES | citations.QUERIES | streams.QUERIES | vocabulary.QUERIES
ORACLES = relational.ORACLES | archive.ORACLES | formats.ORACLES | citations.ORACLES | streams.ORACLES | vocabulary.ORACLES
