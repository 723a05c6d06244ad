"""DDL of the index tables that jobs write, and their logical keys. Ids of objects are hex."""

from __future__ import annotations

TABLES: dict[str, str] = {
    "content_mimetype": "id string, mimetype string, encoding string, tool_id long",
    "content_license": "id string, license string, tool_id long",
    "content_metadata": "id string, metadata string, tool_id long",
    "directory_metadata": "id string, metadata string, tool_id long, mappings array<string>",
    "origin_intrinsic": "id string, metadata string, tool_id long, from_directory string, mappings array<string>, tokens array<string>",
    "origin_extrinsic": "id string, metadata string, tool_id long, from_remd_id string, mappings array<string>, tokens array<string>",
}
#: Logical key of each index table; rows with equal keys replace each other.
KEYS: dict[str, list[str]] = {name: ["id", "license", "tool_id"] if name == "content_license" else ["id", "tool_id"] for name in TABLES}
MANIFEST = "path string, low string, high string, rows long"
CHANGES = "object_type string, message string"
SUMMARY = "name string, added long, status string, error string"
