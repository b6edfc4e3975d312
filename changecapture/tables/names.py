"""Text that goes into SQL statements and paths."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any
from urllib.parse import unquote

# Characters a partition directory cannot show as they are (fixed values; file systems
# and the catalog agree on them).
_ESCAPED = set("\"#%'*/:=?\\\x7f{[]^")


def identifier(name: str) -> str:
    """Possibly qualified catalog name, every part quoted."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def literal(value: Any) -> str:
    """Value as a SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return str(value)
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def partition_spec(spec: Mapping[str, Any]) -> str:
    return ", ".join(f"{identifier(k)} = {literal(v)}" for k, v in spec.items())


def partition_folder(column: str, value: Any) -> str:
    """Directory name of one partition value."""
    shown = "".join(
        f"%{ord(ch):02X}" if ch in _ESCAPED or ord(ch) < 32 else ch for ch in str(value)
    )
    return f"{column}={shown}"


def partition_values(path: str) -> dict[str, str]:
    """Values that a partition's directories show."""
    pairs = (folder.partition("=") for folder in path.split("/"))
    return {unquote(name): unquote(value) for name, _, value in pairs}
