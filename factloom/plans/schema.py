"""Schemas made at run time from one document's descriptors: group tree, Spark type of a record, strict JSON schema.

fields: dicts with path (dotted groups and a name), label, kind, cardinality. One document's fields are few (a model may
propose 80 at most), so all of this is driver work; nothing here reads data.
"""

from __future__ import annotations

import keyword
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import types as T

LEAF = T.StructType([T.StructField("value", T.StringType()), T.StructField("status", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("evidence", T.StringType()), T.StructField("page", T.ArrayType(T.IntegerType()))])
STATUSES = ("VALIDATED", "FAILED", "NOT_APPLICABLE")


def group_tree(fields: Iterable[dict]) -> dict[str, Any]:
    """Name to field, or to the tree of a group. A name that is both a field and a group stays a group."""
    root: dict[str, Any] = {}
    for field in sorted(fields, key=lambda f: f["path"].count(".")):
        *groups, name = field["path"].split(".")
        at = root
        for g in groups:
            below = at.get(g)
            if not isinstance(below, dict) or "path" in below:
                below = at[g] = {}
            at = below
        at.setdefault(name, field)
    return root


def _fold(tree: dict[str, Any], leaf: Callable[[dict], Any], group: Callable[[dict[str, Any]], Any]) -> Any:
    return group({name: leaf(node) if "path" in node else _fold(node, leaf, group) for name, node in tree.items()})


def record_type(fields: Iterable[dict]) -> T.StructType:
    """The type of one record: a struct per group, a leaf per field, an array of leaves where several values may stand."""
    leaf = lambda f: T.ArrayType(LEAF) if f.get("cardinality") == "MULTI" else LEAF
    return _fold(group_tree(fields), leaf, lambda members: T.StructType([T.StructField(n, t) for n, t in members.items()]))


def _closed(members: dict[str, Any]) -> dict[str, Any]:
    """An object that needs all of its members and allows no other."""
    return {"type": "object", "properties": members, "required": list(members), "additionalProperties": False}


def json_schema(fields: Iterable[dict]) -> dict[str, Any]:
    """The strict JSON schema of one record. No fields: an error, as there is nothing to ask for."""
    tree = group_tree(fields)
    if not tree:
        raise ValueError("no fields to make a schema of")
    value = _closed({"value": {"type": ["string", "null"]}, "status": {"type": "string", "enum": list(STATUSES)}, "confidence": {"type": "number"}, "evidence": {"type": "string"}, "page": {"type": "array", "items": {"type": "integer"}}})

    def leaf(f: dict) -> dict[str, Any]:
        said = {"description": f"{f.get('label') or f['path']} ({f.get('kind') or 'UNKNOWN'})"}
        return {"type": "array", "items": value} | said if f.get("cardinality") == "MULTI" else value | said

    return _fold(tree, leaf, _closed)


def attribute_name(name: str) -> str:
    """A slug as a Python attribute: keywords get a line behind, leading digits ``f_`` before."""
    name = name or "field"
    if name[0].isdigit():
        name = f"f_{name}"
    return name + "_" if keyword.iskeyword(name) or keyword.issoftkeyword(name) else name
