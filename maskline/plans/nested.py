"""Rules addressed by path through structs, arrays, maps and JSON text: one native expression for a column of any depth."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import keyed
from . import rules
from .rules import Rule

ELEMENT, VALUE, MAP_KEY = "[]", "{}", "{key}"  # what a path says of an array's elements, a map's values and a map's keys
_WHOLE = ("passthrough", "suppress")  # strategies that an inner node can have, for all that is below it
_KEYS = ("passthrough", "tokenize")  # strategies that keep a map's keys apart


def _under(path: str, other: str) -> bool:
    return len(path) > len(other) and path.startswith(other) and path[len(other)] in ".[{"


def _shape(kind: T.DataType, path: str, json: dict[str, str]) -> T.DataType:
    return T._parse_datatype_string(json[path]) if path in json else kind


def paths(kind: T.DataType, json: dict[str, str] | None = None, path: str = "") -> Iterator[tuple[str, bool]]:
    """Every node's path, and whether it is a leaf; ``json`` gives the schema of text that holds JSON, by its path."""
    json = json or {}
    if path in json and not isinstance(kind, T.StringType):
        raise TypeError(f"{path} of type {kind.simpleString()} holds no JSON text")
    kind = _shape(kind, path, json)
    if path:
        yield path, not isinstance(kind, T.StructType | T.ArrayType | T.MapType)
    if isinstance(kind, T.StructType):
        if odd := [f.name for f in kind.fields if set(f.name) & set(".[{")]:
            raise ValueError(f"{odd[0]}: a name with a dot or bracket has no path")
        for f in kind.fields:
            yield from paths(f.dataType, json, f"{path}.{f.name}" if path else f.name)
    elif isinstance(kind, T.ArrayType):
        yield from paths(kind.elementType, json, path + ELEMENT)
    elif isinstance(kind, T.MapType):
        yield path + MAP_KEY, True
        yield from paths(kind.valueType, json, path + VALUE)


def check(schema: T.StructType, by_path: dict[str, Rule], json: dict[str, str], default: str = "suppress") -> None:
    """Refuse rules of no path, rules below a path that has one itself, strategies for leaves on inner nodes, and key rules that could merge keys."""
    rules.check(by_path, default)
    if default not in _WHOLE:
        raise ValueError(f"the default of nested columns can be {' or '.join(_WHOLE)} only")
    if lineage := sorted(p for p in by_path if p.startswith("_")):
        raise ValueError(f"lineage columns pass and take no rules: {', '.join(lineage)}")
    nodes = list(paths(schema, json))
    known = dict(nodes)
    if len(known) < len(nodes):
        raise ValueError("two values have the same path")
    if lost := sorted((set(by_path) | set(json)) - set(known)):
        raise ValueError(f"the schema has no {', '.join(lost)}")
    for path in by_path:
        name = rules.resolve(by_path, path)["strategy"]
        if not known[path] and name not in _WHOLE:
            raise ValueError(f"{path}: {name} is for single values")
        if path.endswith(MAP_KEY) and name not in _KEYS:
            raise ValueError(f"{path}: keys can be {' or '.join(_KEYS)} only")
        if below := [p for p in by_path if _under(p, path)]:
            raise ValueError(f"{path} has a rule for all that is below it, and so has {below[0]}")


def _rewritten(df: DataFrame, value: Column, kind: T.DataType, path: str, by_path: dict[str, Rule], json: dict[str, str], default: str) -> Column:
    def below(inner: Column, inner_kind: T.DataType, inner_path: str) -> Column:
        return _rewritten(df, inner, inner_kind, inner_path, by_path, json, default)

    if path in by_path or not any(_under(p, path) for p in by_path):  # without a rule at or below it, a node has the default as a whole
        rule: dict[str, Any] = rules.resolve(by_path, path, default)
        return rules.applied(value, kind, rule, path, rules.entity_of(df, rule))
    if path in json:
        shape = _shape(kind, path, json)
        parsed = F.from_json(value, shape, {"mode": "PERMISSIVE"})
        return F.to_json(_rewritten(df, parsed, shape, path, by_path, {p: s for p, s in json.items() if p != path}, default))
    if isinstance(kind, T.StructType):
        fields = (below(value.getField(f.name), f.dataType, f"{path}.{f.name}").alias(f.name) for f in kind.fields)
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: below(x, kind.elementType, path + ELEMENT))
    if path + MAP_KEY not in by_path and default == "suppress":  # keys can name people: a map whose keys have no rule goes
        return rules.applied(value, kind, {"strategy": default}, path)
    values = F.transform_values(value, lambda _, x: below(x, kind.valueType, path + VALUE))
    return F.transform_keys(values, lambda k, _: below(k, kind.keyType, path + MAP_KEY))


def deidentify(df: DataFrame, by_path: dict[str, Rule], key: str, json: dict[str, str] | None = None, default: str = "suppress") -> DataFrame:
    """De-identify a table with nested columns, batch or stream: same rows, same columns, each value by the rule of its path.

    A path names fields by dots, an array's elements by ``[]``, a map's values by ``{}`` and its
    keys by ``{key}``: ``visits[].note``, ``contacts{}.phone``. ``json`` gives the schema of a text
    that holds JSON; paths go on inside it, and it is written back as text. A value without a rule
    gets the default, at any depth; a map whose keys have none is suppressed, since keys can be
    names. Top-level lineage columns pass. Rules that match no path are refused.

    Null structs, arrays, maps and texts stay null, empty ones empty. JSON fields that the schema
    lacks are left out, as are null ones; text that is not such JSON keeps no value (an object
    becomes ``{}``). A suppressed value is null text. Tokens of a map's keys that happen to be
    equal stop the query. ``date_shift`` takes its entity from a top-level column. All is one
    projection without a shuffle; a row's arrays and texts are held in memory one row at a time.
    """
    json = json or {}
    check(df.schema, by_path, json, default)
    with_key = keyed.with_key(df, key)
    return with_key.select(*(_rewritten(df, F.col(f"`{f.name}`"), f.dataType, f.name, by_path, json, default).alias(f.name) for f in df.schema.fields))


def uncovered(schema: T.StructType, by_path: dict[str, Rule], json: dict[str, str] | None = None) -> list[str]:
    """Leaves that no rule names, neither their own nor one of a node above."""
    return [p for p, leaf in paths(schema, json) if leaf and not any(p == r or _under(p, r) for r in by_path)]
