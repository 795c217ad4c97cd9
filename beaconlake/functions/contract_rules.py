"""Contract fields compiled to one SQL expression over parsed JSON (VARIANT) values.

A violation is a text expression: NULL when the value obeys the contract, otherwise what
is wrong with it. The rules become SQL text, so that a contract of a hundred rules costs
one expression parse; nothing runs Python per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from ..contracts import (
    ACCESS_DIGITS, ACCESS_FAMILIES, ENVELOPE, PAYLOADS, UUID, Field, access_identifiers,
)

PREFIX = "Schema validation error: "
SQL_TYPES = {"integer": "double", "number": "double", "string": "string"}


@dataclass(frozen=True)
class Value:
    """SQL of one JSON member: the variant (NULL when absent), its variant type and the
    value cast to the field's SQL type."""

    raw: str
    kind: str
    value: str

    @classmethod
    def at(cls, json: str, path: str, sql_type: str) -> Value:
        raw = f"try_variant_get({json}, '$.{path}', 'variant')"
        return cls(raw, f"schema_of_variant({raw})",
                   f"try_variant_get({json}, '$.{path}', '{sql_type}')")


def quoted(text: object) -> str:
    """A SQL string literal; raw, so that patterns keep their backslashes."""
    text = str(text)
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def whole(pattern: str) -> str:
    """The pattern matching a text to its very end: `$` also matches before a last line break."""
    return pattern.removesuffix("$") + r"\z"


def java_pattern(pattern: str) -> str:
    """UUIDs are a format and take no line break; `$` of published patterns knows \\n only."""
    return whole(pattern) if pattern == UUID else f"(?d){pattern}"


def payload_fields() -> list[Field]:
    return [f for fields in PAYLOADS.values() for f in fields]


def has_json_type(json_type: str, kind: str) -> str:
    """Whether a value of variant type `kind` has the JSON type. Casting instead would
    let the text "12" pass for a number."""
    if json_type == "string":
        return f"{kind} = 'STRING'"
    return f"({kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith({kind}, 'DECIMAL'))"


def violation(field: Field, at: Value, prefix: str = "") -> str:
    """First broken constraint of one field as text, else NULL."""
    name = f"{prefix}{field.name}"
    checks: list[tuple[str, str]] = []
    if field.required:
        checks.append((f"{at.raw} IS NULL", f"{name} is required"))
    if field.type == "object":
        checks.append((f"{at.kind} IS NULL", f"{name} must be an object"))
    else:
        checks.append((f"{at.raw} IS NOT NULL AND NOT {has_json_type(field.type, at.kind)}",
                       f"{name} must be of type {field.type}"))
    if field.type == "integer":
        checks.append((f"{at.value} % 1.0D <> 0", f"{name} must be of type integer"))
    if field.const is not None:
        checks.append((f"{at.value} <> {field.const}", f"{name} must be {field.const}"))
    if field.enum:
        allowed = ", ".join(quoted(e) for e in field.enum)
        checks.append((f"{at.value} NOT IN ({allowed})",
                       f"{name} must be one of {list(field.enum)}"))
    if field.minimum is not None:
        checks.append((f"{at.value} < {field.minimum}D", f"{name} is below {field.minimum}"))
    if field.above is not None:
        checks.append((f"{at.value} <= {field.above}D", f"{name} must be above {field.above}"))
    if field.maximum is not None:
        checks.append((f"{at.value} > {field.maximum}D", f"{name} is above {field.maximum}"))
    if field.pattern is not None:
        checks.append((f"NOT rlike({at.value}, {quoted(java_pattern(field.pattern))})",
                       f"{name} does not match {field.pattern}"))
    return "CASE " + " ".join(f"WHEN {c} THEN {quoted(t)}" for c, t in checks) + " END"


def unexpected_keys(keys: str, fields, where: str) -> str:
    allowed = ", ".join(quoted(f.name) for f in fields)
    extra = f"array_except({keys}, array({allowed}))"
    return (f"CASE WHEN size({extra}) > 0 THEN "
            f"concat({quoted(f'unexpected {where} field ')}, array_min({extra})) END")


def contract_violation(json: str, event_type: str, digits: str = ACCESS_DIGITS) -> str:
    """First violation of the family's contract, envelope before payload."""
    def keys(path: str) -> str:
        return f"map_keys(try_variant_get({json}, '{path}', 'map<string, variant>'))"

    def member(field: Field, path: str = "") -> Value:
        if field.type == "object":
            return Value(f"try_variant_get({json}, '$.{field.name}', 'variant')",
                         keys(f"$.{field.name}"), "NULL")
        return Value.at(json, path + field.name, SQL_TYPES[field.type])

    steps = [violation(f, member(f)) for f in ENVELOPE]
    steps.append(unexpected_keys(keys("$"), ENVELOPE, "envelope"))
    access = ", ".join(violation(f, member(f)) for f in access_identifiers(digits))
    families = ", ".join(quoted(f) for f in ACCESS_FAMILIES)
    steps.append(f"CASE WHEN {event_type} IN ({families}) THEN coalesce({access}) END")
    per_family = []
    for family, fields in PAYLOADS.items():
        checks = [violation(f, member(f, "payload."), "payload.") for f in fields]
        checks.append(unexpected_keys(keys("$.payload"), fields, "payload"))
        per_family.append(f"WHEN {quoted(family)} THEN coalesce({', '.join(checks)})")
    steps.append(f"CASE {event_type} {' '.join(per_family)} END")
    return f"coalesce({', '.join(steps)})"


def typed_document() -> str:
    """Cast target that takes a whole record apart in one pass."""
    columns = [f"{f.name}: {SQL_TYPES[f.type]}" for f in ENVELOPE if f.type != "object"]
    columns = [c.replace("sequence_number: double", "sequence_number: bigint") for c in columns]
    members = ", ".join(f"{f.name}: {SQL_TYPES[f.type]}" for f in payload_fields())
    return f"struct<{', '.join(columns)}, payload: struct<{members}>>"


# How `schema_of_variant` spells the JSON types in an object's description.
_SHAPES = {
    "integer": "BIGINT",
    "number": r"(?:BIGINT|DOUBLE|DECIMAL\(\d+,\d+\))",
    "string": "STRING",
}


def _shape(members: dict[str, tuple[str, bool]]) -> str:
    """Pattern of an object description with these members: name -> (type, required)."""
    parts = []
    for name in sorted(members):
        kind, required = members[name]
        part = f"(?:{name}: {kind}(?:, |(?=>)))"
        parts.append(part if required else part + "?")
    return f"OBJECT<{''.join(parts)}>"


def record_shape(family: str) -> str:
    """Pattern that the description of a record with the right members and types has."""
    payload = _shape({f.name: (_SHAPES[f.type], f.required) for f in PAYLOADS[family]})
    members = {f.name: (_SHAPES[f.type], True) for f in ENVELOPE if f.type != "object"}
    return f"^{_shape({**members, 'payload': (payload, True)})}$"


def _holds(field: Field, value: str) -> list[str]:
    """The constraints on a present value of the right type, as predicates."""
    checks = []
    if field.const is not None:
        checks.append(f"{value} = {field.const}")
    if field.enum:
        checks.append(f"{value} IN ({', '.join(quoted(e) for e in field.enum)})")
    if field.minimum is not None:
        checks.append(f"{value} >= {field.minimum}")
    if field.above is not None:
        checks.append(f"{value} > {field.above}")
    if field.maximum is not None:
        checks.append(f"{value} <= {field.maximum}")
    if field.pattern is not None:
        checks.append(f"rlike({value}, {quoted(java_pattern(field.pattern))})")
    if not field.required and checks:
        return [f"({value} IS NULL OR ({' AND '.join(checks)}))"]
    return checks


def surely_valid(shape: str, doc: str, digits: str = ACCESS_DIGITS) -> str:
    """True when a record obeys its contract; NULL or false when that is not yet known.

    One pattern on the record's description settles members and types together, so that
    sound records, nearly all of them, never reach `contract_violation`.
    """
    narrowed = {f.name: f for f in access_identifiers(digits)}
    per_family = []
    for family, fields in PAYLOADS.items():
        checks = [f"rlike({shape}, {quoted(record_shape(family))})"]
        for f in ENVELOPE:
            if f.type != "object":
                rule = narrowed.get(f.name, f) if family in ACCESS_FAMILIES else f
                checks += _holds(rule, f"{doc}.{f.name}")
        for f in fields:
            checks += _holds(f, f"{doc}.payload.{f.name}")
        per_family.append(f"WHEN {quoted(family)} THEN {' AND '.join(checks)}")
    return f"CASE {doc}.event_type {' '.join(per_family)} END"
