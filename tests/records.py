"""Raw records for tests, made from the contracts: each field has a value in the middle of what
is allowed, the values at its edges, and one just beyond each edge."""

from __future__ import annotations

import copy
import json
import uuid
from collections.abc import Iterator
from datetime import datetime

from beaconlake import contracts
from beaconlake.contracts import Field
from beaconlake.model import FAMILIES, RAW_RECORD_DDL

ARRIVED = datetime(2025, 3, 9, 21, 4, 57)
TOPIC_OF = {f.event_type: f.topic for f in FAMILIES}
SITE, DEVICE = contracts.access_identifiers()
BY_PATTERN = {
    contracts.UUID: str(uuid.uuid5(uuid.NAMESPACE_DNS, "records.test")),
    contracts.TIMESTAMP: "2025-03-09T21:04:55.640Z",
    contracts.IDENTIFIER: "rtr_7-b",
    SITE.pattern: "site-0817",
    DEVICE.pattern: "device-0817",
}
NOT_MATCHING = {
    contracts.UUID: BY_PATTERN[contracts.UUID].replace("-", ""),
    contracts.TIMESTAMP: "2025-03-09 21:04:55.640",
    contracts.IDENTIFIER: "-rtr",
    SITE.pattern: "site-81",
    DEVICE.pattern: "rtr_7-b",
}


def inside(field: Field):
    if field.const is not None:
        return field.const
    if field.enum:
        return field.enum[-1]
    if field.pattern:
        return BY_PATTERN[field.pattern]
    low = field.minimum if field.minimum is not None else field.above
    if field.maximum is None:
        return int(low) + 6
    return low + (field.maximum - low) / 8


def edges(field: Field) -> Iterator:
    """Further values that are allowed."""
    yield from field.enum
    yield from (v for v in (field.minimum, field.maximum) if v is not None)
    if field.above is not None:
        yield field.above + 1e-9
    if field.type == "integer" and field.minimum is not None:
        yield float(field.minimum + 3)
    if field.pattern == contracts.UUID:
        yield BY_PATTERN[contracts.UUID].upper()


def beyond(field: Field) -> Iterator:
    """Values that are not allowed, of the right and of other types."""
    yield None
    yield {"string": 7, "object": "text"}.get(field.type, "7")
    if field.type in ("integer", "number"):
        yield False
    if field.type == "integer":
        yield inside(field) + 0.25
    if field.type == "object":
        yield []
    if field.const is not None:
        yield field.const + 1
    if field.minimum is not None:
        yield field.minimum - 1
    if field.above is not None:
        yield field.above
    if field.maximum is not None:
        yield field.maximum + 1
    if field.enum:
        yield field.enum[0].title()
    if field.pattern:
        yield NOT_MATCHING[field.pattern]
    if field.pattern == contracts.UUID:
        yield BY_PATTERN[field.pattern] + "\n"


def fields(event_type: str) -> tuple[Field, ...]:
    """Envelope fields of a family, with its own identifiers."""
    own = {f.name: f for f in contracts.access_identifiers()} if (
        event_type in contracts.ACCESS_FAMILIES) else {}
    return tuple(own.get(f.name, f) for f in contracts.ENVELOPE
                 if f.name not in ("payload", "event_type"))


def sound(event_type: str) -> dict:
    envelope = {f.name: inside(f) for f in fields(event_type)}
    payload = {f.name: inside(f) for f in contracts.PAYLOADS[event_type] if f.required}
    return {**envelope, "event_type": event_type, "payload": payload}


def with_value(event: dict, name: str, value, in_payload: bool) -> dict:
    event = copy.deepcopy(event)
    (event["payload"] if in_payload else event)[name] = value
    return event


def without(event: dict, name: str, in_payload: bool) -> dict:
    event = copy.deepcopy(event)
    del (event["payload"] if in_payload else event)[name]
    return event


def _cases() -> tuple[dict[str, dict], dict[str, dict]]:
    valid, broken = {}, {}
    for event_type, payload in contracts.PAYLOADS.items():
        event = sound(event_type)
        valid[event_type] = event
        whole = contracts.Field("payload", "object")
        for field, deep in [(f, False) for f in (*fields(event_type), whole)] + [
                (f, True) for f in payload]:
            name = f"{event_type} {field.name}"
            for i, value in enumerate(edges(field)):
                valid[f"{name} edge {i}"] = with_value(event, field.name, value, deep)
            for i, value in enumerate(beyond(field)):
                broken[f"{name} beyond {i}"] = with_value(event, field.name, value, deep)
            if field.required:
                broken[f"{name} missing"] = without(event, field.name, deep)
        for deep in (False, True):
            broken[f"{event_type} unknown field {deep}"] = with_value(event, "zone", 1, deep)
    return valid, broken


VALID, BROKEN = _cases()
CONNECTIVITY = VALID["connectivity_metric"]


def changed(**values) -> dict:
    return {**CONNECTIVITY, **values}


def raw(spark, *records: tuple[bytes | None, str]):
    """Records (value, topic) as a broker would hand them over, offsets in order."""
    rows = [(CONNECTIVITY["device_id"].encode(), value, topic, 0, offset, ARRIVED)
            for offset, (value, topic) in enumerate(records)]
    return spark.createDataFrame(rows, RAW_RECORD_DDL)


def encoded(event: dict) -> tuple[bytes, str]:
    return json.dumps(event).encode(), TOPIC_OF.get(event["event_type"], "network.connectivity")
