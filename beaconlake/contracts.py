"""The event contracts as data: one `Field` per JSON property and its constraints.

Fixed values throughout: names, types, bounds, patterns and enumerations must equal the
published event contract, version 1.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Field:
    name: str
    type: str  # JSON type: integer, number, string or object
    required: bool = True
    const: int | str | None = None
    enum: tuple[str, ...] = ()
    minimum: float | None = None
    above: float | None = None  # exclusive minimum
    maximum: float | None = None
    pattern: str | None = None


UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}Z$"
IDENTIFIER = "^[a-z0-9][a-z0-9_-]*$"
# How many digits the ids of access sites and devices have, as a pattern; a network of more than
# 9,999 devices passes another one.
ACCESS_DIGITS = "{4}"
STATES = ("online", "degraded", "offline")

ENVELOPE = (
    Field("schema_version", "integer", const=1),
    Field("event_id", "string", pattern=UUID),
    Field("event_type", "string"),
    Field("event_timestamp", "string", pattern=TIMESTAMP),
    Field("device_session_id", "string", pattern=UUID),
    Field("sequence_number", "integer", minimum=1),
    Field("site_id", "string", pattern=IDENTIFIER),
    Field("device_id", "string", pattern=IDENTIFIER),
    Field("payload", "object"),
)

PAYLOADS: dict[str, tuple[Field, ...]] = {
    "connectivity_metric": (
        Field("latency_ms", "number", minimum=0, maximum=60000),
        Field("jitter_ms", "number", minimum=0, maximum=60000),
        Field("packet_loss_pct", "number", minimum=0, maximum=100),
    ),
    "throughput_test": (
        Field("download_mbps", "number", above=0, maximum=100000),
        Field("upload_mbps", "number", above=0, maximum=100000),
    ),
    "device_health": (
        Field("cpu_pct", "number", minimum=0, maximum=100),
        Field("memory_pct", "number", minimum=0, maximum=100),
        Field("temperature_c", "number", minimum=-50, maximum=200),
        Field("optical_rx_power_dbm", "number", required=False, minimum=-50, maximum=10),
        Field("snr_db", "number", required=False, minimum=0, maximum=100),
        Field("signal_strength_dbm", "number", required=False, minimum=-150, maximum=0),
        Field("signal_quality_pct", "number", required=False, minimum=0, maximum=100),
    ),
    "connectivity_state": (
        Field("previous_state", "string", enum=STATES),
        Field("new_state", "string", enum=STATES),
        Field("reason", "string", enum=(
            "upstream_congestion", "upstream_outage", "upstream_recovery", "upstream_recovered",
        )),
    ),
    "infrastructure_event": (
        Field("incident_id", "string", pattern=UUID),
        Field("event_kind", "string", enum=(
            "congestion_started", "outage_started", "recovery_started", "recovered",
        )),
        Field("severity", "string", enum=("info", "warning", "critical")),
    ),
}

# Families published by access devices only narrow the identifiers.
ACCESS_FAMILIES = ("connectivity_metric", "throughput_test", "connectivity_state")


def access_identifiers(digits: str = ACCESS_DIGITS) -> tuple[Field, ...]:
    narrowed = {"site_id": f"^site-[0-9]{digits}$", "device_id": f"^device-[0-9]{digits}$"}
    return tuple(
        replace(f, pattern=narrowed[f.name]) for f in ENVELOPE if f.name in narrowed
    )
