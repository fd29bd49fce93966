"""The domain that records are checked against: states, methods and weights.

``DEFAULT`` is the support-ticket domain; ``load`` reads another from a folder
with ``state-machine.yaml``, ``jsonrpc-methods.json`` and
``reward-rubric.yaml``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

SUBSCORES = ("parse", "schema", "method_known", "precondition_met", "transition_valid", "sequence_optimal")
AGGREGATIONS = ("mean", "min", "product")


class DomainError(ValueError):
    """A domain that contradicts itself."""


@dataclass(frozen=True)
class Domain:
    """States, arcs (state, trigger) -> state, methods with their triggers and parameter schemas, reward presets."""

    states: tuple[str, ...]
    initial_state: str
    terminal_states: tuple[str, ...]
    arcs: dict[tuple[str, str], str]
    triggers: dict[str, tuple[str, ...]]
    params: dict[str, dict]
    presets: dict[str, dict[str, float]]
    aggregation: str = "mean"
    defs: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.initial_state not in self.states:
            raise DomainError(f"initial state {self.initial_state!r} is not a state")
        for (at, _), to in self.arcs.items():
            if at not in self.states or to not in self.states:
                raise DomainError(f"arc {at} -> {to} has an unknown state")
        if unknown := set(self.triggers) - set(self.params):
            raise DomainError(f"triggers of unknown methods: {sorted(unknown)}")
        if self.aggregation not in AGGREGATIONS:
            raise DomainError(f"unknown aggregation {self.aggregation!r}")

    @property
    def methods(self) -> tuple[str, ...]:
        return tuple(self.params)

    def preset(self, name: str) -> dict[str, float]:
        """The weights of a preset; a KeyError if there is none of that name."""
        if name not in self.presets:
            raise KeyError(f"no reward preset {name!r}; there are {sorted(self.presets)}")
        return self.presets[name]


def arcs_of(rows: list[dict]) -> dict[tuple[str, str], str]:
    """Arcs by state and trigger; a pair that stands twice is an error, since a join would return it twice."""
    out: dict[tuple[str, str], str] = {}
    for row in rows:
        key = (row["from"], row["trigger"])
        if key in out:
            raise DomainError(f"two arcs for {key}")
        out[key] = row["to"]
    return out


def load(folder: str | Path) -> Domain:
    """Read a domain from a folder on the driver."""
    import yaml

    folder = Path(folder)
    machine = yaml.safe_load((folder / "state-machine.yaml").read_text(encoding="utf-8"))
    methods = json.loads((folder / "jsonrpc-methods.json").read_text(encoding="utf-8"))
    rubric = yaml.safe_load((folder / "reward-rubric.yaml").read_text(encoding="utf-8"))
    return Domain(
        states=tuple(machine["states"]),
        initial_state=machine["initial_state"],
        terminal_states=tuple(machine.get("terminal_states", ())),
        arcs=arcs_of(machine["transitions"]),
        triggers={m: tuple(t or ()) for m, t in machine.get("method_triggers", {}).items()},
        params={m: v["params"] for m, v in methods["methods"].items()},
        presets={k: {s: float(w) for s, w in v.items()} for k, v in rubric["presets"].items()},
        aggregation=rubric.get("aggregation", "mean"),
        defs=methods.get("$defs", {}),
    )


def closed(required: list[str], **properties: dict) -> dict:
    """An object schema without further properties."""
    return {"type": "object", "required": required, "properties": properties, "additionalProperties": False}


TEXT, WORD, OBJECT = {"type": "string"}, {"type": "string", "minLength": 1}, {"type": "object"}

# Names, arcs, parameter rules and weights of the default domain.
DEFAULT = Domain(
    states=("NEW", "TRIAGED", "ASSIGNED", "IN_PROGRESS", "RESOLVED", "REOPENED", "ESCALATED", "ENGINEERING", "CLOSED", "ARCHIVED"),
    initial_state="NEW",
    terminal_states=("ARCHIVED",),
    arcs={
        ("NEW", "ticket_open.accepted"): "TRIAGED",
        ("TRIAGED", "routing.assigned"): "ASSIGNED",
        ("ASSIGNED", "agent.acknowledged"): "IN_PROGRESS",
        ("IN_PROGRESS", "resolution_confirm.passed"): "RESOLVED",
        ("RESOLVED", "ticket_reopen.issued"): "REOPENED",
        ("REOPENED", "resolution_confirm.passed"): "RESOLVED",
        ("REOPENED", "resolution_confirm.failed"): "ESCALATED",
        ("ESCALATED", "escalation.start"): "ENGINEERING",
        ("ENGINEERING", "escalation.resolved"): "RESOLVED",
        ("RESOLVED", "lifecycle.close"): "CLOSED",
        ("CLOSED", "lifecycle.archive_window_elapsed"): "ARCHIVED",
    },
    triggers={
        "ticket_open": ("ticket_open.accepted",),
        "ticket_get": (),
        "ticket_status": (),
        "ticket_reopen": ("ticket_reopen.issued",),
        "resolution_confirm": ("resolution_confirm.passed", "resolution_confirm.failed"),
        "ticket_history": (),
        "admin_agent_add": (),
        "admin_escalate": ("escalation.start", "escalation.resolved"),
        "admin_lifecycle_apply": ("lifecycle.close", "lifecycle.archive_window_elapsed"),
    },
    params={
        "ticket_open": closed(["requester_id", "body_text", "lifecycle_profile"], requester_id={"type": "string", "pattern": "^user:"}, body_text={"type": "string", "minLength": 4}, lifecycle_profile=TEXT),
        "ticket_get": closed(["ticket_id"], ticket_id=WORD),
        "ticket_status": closed(["ticket_id"], ticket_id=WORD),
        "ticket_reopen": closed(["ticket_id", "reopen_reason"], ticket_id=WORD, reopen_reason=TEXT),
        "resolution_confirm": closed(["review_id", "resolution_notes"], review_id=WORD, resolution_notes=OBJECT),
        "ticket_history": closed(["ticket_id", "window"], ticket_id=WORD, window=closed([], from_utc={"type": "string", "format": "date-time"}, to_utc={"type": "string", "format": "date-time"})),
        "admin_agent_add": closed(["agent_profile"], agent_profile=OBJECT),
        "admin_escalate": closed(["agent_id", "ticket_id"], agent_id=WORD, ticket_id=WORD),
        "admin_lifecycle_apply": closed(["lifecycle_profile"], lifecycle_profile=TEXT),
    },
    presets={
        "shaped": {"parse": 0.10, "schema": 0.20, "method_known": 0.10, "precondition_met": 0.20, "transition_valid": 0.30, "sequence_optimal": 0.10},
        "binary": {"transition_valid": 1.0},
        "schema_only": {"parse": 0.5, "schema": 0.5},
    },
)
