"""Small documents that the driver reads: seeds, configurations, sweeps, registries."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import groupby
from pathlib import Path
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from stepledger.domain import Domain


def read_yaml(path: str | Path):
    """A YAML document; an empty one is an empty mapping."""
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def yaml_to_json(text: str) -> str:
    """A YAML document as JSON text."""
    import yaml

    return json.dumps(yaml.safe_load(text), default=str)


def seed_faults(seed, domain: Domain | None) -> Iterator[str]:
    """What is wrong with a seed, the worst first."""
    if not isinstance(seed, dict):
        yield f"is a {type(seed).__name__}, not a mapping"
        return
    yield from (f"has no '{key}'" for key in ("trajectory_id", "initial_state", "steps") if key not in seed)
    steps = seed.get("steps")
    if not isinstance(steps, list):
        yield "has 'steps' that are no list"
    elif domain is not None:
        if seed.get("initial_state") not in domain.states:
            yield f"has the unknown initial_state {seed.get('initial_state')!r}"
        queries = {m for m in domain.methods if not domain.triggers.get(m)}
        asked = [(step.get("tool_call") or {}).get("method") if "expected_trigger" in step else None for step in steps]
        yield from (f"has an 'expected_trigger' in step {j}, which calls the query method {m!r}" for j, m in enumerate(asked) if m in queries)


def read_seeds(path: str | Path, domain: Domain | None = None) -> list[dict]:
    """Seeds with their source and the calls before each step filled in."""
    seeds = read_yaml(path).get("seeds", [])
    for i, seed in enumerate(seeds):
        for fault in seed_faults(seed, domain):
            raise ValueError(f"seed {i} {fault}")
        seed.setdefault("source", "hand_seed")
        before: list = []
        for j, step in enumerate(seed["steps"]):
            context = step.setdefault("prompt_context", {})
            if j:
                context.setdefault("prior_calls", list(before))
            if step.get("tool_call"):
                before.append(step["tool_call"])
    return seeds


def seed_lines(spark: SparkSession, seeds: list[dict]) -> DataFrame:
    """Seeds as JSON lines in their order."""
    return spark.createDataFrame([(json.dumps(s), i) for i, s in enumerate(seeds)], "value string, row_idx long")


Path_ = tuple[str, ...]


def leaves(document: dict, way: Path_ = ()) -> Iterator[tuple[Path_, object]]:
    """The path and value of everything in a mapping that is no mapping itself, or an empty one."""
    for key, value in document.items():
        if isinstance(value, dict) and value:
            yield from leaves(value, (*way, key))
        else:
            yield (*way, key), value


def grown(pairs: list[tuple[Path_, object]]) -> dict:
    """The mapping with these leaves; a path that is also the beginning of another is an error."""
    out: dict = {}
    for key, group in groupby(sorted(pairs, key=lambda pair: pair[0]), key=lambda pair: pair[0][0]):
        below = [(way[1:], value) for way, value in group]
        ends = [value for way, value in below if not way]
        if ends and len(below) > 1:
            raise ValueError(f"{key!r} is both a value and a mapping")
        out[key] = ends[0] if ends else grown(below)
    return out


def merged(base: dict, over: dict) -> dict:
    """Two mappings as one: a leaf of the second takes the place of whatever the first has on its path or below it.

    An empty mapping says nothing where the first has a mapping.
    """
    kept = dict(leaves(base))
    for way, value in leaves(over):
        below = [k for k in kept if k[: len(way)] == way]
        if value == {} and isinstance(value, dict) and any(len(k) > len(way) or kept[k] == {} for k in below):
            continue
        for k in [*below, *(way[:n] for n in range(1, len(way)))]:
            kept.pop(k, None)
        kept[way] = value
    return grown(list(kept.items()))


def read_config(path: str | Path, _seen: tuple = ()) -> dict:
    """A configuration with what it extends; a circle is an error."""
    path = Path(path).resolve()
    if path in _seen:
        raise ValueError(f"configurations extend each other: {' -> '.join(p.name for p in (*_seen, path))}")
    own = read_yaml(path)
    parent = own.pop("extends", None)
    return merged(read_config(path.parent / parent, (*_seen, path)), own) if parent else own


def nested(flat: dict) -> dict:
    """Dotted keys as mappings in mappings; a key that is both a value and a mapping is an error."""
    return grown([(tuple(dotted.split(".")), value) for dotted, value in flat.items()])


def choice_name(overrides: dict) -> str:
    """A file name for overrides, another one for each."""
    return ",".join(f"{axis}={quote(str(value), safe='')}" for axis, value in overrides.items())


def unknown_keys(config: dict, known: Iterable[str]) -> list[str]:
    """Dotted paths of a configuration that nothing reads, sorted."""
    ways = {tuple(k.split(".")) for k in known}
    return sorted(".".join(way) for way, _ in leaves(config) if not any(way[: len(k)] == k for k in ways))


def sweep(spec: dict) -> list[tuple[str, dict]]:
    """A name and a configuration for each choice of a value on every axis."""
    axes = spec.get("axes")
    faults = [name for name, good in (("base", bool(spec.get("base"))), ("axes", isinstance(axes, dict) and bool(axes))) if not good]
    if faults:
        raise ValueError(f"a sweep needs a '{faults[0]}'")
    out: list[dict] = [{}]
    for axis, values in axes.items():
        out = [{**choice, axis: value} for choice in out for value in values]
    return [(choice_name(choice), nested(choice) | {"extends": spec["base"]}) for choice in out]


def read_registry(folder: str | Path) -> dict[str, object]:
    """All schema documents of a folder, by their ids or else their file names."""
    out = {}
    for path in sorted(Path(folder).glob("*.json")):
        document = json.loads(path.read_text(encoding="utf-8"))
        out[document.get("$id", path.name) if isinstance(document, dict) else path.name] = document
    return out
