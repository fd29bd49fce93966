"""A plain Python model of step and record checks, written for the tests only."""

import json
import re

from stepledger.domain import DEFAULT
from stepledger.functions.schema import Validator

WRAP = re.compile(r"\s*<think>(.*?)</think>\s*(.*)\Z", re.S)
NAMES = ("parse", "schema", "method_known", "precondition_met", "transition_valid", "sequence_optimal")


def step(output, state, trigger=None, after=None, infer=False, domain=DEFAULT):
    """(passed, six subscores, new_state)."""
    nothing = (False, (0.0,) * 6, None)
    m = WRAP.match(output) if output is not None else None
    if not m:
        return nothing
    try:
        call = json.loads(m[2].strip())
    except (ValueError, RecursionError):
        return nothing
    if not isinstance(call, dict) or not {"jsonrpc", "method", "params", "id"} <= call.keys() or call["jsonrpc"] != "2.0":
        return nothing
    method = call["method"]
    if not isinstance(method, str) or method not in domain.params:
        return False, (1.0,) + (0.0,) * 5, None
    if state is None:
        return nothing
    schema = Validator(domain.params[method]).is_valid(call["params"])
    triggers = domain.triggers.get(method, ())
    if not triggers:
        return schema, (1.0, float(schema), 1.0, 1.0, 1.0, 1.0), state
    open_ = [t for t in triggers if (state, t) in domain.arcs]
    to = None
    if infer and not trigger:
        best = [t for t in open_ if after and domain.arcs[state, t] == after] or open_
        if best:
            to = domain.arcs[state, best[0]]
    elif trigger in triggers:
        to = domain.arcs.get((state, trigger))
    if after is not None and to != after:
        to = None
    moved = float(to is not None)
    can = float(bool(open_))
    return bool(schema and can and moved), (1.0, float(schema), 1.0, can, moved, moved), to


def record(steps, outputs, initial, final=None, domain=DEFAULT):
    """(passed, number of results, final_state, first failed step)."""
    if len(steps) != len(outputs):
        return False, 0, None, None
    if not steps:
        return False, 0, initial, None
    state, results = initial, []
    for s, o in zip(steps, outputs):
        r = step(o, state, s[0], s[1], domain=domain)
        results.append(r)
        if r[0] and r[2] is not None:
            state = r[2]
    failed = next((i for i, r in enumerate(results) if not r[0]), None)
    passed = failed is None and (final is None or final == state)
    return passed, len(results), state, failed
