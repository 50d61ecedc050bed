"""Event JSON: parsing, flattening and merging."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PARSED = "ok boolean, failed boolean, raw string, values array<string>, event string"


def _no_constant(name: str):
    raise ValueError(name)


def loads(text: str):
    return json.loads(text, parse_constant=_no_constant)


def dumps(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def flatten(event: dict) -> dict[str, str]:
    """Dotted names to lower-cased text. Only objects are entered; null is '', other values are their Python text.

    Of equal names the deeper one stays, and among siblings that which came first.
    """
    out: dict[str, str] = {}
    levels = [("", event)]
    while levels:
        prefix, node = levels.pop()
        for key, value in node.items():
            name = f"{prefix}.{key}" if prefix else key
            if isinstance(value, dict):
                levels.append((name, value))
            else:
                out[name] = "" if value is None else str(value).lower()
    return out


#: Parsing steps by name: each takes the event and its arguments and returns the event.
STEPS: dict[str, Callable[[dict, dict], dict]] = {}


def step(name: str):
    def register(f):
        STEPS[name] = f
        return f

    return register


@step("parse_json")
def _parse_json(event: dict, args: dict) -> dict:
    """JSON text in a field (args: field, default `raw`) is read and its keys join the event."""
    name = args.get("field", "raw")
    if not isinstance(event.get(name), str):
        return event
    inner = loads(event[name])
    if not isinstance(inner, dict):
        raise ValueError("no object")
    return {**event, **inner}


def run_parser(event: dict, parser: dict | None) -> tuple[dict, bool]:
    """The event after the parser's steps; after a failure a copy that is marked, and True."""
    if not parser:
        return event, False
    try:
        for name in parser.get("steps", []):
            args = parser.get("args") or {}
            event = STEPS[name](event, args.get(name, args) if isinstance(args, dict) else {})
        return event, False
    except Exception:  # noqa: BLE001  a parser may fail in any way; the event stays
        return {**event, "_detect_flow_parser_failed": True}, True


def parsed(value: Column, fields: list[str], with_raw: bool, parser: dict | None = None) -> Column:
    """A struct from event JSON: ok (an object), failed (its parser did), raw (compact JSON, lower-cased),
    values (of the fields, '' where missing), event (compact JSON after the parser). Null and malformed JSON
    and other values than objects are not ok. Declared non-deterministic, so that filters on the result don't
    go below it, where each would parse once more."""
    names = list(fields)

    def parse(text):
        try:
            event = loads(text)
        except (TypeError, ValueError, RecursionError):
            return False, False, None, None, None
        if not isinstance(event, dict):
            return False, False, None, None, None
        event, failed = run_parser(event, parser)
        whole = dumps(event) if with_raw or parser else None
        flat = flatten(event)
        return True, failed, whole.lower() if with_raw else None, [flat.get(n, "") for n in names], whole if parser else None

    return F.udf(parse, PARSED, useArrow=True).asNondeterministic()(value)


def merged(event: Column, extra: dict | None, ids: Column, detections_json: Column) -> Column:
    """Event JSON with the keys of extra over its own, then sigma_rule_ids and sigma_detections; null if it can't be written."""

    def merge(text, rule_ids, detections):
        try:
            out = loads(text)
            out.update(extra or {})
            out["sigma_rule_ids"] = list(rule_ids) if rule_ids is not None else []
            out["sigma_detections"] = json.loads(detections) if detections else []
            return dumps(out)
        except (TypeError, ValueError, AttributeError):
            return None

    return F.udf(merge, "string", useArrow=True).asNondeterministic()(event, ids, detections_json)
