"""The control log: rules, filters, parser and custom fields, as of its latest messages."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.events import loads
from ..plans.rules import FieldMapping, Rule, load_filters, load_mapping, load_rules

ENTRY = "job_id string, kind string, id string, deleted boolean"


def without_tombstones(df: DataFrame, value: str = "value") -> DataFrame:
    """Kafka values as text, without null and empty ones."""
    return df.withColumn(value, F.col(value).cast("string")).where(F.col(value).isNotNull() & (F.length(value) > 0))


def entry(text: str) -> tuple[str, str, str, bool] | None:
    """(job_id, kind, id, deleted) of a message, or None for one that is malformed or of no known kind.

    A rule has a case.id that is non-empty text, and type rule or none; it is deleted by an empty
    sigma.text. The others are deleted by deleted: true.
    """
    try:
        m = loads(text)
        job_id, kind = m.get("job_id"), m.get("type")
        rule_id = m.get("case", {}).get("id")
        if not isinstance(job_id, str):
            return None
        if isinstance(rule_id, str) and rule_id and (kind == "rule" or not kind):
            return job_id, "rule", rule_id, not m.get("sigma", {}).get("text")
        if kind in ("parser", "custom_fields"):
            return job_id, kind, "default", m.get("deleted") is True
        if kind == "filter" and m.get("filter_id"):
            return job_id, kind, str(m["filter_id"]), m.get("deleted") is True
    except Exception:  # noqa: BLE001  one message never stops the others
        pass
    return None


def latest(control: DataFrame, job_id: str | None = None) -> DataFrame:
    """(job_id, kind, id, value): the newest message of each key in control(value, seq), deleted ones left out."""
    rows = without_tombstones(control).withColumn("e", F.udf(entry, ENTRY, useArrow=True).asNondeterministic()("value")).where("e.kind IS NOT NULL")
    if job_id is not None:
        rows = rows.where(F.col("e.job_id") == job_id)
    newest = rows.groupBy("e.job_id", "e.kind", "e.id").agg(F.max_by(F.when(~F.col("e.deleted"), F.col("value")), "seq").alias("value"))
    return newest.where("value IS NOT NULL")


@dataclass
class Snapshot:
    rules: list[Rule] = field(default_factory=list)
    filters: list[Rule] = field(default_factory=list)
    mapping: FieldMapping = field(default_factory=FieldMapping)
    parser: dict | None = None
    custom_fields: dict | None = None
    signature: str = ""
    errors: dict[str, str] = field(default_factory=dict)


_LOADED: dict[str, tuple[list[Rule], dict[str, str]]] = {}


def _rules(texts: dict[str, str]) -> tuple[list[Rule], dict[str, str], str]:
    """Rules parsed once for each content: the signature is over ids and texts in order."""
    digest = hashlib.sha1()
    for rule_id, text in sorted(texts.items()):
        digest.update(rule_id.encode() + b"\0" + text.encode() + b"\n")
    key = digest.hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = load_rules([loads(t) for _, t in sorted(texts.items())])
    return *_LOADED[key], key


def snapshot(control: DataFrame, job_id: str) -> Snapshot:
    """The tenant's state. The log is compacted in Spark; what comes to the driver are its rules."""
    texts: dict[str, dict[str, str]] = {}
    for r in latest(control, job_id).select("kind", "id", "value").toLocalIterator():
        texts.setdefault(r.kind, {})[r.id] = r.value
    rules, errors, key = _rules(texts.get("rule", {}))
    bodies = {i: loads(t).get("filter_body") for i, t in texts.get("filter", {}).items()}
    filters, bad = load_filters({i: b for i, b in bodies.items() if isinstance(b, str)})
    out = Snapshot(rules, filters, signature=key, errors={**errors, **bad})
    if "default" in texts.get("parser", {}):
        m = loads(texts["parser"]["default"])
        parser = m.get("parser")
        out.parser = parser.get("config") if isinstance(parser, dict) and isinstance(parser.get("config"), dict) else None
        out.mapping = load_mapping(m.get("mapping") if isinstance(m.get("mapping"), str) else None)
    if "default" in texts.get("custom_fields", {}):
        try:
            fields = yaml.safe_load(loads(texts["custom_fields"]["default"]).get("custom_fields") or "")
            out.custom_fields = fields if isinstance(fields, dict) else None
        except (yaml.YAMLError, AttributeError, TypeError):
            out.custom_fields = None
    return out
