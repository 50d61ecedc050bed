"""What is emitted: enriched events and window metrics."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import events
from ..plans.rules import Rule
from .match import IDS

DETECTION = "struct<rule_id:string,rule_title:string,severity:string,technique_ids:array<string>,techniques:array<struct<id:string,name:string>>>"


def detection(rule: Rule) -> dict:
    return {"rule_id": rule.rule_id, "rule_title": rule.title, "severity": rule.level, "technique_ids": rule.technique_ids, "techniques": list(rule.techniques)}


def detections(ids: Column, rules: list[Rule]) -> Column:
    """The metadata of each id, from a map that is part of the plan; the rules are few against the events."""
    if not rules:
        return F.array().cast(f"array<{DETECTION}>")
    known = F.from_json(F.lit(json.dumps({r.rule_id: detection(r) for r in rules})), f"map<string,{DETECTION}>")
    return F.filter(F.transform(ids, lambda i: F.try_element_at(known, i)), lambda d: d.isNotNull())


def select_output(tagged: DataFrame, mode: str = "matched_only", keep_filtered: bool = False) -> DataFrame:
    """Without keep_filtered, prefiltered events go; with matched_only, all without a rule."""
    if mode not in ("matched_only", "all_events"):
        raise ValueError(f"output mode {mode!r}")
    out = tagged if keep_filtered else tagged.where("NOT prefiltered")
    return out.where(F.size(IDS) > 0) if mode == "matched_only" else out


def emitted(tagged: DataFrame, rules: list[Rule], mode: str = "matched_only", keep_filtered: bool = False, custom_fields: dict | None = None, parsed_output: bool = False, value: str = "value") -> DataFrame:
    """One column, value: the output JSON. Custom fields are merged after matching, over the event's own."""
    rows = select_output(tagged, mode, keep_filtered)
    event = F.coalesce("parsed_event", value) if parsed_output and "parsed_event" in rows.columns else F.col(value)
    # nulls inside the metadata are part of the output
    found = F.to_json(detections(F.col(IDS), rules), {"ignoreNullFields": "false"})
    return rows.select(events.merged(event, custom_fields, F.col(IDS), found).alias("value")).where("value IS NOT NULL")


def rule_counts(tagged: DataFrame, by: list[str] = ()) -> DataFrame:
    return tagged.select(*by, F.explode(IDS).alias("rule_id")).groupBy(*by, "rule_id").agg(F.count("*").alias("window_matches"))


def top_rules(tagged: DataFrame, n: int = 3) -> DataFrame:
    return rule_counts(tagged).orderBy(F.desc("window_matches"), "rule_id").limit(n)


def window_counts(tagged: DataFrame, by: list[str] = ()) -> DataFrame:
    """Events, matched and prefiltered ones, the match rate in percent (0 without events)."""
    matched = F.count_if(F.size(IDS) > 0)
    rate = F.when(F.count("*") > 0, F.round(100 * matched / F.count("*"), 2)).otherwise(0.0)
    return tagged.groupBy(*by).agg(F.count("*").alias("total_events"), matched.alias("matched_events"), F.count_if("prefiltered").alias("prefiltered_events"), rate.alias("match_rate"))


def output_counts(rows: DataFrame) -> DataFrame:
    """Tagged and untagged events among those that are really written."""
    return rows.agg(F.count_if(F.size(IDS) > 0).alias("output_tagged"), F.count_if(F.size(IDS) == 0).alias("output_untagged"))


def metrics_messages(tagged: DataFrame, job_id: str, timestamp: Column | None = None, by: list[str] = (), instance_id: int = 0) -> DataFrame:
    """One JSON message for each key: totals, and rules by falling count, then id."""
    tagged = tagged.select("*", F.lit("all").alias("__all")) if not by else tagged
    key = list(by) or ["__all"]
    counts = rule_counts(tagged, key).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct((-F.col("window_matches")).alias("o"), "rule_id", "window_matches"))).alias("r"))
    listed = F.transform(F.coalesce("r", F.array().cast("array<struct<o:bigint,rule_id:string,window_matches:bigint>>")), lambda x: F.struct(x["rule_id"].alias("rule_id"), x["window_matches"].alias("window_matches")))
    now = F.unix_millis(F.current_timestamp()) if timestamp is None else timestamp
    message = F.struct(
        F.lit(job_id).alias("job_id"), F.lit(instance_id).alias("instance_id"), now.alias("timestamp"), F.col("total_events").alias("window_total_events"),
        F.col("matched_events").alias("window_matched_events"), F.struct(listed.alias("matched_rules")).alias("rules"),
    )
    return window_counts(tagged, key).join(counts, key, "left").select(*by, F.to_json(message).alias("value"))
