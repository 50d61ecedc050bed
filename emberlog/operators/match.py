"""Matching: every rule over every event, in one plan without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import events
from ..plans.rules import RAW_EVENT, FieldMapping, Rule
from ..plans.sql import Compiled, literal

IDS = "sigma_rule_ids"


def _compile(rules: list[Rule], filters: list[Rule], mapping: FieldMapping | None):
    compiled = Compiled(mapping)
    hit = " OR ".join(compiled.expression(f.tree) for f in filters) or "false"
    cases = [f"CASE WHEN {compiled.expression(r.tree)} THEN {literal(r.rule_id)} END" for r in sorted(rules, key=lambda r: r.rule_id)]
    return compiled, hit, cases


def _tagged(df: DataFrame, keep: list[str], compiled: Compiled, hit: str, cases: list[str]) -> DataFrame:
    if df.sparkSession.conf.get("spark.sql.parser.escapedStringLiterals", "false") == "true":
        raise ValueError("spark.sql.parser.escapedStringLiterals has to be false")
    names = [f"`{c}`" for c in keep]
    ids = f"array_compact(array({', '.join(cases)}))" if cases else "CAST(array() AS array<string>)"
    tested = df.selectExpr(*names, *[f"{test} AS {name}" for test, name in compiled.tests.items()])
    flagged = tested.selectExpr(*names, *compiled.tests.values(), f"({hit}) AS prefiltered")
    # a partition's number is never below 0: it only keeps filters on the result above this projection. Pushed below, they would
    # spell out each test in every rule that has it. Filters on other columns belong before the tagging.
    return flagged.selectExpr(*names, "prefiltered", f"CASE WHEN prefiltered OR spark_partition_id() < 0 THEN CAST(array() AS array<string>) ELSE {ids} END AS {IDS}")


def tag_events(df: DataFrame, rules: list[Rule], filters: list[Rule] = (), mapping: FieldMapping | None = None, parser: dict | None = None, value: str = "value") -> DataFrame:
    """df with JSON events in `value`, less those that are no JSON objects, plus parsed_event (null without a
    parser), parse_error, prefiltered, and sigma_rule_ids, in order of id. An event that a filter hits matches no rule."""
    compiled, hit, cases = _compile(rules, list(filters), mapping)
    names = [n for n in compiled.columns if n != RAW_EVENT]
    kept = [*df.columns, "parsed_event", "parse_error"]
    parsed = df.withColumn("__p", events.parsed(F.col(value), names, RAW_EVENT in compiled.columns, parser)).where("__p.ok")
    columns = [F.coalesce(F.col("__p.values")[i], F.lit("")).alias(compiled.columns[n]) for i, n in enumerate(names)]
    if RAW_EVENT in compiled.columns:
        columns.append(F.col("__p.raw").alias(compiled.columns[RAW_EVENT]))
    frame = parsed.select(*df.columns, F.col("__p.event").alias("parsed_event"), F.col("__p.failed").alias("parse_error"), *columns)
    return _tagged(frame, kept, compiled, hit, cases)


def tag_columns(df: DataFrame, rules: list[Rule], filters: list[Rule] = (), mapping: FieldMapping | None = None, raw: list[str] = ()) -> DataFrame:
    """The same for a table whose columns are the fields: no Python at all. Names that are no columns count as empty.

    Keyword rules look at the compact JSON of the columns in `raw`.
    """
    compiled, hit, cases = _compile(rules, list(filters), mapping)
    have = {c.lower(): c for c in df.columns}
    columns = []
    for name, short in compiled.columns.items():
        if name == RAW_EVENT:
            column = F.lower(F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw]), {"ignoreNullFields": "false"}))
        elif name in df.columns or name.lower() in have:
            column = F.coalesce(F.lower(F.col(f"`{have[name.lower()]}`").cast("string")), F.lit(""))
        else:
            column = F.lit("")
        columns.append(column.alias(short))
    return _tagged(df.select("*", *columns), df.columns, compiled, hit, cases)
