"""One query for each operator, with SQL that states the same thing for DuckDB."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.keys import computer_key, hash_key, round_robin_key
from .operators.match import tag_columns, tag_events
from .operators.output import detections, emitted, metrics_messages, output_counts, select_output, top_rules, window_counts, rule_counts
from .plans.rules import FieldMapping, load_mapping, load_rules, parse_rule
from .sources.tables import as_json_events, table
from .streaming.control import latest, without_tombstones

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def _rule(detection: str, rule_id: str = "r1", **kw):
    return parse_rule("title: t\ndetection:\n" + "\n".join("  " + line for line in detection.strip("\n").split("\n")), rule_id, **kw)


def _one(name: str, source: str, key: str, detection: str, where: str, mapping: dict | None = None, columns: str = "*", raw: tuple[str, ...] = ()):
    """A query that gives the keys of a table's rows that one rule hits."""
    rule = _rule(detection)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, source)
        df = df if columns == "*" else df.selectExpr(*[c.strip() for c in columns.split(";")])
        return tag_columns(df, [rule], mapping=FieldMapping(mapping), raw=list(raw)).where("size(sigma_rule_ids) > 0").select(key)

    _query(name, f"SELECT {key} FROM {source} WHERE {where}")(run)


_one("rule_equals", "events", "event_id", "s: {event_type: ERROR}\ncondition: s", "lower(event_type) = 'error'")
_one("rule_in_list", "events", "event_id", "s: {event_type: [error, Click]}\ncondition: s", "event_type IN ('error', 'click')")
_one("rule_number", "part", "p_partkey", "s: {p_size: [7, 12]}\ncondition: s", "p_size IN (7, 12)")
_one("rule_contains", "documents", "doc_id", "s: {text|contains: License}\ncondition: s", "contains(lower(text), 'license')")
_one("rule_startswith", "part", "p_partkey", "s: {p_name|startswith: [p, B]}\ncondition: s", "starts_with(lower(p_name), 'p') OR starts_with(lower(p_name), 'b')")
_one("rule_endswith", "customer", "c_custkey", "s: {c_name|endswith: ['1', '7']}\ncondition: s", "ends_with(c_name, '1') OR ends_with(c_name, '7')")
_one("rule_contains_any", "documents", "doc_id", "s: {text|contains: [license, idiot, the of]}\ncondition: s", "contains(lower(text), 'license') OR contains(lower(text), 'idiot') OR contains(lower(text), 'the of')")
_one("rule_contains_all", "documents", "doc_id", "s: {text|contains|all: [the, und]}\ncondition: s", "contains(lower(text), 'the') AND contains(lower(text), 'und')")
_one("rule_wildcard_star", "customer", "c_custkey", "s: {c_name: 'c*1'}\ncondition: s", "regexp_matches(lower(c_name), '^c.*1$')")
_one("rule_wildcard_question", "orders", "o_orderkey", "s: {o_orderpriority: '?-*'}\ncondition: s", "regexp_matches(lower(o_orderpriority), '^.-.*$')")
_one("rule_wildcard_mixed", "events", "event_id", "s: {event_type: ['sign*', error]}\ncondition: s", "event_type LIKE 'sign%' OR event_type = 'error'")
_one("rule_null", "events", "event_id", "s: {kind: null}\ncondition: s", "event_type = 'view'", columns="event_id; nullif(event_type, 'view') AS kind")
_one("rule_null_mapped", "events", "event_id", "s: {kind: ''}\ncondition: s", "event_type = 'view' AND user_id % 2 = 0", {"kind": ["k2"]}, "event_id; nullif(event_type, 'view') AS kind; CASE WHEN user_id % 2 = 1 THEN 'x' END AS k2")
_one("rule_null_or_text", "events", "event_id", "s: {kind: [null, error]}\ncondition: s", "event_type IN ('view', 'error') OR user_id % 2 = 0", {"kind": ["k2"]}, "event_id; nullif(event_type, 'view') AS kind; CASE WHEN user_id % 2 = 1 THEN 'x' END AS k2")
_one("rule_field_mapping", "orders", "o_orderkey", "s: {Status: [f, 1-urgent]}\ncondition: s", "lower(o_orderstatus) = 'f' OR lower(o_orderpriority) = '1-urgent'", {"Status": ["o_orderstatus", "o_orderpriority"]})
_one("rule_not", "events", "event_id", "s: {event_type: error}\ncondition: not s", "event_type <> 'error'")
_one("rule_precedence", "orders", "o_orderkey", "a: {o_orderstatus: F}\nb: {o_orderstatus: O}\nc: {o_orderpriority|startswith: '1'}\ncondition: a or b and not c", "o_orderstatus = 'F' OR (o_orderstatus = 'O' AND NOT starts_with(o_orderpriority, '1'))")
_one("rule_parens", "orders", "o_orderkey", "a: {o_orderstatus: F}\nb: {o_orderstatus: O}\nc: {o_orderpriority|startswith: '1'}\ncondition: (a or b) AND NOT (c)", "o_orderstatus IN ('F', 'O') AND NOT starts_with(o_orderpriority, '1')")
_one("rule_one_of", "events", "event_id", "sel_a: {event_type: error}\nsel_b: {event_type: click}\nother: {event_type: view}\ncondition: 1 of sel_*", "event_type IN ('error', 'click')")
_one("rule_all_of", "documents", "doc_id", "sel_a: {lang: en}\nsel_b: {text|contains: the}\ncondition: all of sel_*", "lang = 'en' AND contains(lower(text), 'the')")
_one("rule_them", "events", "event_id", "a: {event_type: error}\n_b: {event_type: click}\ncondition: 1 of them", "event_type = 'error'")
_one("rule_list_of_maps", "orders", "o_orderkey", "s:\n  - {o_orderstatus: F, o_orderpriority|startswith: '1'}\n  - {o_orderstatus: P}\ncondition: s", "(o_orderstatus = 'F' AND starts_with(o_orderpriority, '1')) OR o_orderstatus = 'P'")
_one("rule_keywords", "customer", "c_custkey", "k: [BUILDING, 'name\":\"customer#000000001']\ncondition: k",
     "contains(lower('{\"c_name\":\"' || c_name || '\",\"c_mktsegment\":\"' || c_mktsegment || '\"}'), 'building') OR contains(lower('{\"c_name\":\"' || c_name || '\"'), 'name\":\"customer#000000001')", raw=("c_name", "c_mktsegment"))
_MANY = [f"the{a}{b}" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"][:501]
_one("rule_contains_501", "part", "p_partkey", "s: {p_name|contains: " + json.dumps(_MANY + ["a"]) + "}\ncondition: s", "contains(lower(p_name), 'a') OR " + " OR ".join(f"contains(lower(p_name), '{v}')" for v in _MANY))


@_query("json_flatten", "SELECT event_id, lower(json_extract_string(props, '$.k')) AS k, event_type FROM events WHERE event_type <> 'view' AND CAST(json_extract_string(props, '$.k') AS BIGINT) IN (1, 2, 3, 42)")
def _json_flatten(spark, d):
    rule = _rule("s: {props.k: [1, 2, 3, 42]}\nn: {event.type: view}\ncondition: s and not n")
    df = table(spark, d, "events").select("event_id", "event_type", F.format_string('{"props":%s,"event":{"type":"%s"}}', "props", "event_type").alias("value"))
    return tag_events(df, [rule]).where("size(sigma_rule_ids) > 0").select("event_id", F.get_json_object("value", "$.props.k").alias("k"), "event_type")


_RULES = [
    _rule("s: {event_type: error}\ncondition: s", "r-error", title="Errors", level="high", techniques=({"id": "T1", "name": "One"}, {"id": None, "name": "None"})),
    _rule("s: {event_type: [error, purchase]}\ncondition: s", "r-two", level="low"),
    _rule("s: {props|contains: '7'}\nn: {event_type: view}\ncondition: s and not n", "r-seven", techniques=({"id": "T2", "name": None},)),
]
_FILTERS = [_rule("s: {event_type: click}\ncondition: s", "f1")]
_IDS_SQL = "array_to_string(list_filter([CASE WHEN event_type = 'error' THEN 'r-error' END, CASE WHEN contains(props, '7') AND event_type <> 'view' THEN 'r-seven' END, CASE WHEN event_type IN ('error', 'purchase') THEN 'r-two' END], lambda x: x IS NOT NULL), ',')"
_TAGGED_SQL = f"SELECT *, event_type = 'click' AS prefiltered, CASE WHEN event_type = 'click' THEN '' ELSE {_IDS_SQL} END AS ids FROM events"


def _tagged(spark, d):
    return tag_columns(table(spark, d, "events"), _RULES, _FILTERS)


def _ids():
    return F.concat_ws(",", "sigma_rule_ids").alias("ids")


@_query("multi_rule_ids", f"SELECT event_id, {_IDS_SQL} AS ids FROM events")
def _multi(spark, d):
    return tag_columns(table(spark, d, "events"), _RULES).select("event_id", _ids())


@_query("prefilter", f"SELECT event_id, prefiltered, ids FROM ({_TAGGED_SQL})")
def _prefilter(spark, d):
    return _tagged(spark, d).select("event_id", "prefiltered", _ids())


@_query("output_matched_only", f"SELECT event_id, ids FROM ({_TAGGED_SQL}) WHERE ids <> ''")
def _matched(spark, d):
    return select_output(_tagged(spark, d), "matched_only", True).select("event_id", _ids())


@_query("output_all", f"SELECT event_id, ids FROM ({_TAGGED_SQL}) WHERE NOT prefiltered")
def _all(spark, d):
    return select_output(_tagged(spark, d), "all_events").select("event_id", _ids())


@_query("prefilter_keep", f"SELECT event_id, ids FROM ({_TAGGED_SQL})")
def _keep(spark, d):
    return select_output(_tagged(spark, d), "all_events", True).select("event_id", _ids())


@_query("enrich_detections", f"""SELECT event_id, rule_id, rule_title, severity, technique_ids, names FROM (SELECT event_id, unnest(string_split(ids, ',')) AS rule_id FROM ({_TAGGED_SQL}) WHERE ids <> '')
 JOIN (VALUES ('r-error', 'Errors', 'high', 'T1', 'One,None'), ('r-two', 't', 'low', '', ''), ('r-seven', 't', NULL, 'T2', '')) AS m(rule_id, rule_title, severity, technique_ids, names) USING (rule_id)""")
def _enrich(spark, d):
    rows = _tagged(spark, d).select("event_id", F.explode(detections(F.col("sigma_rule_ids"), _RULES)).alias("x"))
    return rows.select("event_id", "x.rule_id", "x.rule_title", "x.severity", F.concat_ws(",", "x.technique_ids").alias("technique_ids"), F.concat_ws(",", "x.techniques.name").alias("names"))


@_query("custom_fields", f"SELECT event_id, 'prod' AS env, 'error' AS event_type, 'r-error' AS first_rule FROM events WHERE event_type = 'error'")
def _custom(spark, d):
    events = as_json_events(table(spark, d, "events").select("event_id", "event_type", F.lit("x").alias("env")))
    rule = _RULES[0]
    out = emitted(tag_events(events, [rule]), [rule], custom_fields={"env": "prod"})
    return out.select(F.get_json_object("value", "$.event_id").cast("long").alias("event_id"), F.get_json_object("value", "$.env").alias("env"), F.get_json_object("value", "$.event_type").alias("event_type"), F.get_json_object("value", "$.sigma_detections[0].rule_id").alias("first_rule"))


_COUNTS_SQL = f"SELECT rule_id, count(*) AS window_matches FROM (SELECT unnest(string_split(ids, ',')) AS rule_id FROM ({_TAGGED_SQL}) WHERE ids <> '') GROUP BY rule_id"


@_query("rule_counts", _COUNTS_SQL)
def _counts(spark, d):
    return rule_counts(_tagged(spark, d))


@_query("top_rules", _COUNTS_SQL + " ORDER BY window_matches DESC, rule_id LIMIT 3")
def _top(spark, d):
    return top_rules(_tagged(spark, d))


_KEY_SQL = "'hash-' || CAST(CAST(concat('0x', md5(props)) AS UHUGEINT) % 7 AS VARCHAR)"


@_query("window_metrics", f"SELECT {_KEY_SQL} AS k, count(*) AS total_events, count(*) FILTER (ids <> '') AS matched_events, count(*) FILTER (prefiltered) AS prefiltered_events FROM ({_TAGGED_SQL}) GROUP BY 1")
def _window(spark, d):
    return window_counts(_tagged(spark, d).withColumn("k", hash_key(F.col("props"), 7)), ["k"]).drop("match_rate")


@_query("match_rate", f"SELECT round(100.0 * count(*) FILTER (ids <> '') / count(*), 2) AS match_rate FROM ({_TAGGED_SQL})")
def _rate(spark, d):
    return window_counts(_tagged(spark, d)).select("match_rate")


@_query("output_counts", f"SELECT count(*) FILTER (ids <> '') AS output_tagged, count(*) FILTER (ids = '') AS output_untagged FROM ({_TAGGED_SQL}) WHERE NOT prefiltered")
def _written(spark, d):
    return output_counts(select_output(_tagged(spark, d), "all_events"))


@_query("metrics_message", f"SELECT {_KEY_SQL} AS k, count(*) AS total, count(*) FILTER (event_type = 'error') AS matched FROM events GROUP BY 1")
def _messages(spark, d):
    rows = tag_columns(table(spark, d, "events").withColumn("k", hash_key(F.col("props"), 7)), [_RULES[0]])
    m = metrics_messages(rows, "job", F.lit(0).cast("long"), ["k"])
    return m.select("k", F.get_json_object("value", "$.window_total_events").cast("long").alias("total"), F.coalesce(F.get_json_object("value", "$.rules.matched_rules[0].window_matches").cast("long"), F.lit(0).cast("long")).alias("matched"))


@_query("key_hash", f"SELECT event_id, {_KEY_SQL} AS k FROM events")
def _key_hash(spark, d):
    return table(spark, d, "events").select("event_id", hash_key(F.col("props"), 7).alias("k"))


@_query("key_round_robin", "SELECT event_id, 'bucket-' || CAST(CAST(concat('0x', md5(props)) AS UHUGEINT) % 100 AS VARCHAR) AS k FROM events")
def _key_rr(spark, d):
    return table(spark, d, "events").select("event_id", round_robin_key(F.col("props")).alias("k"))


@_query("key_raw", "SELECT event_id, md5(props) AS k FROM events")
def _key_raw(spark, d):
    return table(spark, d, "events").select("event_id", hash_key(F.col("props"), None).alias("k"))


@_query("key_computer", "SELECT event_id, CASE WHEN event_type = 'view' THEN 'hash-0' ELSE 'host' || CAST(user_id % 5 AS VARCHAR) END AS k FROM events")
def _key_computer(spark, d):
    e = table(spark, d, "events")
    value = F.when(F.col("event_type") == "view", F.lit('{"a":1}')).otherwise(F.format_string('{"winlog":{"computer_name":"HOST%d"}}', F.col("user_id") % 5))
    return e.select("event_id", computer_key(value).alias("k"))


_TEXT = "detection:\n  s: {a: b}\n  condition: s"


@_query("control_latest", """WITH log AS (SELECT o_orderkey AS seq, 'job' || CAST(o_custkey % 2 AS VARCHAR) AS job, 'r' || CAST(o_custkey % 97 AS VARCHAR) AS id, o_orderstatus = 'P' AS gone FROM orders)
 SELECT id, seq FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS n FROM log WHERE job = 'job1') WHERE n = 1 AND NOT gone""")
def _control(spark, d):
    text = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.lit(_TEXT))
    message = F.to_json(F.struct(F.concat(F.lit("job"), (F.col("o_custkey") % 2).cast("string")).alias("job_id"), F.struct(F.concat(F.lit("r"), (F.col("o_custkey") % 97).cast("string")).alias("id")).alias("case"), F.struct(text.alias("text")).alias("sigma"), F.col("o_orderkey").alias("n")))
    log = table(spark, d, "orders").select(message.alias("value"), F.col("o_orderkey").alias("seq"))
    return latest(log, "job1").select("id", F.get_json_object("value", "$.n").cast("long").alias("seq"))


@_query("rule_loading", "SELECT * FROM (VALUES ('bad', 'left out'), ('good', 'Named')) AS t(rule_id, title)")
def _loading(spark, d):
    given = [{"case": {"id": "good", "name": "Named"}, "sigma": {"text": _TEXT}}, {"case": {"id": "bad"}, "sigma": {"text": _TEXT.replace("a:", "a|re:")}}, {"sigma": {}}]
    rules, errors = load_rules(given)
    return spark.createDataFrame([(r.rule_id, r.title) for r in rules] + [(k, "left out") for k in errors if k[0] != "#"], "rule_id string, title string")


@_query("mapping_loading", "SELECT c_custkey FROM customer WHERE lower(c_mktsegment) = 'building' OR lower(c_name) = 'building'")
def _mapping(spark, d):
    mapping = load_mapping("Segment: [c_mktsegment, '', c_name]\nempty:\n")
    return tag_columns(table(spark, d, "customer"), [_rule("s: {Segment: Building}\ncondition: s")], mapping=mapping).where("size(sigma_rule_ids) > 0").select("c_custkey")


@_query("union_sources", "SELECT 'documents' AS topic, count(*) AS n FROM documents WHERE contains(lower(text), 'the') UNION ALL SELECT 'conversations', count(*) FROM conversations WHERE contains(lower(text), 'the')")
def _union(spark, d):
    parts = [table(spark, d, t).select("text", F.lit(t).alias("topic")) for t in ("documents", "conversations")]
    rows = tag_columns(parts[0].unionByName(parts[1]), [_rule("s: {text|contains: the}\ncondition: s")])
    return rows.where("size(sigma_rule_ids) > 0").groupBy("topic").agg(F.count("*").alias("n"))


@_query("tombstones", "SELECT event_id, event_type AS value FROM events WHERE event_type NOT IN ('view', 'click')")
def _tombstones(spark, d):
    value = F.when(F.col("event_type") == "click", F.lit("")).otherwise(F.expr("nullif(event_type, 'view')")).cast("binary")
    return without_tombstones(table(spark, d, "events").select("event_id", value.alias("value")))


@_query("parse_errors", "SELECT event_id FROM events WHERE event_type NOT IN ('view', 'click')")
def _parse_errors(spark, d):
    value = F.when(F.col("event_type") == "view", F.lit("{broken")).when(F.col("event_type") == "click", F.lit("[1]")).otherwise(F.col("props"))
    return tag_events(table(spark, d, "events").select("event_id", value.alias("value")), []).select("event_id")


@_query("schema_parser", "SELECT event_id, event_type = 'view' AS parse_error, event_type = 'error' AS hit FROM events")
def _schema_parser(spark, d):
    inner = F.when(F.col("event_type") == "view", F.lit("{broken")).otherwise(F.to_json(F.struct("event_type")))
    df = table(spark, d, "events").select("event_id", F.to_json(F.struct(inner.alias("raw"))).alias("value"))
    rows = tag_events(df, [_RULES[0]], parser={"steps": ["parse_json"], "args": {}})
    return rows.select("event_id", "parse_error", (F.size("sigma_rule_ids") > 0).alias("hit"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules with a prefilter over JSON events, counted by rule."""
    return rule_counts(tag_events(as_json_events(table(spark, sf_dir, "events")), _RULES, _FILTERS))
