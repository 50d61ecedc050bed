"""Output, control log, keys, settings, sources and streaming."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from emberlog import cli
from emberlog.config import Settings
from emberlog.functions.keys import bucket_count, computer_key, hash_key, round_robin_key
from emberlog.operators.match import tag_columns, tag_events
from emberlog.operators.output import emitted, metrics_messages, select_output
from emberlog.plans.rules import parse_rule
from emberlog.sources.kafka import auth_options, sink_options, source_options
from emberlog.streaming.control import entry, snapshot
from emberlog.streaming.job import build_stream, process_batch
from emberlog.streaming.windows import windowed

TEXT = "title: T\ndetection:\n  s: {a: 1}\n  condition: s"


def control(spark, *messages):
    return spark.createDataFrame([(i, m if m is None or isinstance(m, str) else json.dumps(m)) for i, m in enumerate(messages)], "seq long, value string")


def rule(rule_id, text=TEXT, job="j", **kw):
    return {"job_id": job, "case": {"id": rule_id}, "sigma": {"text": text}, **kw}


def test_snapshot(spark):
    log = control(
        spark, rule("r1"), rule("r2"), rule("r1", ""), rule("r1", TEXT.replace("T", "New", 1)), rule("r2", ""), rule("r3", job="other"), rule("bad", "x: ["), None, "", "{broken", rule(7), {"job_id": "j", "type": "what"},
        {"job_id": "j", "type": "filter", "filter_id": "f1", "filter_body": TEXT}, {"job_id": "j", "type": "filter", "filter_id": "f2", "filter_body": TEXT}, {"job_id": "j", "type": "filter", "filter_id": "f2", "deleted": True}, {"job_id": "j", "type": "filter"},
        {"job_id": "j", "type": "parser", "parser": {"config": {"steps": ["parse_json"]}}, "mapping": "a: b"}, {"job_id": "j", "type": "custom_fields", "custom_fields": "env: prod"},
    )
    s = snapshot(log, "j")
    assert [(r.rule_id, r.title) for r in s.rules] == [("r1", "New")] and [f.rule_id for f in s.filters] == ["f1"]
    assert s.mapping("a") == ["b", "a"] and s.parser == {"steps": ["parse_json"]} and s.custom_fields == {"env": "prod"} and set(s.errors) == {"bad"}
    assert snapshot(log, "j").signature == s.signature and snapshot(log, "none").rules == []
    assert entry('{"job_id":"j","case":null}') is None and entry("[]") is None


def test_output(spark):
    df = spark.createDataFrame([('{"a":1,"env":"x"}',), ('{"a":2}',), ('{"a":3}',)], "value string")
    r = parse_rule(TEXT, "r1", level="high", techniques=({"id": "T1", "name": None},))
    tagged = tag_events(df, [r], [parse_rule(TEXT.replace("a: 1", "a: 2"), "f")])
    assert [select_output(tagged, m, k).count() for m, k in (("all_events", False), ("all_events", True), ("matched_only", True))] == [2, 3, 1]
    out = [json.loads(x.value) for x in emitted(tagged, [r], "all_events", custom_fields={"env": "p"}).collect()]
    assert out[0] == {"a": 1, "env": "p", "sigma_rule_ids": ["r1"], "sigma_detections": [{"rule_id": "r1", "rule_title": "T", "severity": "high", "technique_ids": ["T1"], "techniques": [{"id": "T1", "name": None}]}]}
    assert out[1] == {"a": 3, "env": "p", "sigma_rule_ids": [], "sigma_detections": []}
    m = json.loads(metrics_messages(tagged, "j", F.lit(5).cast("long")).first().value)
    assert m == {"job_id": "j", "instance_id": 0, "timestamp": 5, "window_total_events": 3, "window_matched_events": 1, "rules": {"matched_rules": [{"rule_id": "r1", "window_matches": 1}]}}
    with pytest.raises(ValueError):
        select_output(tagged, "some")


def test_each_event_is_parsed_and_tested_once(spark):
    def plan(df, kind):
        return getattr(df._jdf.queryExecution(), kind)().toString()

    df = spark.range(3).selectExpr("to_json(named_struct('a', id)) AS value", "concat('x', id) AS a")
    rules = [parse_rule(f"detection:\n  s: {{a|contains: x}}\n  t: {{a|contains: '{i}'}}\n  condition: s and t", f"r{i}") for i in range(20)]
    for mode in ("matched_only", "all_events"):
        assert plan(select_output(tag_columns(df, rules), mode), "optimizedPlan").count("lower(") == 1
        assert plan(emitted(tag_events(df, rules), rules, mode), "executedPlan").count("ArrowEvalPython") == 2  # to parse, to merge
    assert select_output(tag_columns(df, rules)).count() == 3


def test_parser(spark):
    df = spark.createDataFrame([('{"raw":"{\\"a\\":1}"}',), ('{"raw":"{"}',)], "value string")
    r = parse_rule(TEXT, "r1")
    for parser, errors in (({"steps": ["parse_json"], "args": {}}, [False, True]), ({"steps": ["unknown"]}, [True, True])):
        tagged = tag_events(df, [r], parser=parser)
        assert [x.parse_error for x in tagged.collect()] == errors
    out = emitted(tag_events(df, [r], parser={"steps": ["parse_json"]}), [r], parsed_output=True).first().value
    assert json.loads(out)["a"] == 1


def test_keys(spark):
    texts = ['{"Computer":"PC1"}', '{"host":{"name":"x"}}', '{"winlog":{"computer_name":"W"}}', '{"a":1}', "{bad"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string").select(hash_key(F.col("v"), 7).alias("h"), hash_key(F.col("v"), None).alias("r"), round_robin_key(F.col("v")).alias("b"), computer_key(F.col("v")).alias("c")).collect()
    for t, r in zip(texts, rows):
        digest = hashlib.md5(t.encode()).hexdigest()
        assert (r.h, r.r, r.b) == (f"hash-{int(digest, 16) % 7}", digest, f"bucket-{int(digest, 16) % 100}")
    assert [r.c for r in rows] == ["pc1", "{'name': 'x'}", "w", "hash-0", "hash-0"]
    assert bucket_count(6, 2) == 12 and bucket_count(6, 1, True, 24) == 24


def test_settings(tmp_path):
    s = cli.parse(["--job-id", "j", "--output-topic", "o", "--keep-filtered-events"], {"INPUT_TOPICS": "a, b,", "WINDOW_SIZE_SECONDS": "5", "KAFKA_SSL_CHECK_HOSTNAME": "false"})
    assert s.input_topics == ["a", "b"] and s.window_size_seconds == 5 and s.keep_filtered_events and not s.apply_parser_to_output_events
    for bad in ({"parallelism": 0}, {"window_size_seconds": 4000}, {"output_mode": "x"}, {"keying_strategy": "x"}):
        with pytest.raises(ValueError):
            Settings(**bad)
    with pytest.raises(SystemExit):
        cli.parse(["--job-id", "j"], {})
    s = cli.parse(["--job-id", "j"], {"KAFKA_INPUT_TOPICS": "a", "INPUT_TOPICS": "b", "KAFKA_OUTPUT_TOPIC": "o", "KAFKA_RULES_TOPIC": "r", "METRICS_TOPIC": "m"})
    assert (s.input_topics, s.output_topic, s.rules_topic, s.metrics_topic) == (["a"], "o", "r", "m")
    pem = tmp_path / "c.pem"
    pem.write_text("PEM")
    ssl = Settings(kafka_auth_method="SSL", kafka_ssl_ca_location="ca", kafka_ssl_certificate_location=str(pem), kafka_ssl_key_location=str(pem), kafka_ssl_check_hostname=False, kafka_ssl_truststore_location="t.jks")
    o = auth_options(ssl)
    assert o["kafka.ssl.keystore.key"] == "PEM" and o["kafka.ssl.endpoint.identification.algorithm"] == "" and o["kafka.ssl.truststore.type"] == "JKS"
    assert "PlainLoginModule" in auth_options(Settings(kafka_auth_method="SASL"))["kafka.sasl.jaas.config"]
    assert source_options(Settings(starting_offsets="committed"), ["a", "b"])["startingOffsets"] == "earliest" and sink_options(Settings(), "o")["kafka.acks"] == "all"


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.txt").write_text('{"a":1}\n{"a":2}\nbad\n')
    out, metrics = [], []
    settings = Settings(job_id="j", checkpoint_path=str(tmp_path / "cp"), output_mode="all_events")
    events = spark.readStream.text(str(tmp_path / "in"))
    log = control(spark, rule("r1"))

    def run():
        build_stream(events, lambda: log, settings, lambda df, _: out.extend(r.value for r in df.collect()), lambda df, _: metrics.extend(r.value for r in df.collect()), {"availableNow": True}).awaitTermination(120)

    run()
    assert sorted(json.loads(x)["sigma_rule_ids"] for x in out) == [[], ["r1"]] and sum(json.loads(m)["window_total_events"] for m in metrics) == 2
    (tmp_path / "in/2.txt").write_text('{"a":1}\n')
    run()
    assert len(out) == 3  # the checkpoint goes on after the first file
    assert process_batch(events, snapshot(control(spark), "j"), Settings()) is None


def test_exact_windows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.txt").write_text("a\na\nb\n")
    keyed = spark.readStream.text(str(tmp_path / "in")).withColumn("k", F.col("value"))
    q = windowed(keyed, seconds=1, most=2).writeStream.format("memory").queryName("fired").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(processingTime="500 milliseconds").start()
    try:
        for i in range(40):
            (tmp_path / f"in/n{i}.txt").write_text("z\n")
            q.awaitTermination(1)
            got = [r.k for r in spark.table("fired").collect()]
            if got.count("a") == 2 and got.count("b") == 1:
                break
    finally:
        q.stop()
    assert got.count("a") == 2 and got.count("b") == 1
