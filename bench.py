"""Headline queries, timed: one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parent}:{os.environ.get('PYTHONPATH', '')}"


def many_rules(n: int):
    """n rules of four tests each, drawn from sixty distinct tests, as rule sets share most of theirs."""
    import random

    from emberlog.plans.rules import parse_rule

    rng = random.Random(1)
    words = [f"{a}{b}" for a in ("the", "and", "ver", "tion", "ing", "est") for b in ("", "a", "e", "o", "s")]
    tests = [f"lang: [{x}, xx]" for x in ("en", "de", "fr", "es")] + [f"text|contains: {w}" for w in words] + [f"source|startswith: src{i}" for i in range(10)]
    out = []
    for i in range(n):
        a, b, c, d = rng.sample(tests, 4)
        out.append(parse_rule(f"detection:\n  a: {{{a}}}\n  b: {{{b}}}\n  c: {{{c}}}\n  d: {{{d}}}\n  condition: (a or b) and c and not d", f"r{i:04}"))
    return out


def main() -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from emberlog.operators.match import tag_columns, tag_events
    from emberlog.operators.output import select_output
    from emberlog.queries import flagship
    from emberlog.sources.tables import as_json_events, table

    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map={"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.sql.files.maxPartitionBytes": "4m", "spark.ui.showConsoleProgress": "false"}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    docs, events = table(spark, folder, "documents"), table(spark, folder, "events")

    def hits(rules):
        return lambda: tag_columns(docs, rules).agg(F.sum(F.size("sigma_rule_ids"))).collect()

    runs = {f"match_{n}_rules": hits(many_rules(n)) for n in (10, 100, 1000)}
    for n in (100, 1000):
        runs[f"matched_only_{n}_rules"] = lambda n=n: select_output(tag_columns(docs, many_rules(n))).agg(F.sum(F.size("sigma_rule_ids"))).collect()
    runs["json_match_rules"] = lambda: tag_events(as_json_events(events), many_rules(10)).agg(F.sum(F.size("sigma_rule_ids"))).collect()
    runs["flagship"] = lambda: flagship(spark, folder).collect()
    try:
        from emberlog.llm.queries import QUERIES as llm
    except ImportError:
        llm = {}
    for name, f in llm.items():
        runs[name] = lambda f=f: f(spark, folder).write.format("noop").mode("overwrite").save()
    runs["match_10_rules"]()  # the session warms up
    took = {}
    for name, run in runs.items():
        start = time.time()
        run()
        took[name] = round(time.time() - start, 3)
    n = docs.count()
    rates = {k: round(n / v) for k, v in took.items() if k.startswith("match_")}
    print(json.dumps({"metric": "total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "documents_per_second": rates, "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
