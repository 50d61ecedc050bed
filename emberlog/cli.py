"""Command line of the detection job."""

from __future__ import annotations

import argparse

from .config import Settings


def parse(argv: list[str] | None = None, env: dict[str, str] | None = None) -> Settings:
    p = argparse.ArgumentParser(prog="emberlog", description="Tags events with the detection rules they match.")
    p.add_argument("--job-id", help="names the rules of this job")
    p.add_argument("--input-topics", help="comma-separated")
    p.add_argument("--output-topic")
    p.add_argument("--rules-topic")
    p.add_argument("--metrics-topic")
    p.add_argument("--output-mode", choices=["all_events", "matched_only"])
    p.add_argument("--keep-filtered-events", action="store_true", default=None)
    p.add_argument("--apply-parser-to-output-events", action="store_true", default=None)
    given = vars(p.parse_args(argv))
    if given["input_topics"] is not None:
        given["input_topics"] = [t.strip() for t in given["input_topics"].split(",") if t.strip()]
    settings = Settings.from_env(env, **given)
    for name in ("job_id", "input_topics", "output_topic"):
        if not getattr(settings, name):
            p.error(f"--{name.replace('_', '-')} is required")
    return settings


def main(argv: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession

    from .streaming.job import run_job

    settings = parse(argv)
    spark = SparkSession.builder.appName(f"emberlog-{settings.job_id}").config(map=settings.spark_conf()).getOrCreate()
    run_job(spark, settings).awaitTermination()


if __name__ == "__main__":
    main()
