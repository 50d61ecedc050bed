"""Settings of a job, with their bounds, from arguments and the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields


@dataclass
class Settings:
    job_id: str = ""
    input_topics: list[str] = field(default_factory=list)
    output_topic: str = ""
    rules_topic: str = "sigma-rules"
    metrics_topic: str | None = None
    output_mode: str = "matched_only"
    keep_filtered_events: bool = False
    apply_parser_to_output_events: bool = False
    kafka_bootstrap_servers: str = "localhost:9092"
    kafka_auth_method: str = "PLAINTEXT"
    kafka_api_key: str = ""
    kafka_api_secret: str = ""
    kafka_ssl_ca_location: str = ""
    kafka_ssl_certificate_location: str | None = None
    kafka_ssl_key_location: str | None = None
    kafka_ssl_key_password: str | None = None
    kafka_ssl_truststore_location: str | None = None
    kafka_ssl_truststore_password: str | None = None
    kafka_ssl_check_hostname: bool = True
    consumer_group: str | None = None
    starting_offsets: str = "latest"
    parallelism: int = 2
    source_parallelism: int | None = None
    keying_strategy: str = "hash"
    key_groups_per_task: int = 1
    autoscaler_enabled: bool = False
    autoscaler_max_parallelism: int = 24
    window_size_seconds: int = 30
    window_count_threshold: int = 20_000
    checkpoint_path: str = "checkpoints"
    checkpoint_interval_ms: int = 60_000
    state_backend: str = "rocksdb"

    def __post_init__(self):
        bounds = {
            "parallelism": (1, 100), "source_parallelism": (1, 100), "key_groups_per_task": (1, 100), "autoscaler_max_parallelism": (1, None),
            "window_size_seconds": (1, 3600), "window_count_threshold": (1, None), "checkpoint_interval_ms": (1000, None),
        }
        for name, (low, high) in bounds.items():
            v = getattr(self, name)
            if v is not None and (v < low or (high is not None and v > high)):
                raise ValueError(f"{name} has to be from {low}{f' to {high}' if high else ''}")
        choices = {
            "output_mode": ("matched_only", "all_events"), "kafka_auth_method": ("SASL", "SSL", "PLAINTEXT"), "starting_offsets": ("earliest", "latest", "committed"),
            "keying_strategy": ("hash", "computer", "round_robin"), "state_backend": ("memory", "rocksdb"),
        }
        for name, allowed in choices.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} has to be one of {', '.join(allowed)}")

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, **given) -> Settings:
        """Each setting from the environment under its upper-cased name (topics under that with KAFKA_ before it, too, which goes first), over that what is given and not None."""
        env = os.environ if env is None else env
        values = {}
        for f in fields(cls):
            text = env.get(f.name.upper())
            if "topic" in f.name:
                text = env.get(f"KAFKA_{f.name.upper()}", text)
            if text is None:
                continue
            if f.name == "input_topics":
                values[f.name] = [t.strip() for t in text.split(",") if t.strip()]
            elif "bool" in str(f.type):
                values[f.name] = text.lower() in ("true", "1")
            elif "int" in str(f.type):
                values[f.name] = int(text)
            else:
                values[f.name] = text
        return cls(**values | {k: v for k, v in given.items() if v is not None})

    def spark_conf(self) -> dict[str, str]:
        """Session settings that the streaming job needs."""
        conf = {"spark.sql.adaptive.enabled": "true", "spark.sql.parser.escapedStringLiterals": "false"}
        if self.state_backend == "rocksdb":
            conf |= {
                "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
                "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
            }
        return conf
