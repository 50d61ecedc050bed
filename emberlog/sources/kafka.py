"""Options for Spark's Kafka source and sink."""

from __future__ import annotations

from pathlib import Path

from ..config import Settings


def _pem(path: str | None) -> str | None:
    try:
        return Path(path).read_text() if path else None
    except OSError:
        return None


def _sasl(s: Settings) -> dict[str, str | None]:
    login = f'org.apache.kafka.common.security.plain.PlainLoginModule required username="{s.kafka_api_key}" password="{s.kafka_api_secret}";'
    return {"security.protocol": "SASL_SSL", "sasl.mechanism": "PLAIN", "sasl.jaas.config": login}


def _ssl(s: Settings) -> dict[str, str | None]:
    """A truststore from the CA's PEM or a JKS file, and an identity where both of its PEM files can be read."""
    identity = _pem(s.kafka_ssl_certificate_location), _pem(s.kafka_ssl_key_location)
    chain, key = identity if all(identity) else (None, None)
    return {
        "security.protocol": "SSL",
        "ssl.truststore.type": "JKS" if s.kafka_ssl_truststore_location else "PEM",
        "ssl.truststore.location": s.kafka_ssl_truststore_location or s.kafka_ssl_ca_location,
        "ssl.truststore.password": s.kafka_ssl_truststore_password or None,
        "ssl.keystore.type": "PEM" if chain else None,
        "ssl.keystore.certificate.chain": chain,
        "ssl.keystore.key": key,
        "ssl.keystore.password": s.kafka_ssl_key_password or None,
        "ssl.endpoint.identification.algorithm": None if s.kafka_ssl_check_hostname else "",
    }


_SECURITY = {"SASL": _sasl, "SSL": _ssl, "PLAINTEXT": lambda s: {"security.protocol": "PLAINTEXT"}}


def auth_options(s: Settings) -> dict[str, str]:
    """The security properties of the settings' method; those without a value are left out."""
    return {f"kafka.{name}": value for name, value in _SECURITY[s.kafka_auth_method](s).items() if value is not None}


def source_options(s: Settings, topics: list[str], offsets: str | None = None, batch: bool = False) -> dict[str, str]:
    """Offsets: earliest, latest, or committed, which is to go on from the checkpoint (and to start at the earliest without one)."""
    offsets = offsets or s.starting_offsets
    options = {"kafka.bootstrap.servers": s.kafka_bootstrap_servers, "subscribe": ",".join(topics), "startingOffsets": "earliest" if offsets == "committed" else offsets}
    if batch:
        options["endingOffsets"] = "latest"
    else:
        options |= {"failOnDataLoss": "false", "maxOffsetsPerTrigger": str(s.window_count_threshold * s.parallelism * s.key_groups_per_task)}
        if s.source_parallelism:
            options["minPartitions"] = str(s.source_parallelism)
        if s.consumer_group:
            options["kafka.group.id"] = s.consumer_group + "-events-" + "-".join(topics)
    return options | auth_options(s)


def sink_options(s: Settings, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": s.kafka_bootstrap_servers, "topic": topic, "kafka.acks": "all", "kafka.compression.type": "gzip"} | auth_options(s)
