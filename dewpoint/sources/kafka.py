"""Kafka connection settings as connector options."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class KafkaSettings:
    """Brokers and credentials; supplied by the caller, never stored here."""

    bootstrap_servers: tuple[str, ...]
    username: str | None = None
    password: str | None = field(default=None, repr=False)
    security_protocol: str = "SASL_PLAINTEXT"
    sasl_mechanism: str = "PLAIN"

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> KafkaSettings:
        """Settings from ``KAFKA_*`` variables; servers are separated by commas."""
        servers = env["KAFKA_BOOTSTRAP_SERVERS"].split(",")
        return cls(
            bootstrap_servers=tuple(s.strip() for s in servers if s.strip()),
            username=env.get("KAFKA_USERNAME"),
            password=env.get("KAFKA_PASSWORD"),
            security_protocol=env.get("KAFKA_SECURITY_PROTOCOL", cls.security_protocol),
            sasl_mechanism=env.get("KAFKA_SASL_MECHANISM", cls.sasl_mechanism),
        )


def kafka_options(settings: KafkaSettings) -> dict[str, str]:
    """Connection options, the same for reading and writing."""
    options = {
        "kafka.bootstrap.servers": ",".join(settings.bootstrap_servers),
        "kafka.security.protocol": settings.security_protocol,
    }
    if settings.security_protocol.startswith("SASL"):
        options["kafka.sasl.mechanism"] = settings.sasl_mechanism
        options["kafka.sasl.jaas.config"] = (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f"username={_quoted(settings.username)} password={_quoted(settings.password)};"
        )
    return options


def _quoted(text: str | None) -> str:
    escaped = (text or "").replace("\\", "\\\\").replace('"', '\\"')
    return f'"{escaped}"'
