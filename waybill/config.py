"""Tunables, with their default values, as frozen dataclasses. Every operator takes what it needs as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class QueueConfig:
    capacity: int = 10_000
    batch_size: int = 250
    batch_wait_ms: int = 50
    usage_threshold: float = 0.8


@dataclass(frozen=True)
class PublisherConfig:
    lease_seconds: int = 30
    max_retries: int = 5
    topic: str = "orders.events"
    topic_partitions: int = 10


@dataclass(frozen=True)
class RecoveryConfig:
    enabled: bool = True
    interval_seconds: int = 10
    batch_size: int = 500


@dataclass(frozen=True)
class BucketLimit:
    """A token bucket: it starts full, gains ``refill_per_second`` tokens a second and holds ``capacity`` at most."""

    capacity: int
    refill_per_second: int


@dataclass(frozen=True)
class AdmissionConfig:
    throttle_multiplier: float = 0.5
    overall: BucketLimit = BucketLimit(1000, 100)
    per_ip: BucketLimit = BucketLimit(50, 5)
    per_customer: BucketLimit = BucketLimit(100, 10)


@dataclass(frozen=True)
class HealthConfig:
    queue_pressure_critical: float = 0.95
    outbox_pending_critical: int = 10_000


@dataclass(frozen=True)
class ConsumerConfig:
    starting_offsets: str = "earliest"
    max_poll_records: int = 100
    #: Of the whole topic, for a micro-batch; the bound of a poll is one of a single consumer.
    max_offsets_per_trigger: int = 5_000_000


@dataclass(frozen=True)
class TelemetryConfig:
    scrape_seconds: int = 15
    scrape_jobs: tuple[str, ...] = ("order-service", "notification-stub", "postgres", "tempo")
    trace_sampling_default: float = 1.0
    trace_sampling_prod: float = 0.1
    log_retention_days: int = 7
    trace_retention_hours: int = 168


@dataclass(frozen=True)
class Config:
    queue: QueueConfig = field(default_factory=QueueConfig)
    publisher: PublisherConfig = field(default_factory=PublisherConfig)
    recovery: RecoveryConfig = field(default_factory=RecoveryConfig)
    admission: AdmissionConfig = field(default_factory=AdmissionConfig)
    health: HealthConfig = field(default_factory=HealthConfig)
    consumer: ConsumerConfig = field(default_factory=ConsumerConfig)
    telemetry: TelemetryConfig = field(default_factory=TelemetryConfig)


DEFAULTS = Config()
