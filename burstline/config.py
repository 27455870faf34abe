"""Settings for detection, feed preparation, sources and outputs.

Durations are ``timedelta`` so that window arithmetic (does the slide divide the
window?) needs no text parsing; ``interval_text`` renders them for Spark.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import timedelta


def interval_text(duration: timedelta) -> str:
    """A duration as the interval string that ``window`` and ``withWatermark`` take."""
    micros = duration // timedelta(microseconds=1)
    if micros % 1_000_000 == 0:
        return f"{micros // 1_000_000} seconds"
    return f"{micros} microseconds"


@dataclass(frozen=True)
class SlidingWindow:
    """A sliding event-time window and the lateness its stateful query tolerates."""

    size: timedelta
    slide: timedelta
    watermark: timedelta

    @property
    def size_text(self) -> str:
        return interval_text(self.size)

    @property
    def slide_text(self) -> str:
        return interval_text(self.slide)

    @property
    def watermark_text(self) -> str:
        return interval_text(self.watermark)

    @property
    def has_whole_panes(self) -> bool:
        return self.size % self.slide == timedelta(0)


@dataclass(frozen=True)
class DetectionConfig:
    # Thresholds, windows and user names of the detection rules.
    macro_above: float = 500.0
    micro_below: float = 20.0
    bot_window: SlidingWindow = SlidingWindow(
        timedelta(seconds=10), timedelta(seconds=5), timedelta(seconds=20)
    )
    bot_more_than: int = 4
    summary_window: SlidingWindow = SlidingWindow(
        timedelta(seconds=30), timedelta(seconds=10), timedelta(seconds=30)
    )
    users_kept_out_of_normal: tuple[str, ...] = ("User_Bot",)

    def but(self, **changes) -> DetectionConfig:
        return replace(self, **changes)


@dataclass(frozen=True)
class FeedConfig:
    # How source rows are given users and turned into bursts.
    fraud_user: str = "User_Hacker"
    bot_user: str = "User_Bot"
    pool_size: int = 1000
    burst_per_10000: int = 200
    burst_rows: int = 5
    burst_gap: timedelta = timedelta(milliseconds=10)


@dataclass(frozen=True)
class MessageSource:
    """Where messages are read from or written to.

    ``format='kafka'`` uses ``servers`` and ``topic``; a file format uses ``path``.
    """

    format: str = "kafka"
    servers: str = "localhost:9092"
    topic: str = "bank_transactions"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> MessageSource:
        env = os.environ if env is None else env
        return cls(
            servers=env.get("KAFKA_BOOTSTRAP_SERVERS", cls.servers),
            topic=env.get("KAFKA_TOPIC", cls.topic),
        )

    def read_options(self) -> dict[str, str]:
        if self.format != "kafka":
            return dict(self.options)
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": "latest",
            "failOnDataLoss": "false",
            **self.options,
        }

    def from_beginning(self) -> MessageSource:
        """For a bounded read: all that the topic holds, and a failure if some of it is lost."""
        if self.format != "kafka":
            return self
        bounded = {"startingOffsets": "earliest", "failOnDataLoss": "true", **self.options}
        return replace(self, options=bounded)

    def write_options(self) -> dict[str, str]:
        if self.format != "kafka":
            return dict(self.options)
        return {
            "kafka.bootstrap.servers": self.servers,
            "topic": self.topic,
            "kafka.acks": "all",
            "kafka.retries": "3",
            "kafka.max.block.ms": "10000",
            **self.options,
        }


def dataset_path(env: Mapping[str, str] | None = None) -> str:
    env = os.environ if env is None else env
    return env.get("DATASET_PATH", "/data/creditcard.csv")
