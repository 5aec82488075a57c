"""Descriptions of a domain: plain frozen values that the operators read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from siltstone.functions.columns import canonical_type


@dataclass(frozen=True)
class Feed:
    """One source of a domain: its name and delivered column -> canonical column."""

    name: str
    columns: dict[str, str]


@dataclass(frozen=True)
class Range:
    """Values of ``column`` outside [low, high] become NULL."""

    column: str
    low: float
    high: float


@dataclass(frozen=True)
class Default:
    """Values of ``column`` not among ``allowed``, and NULL, become ``value``."""

    column: str
    allowed: tuple[str, ...]
    value: str


@dataclass(frozen=True)
class SumOf:
    """``column``, where NULL, is the sum of ``parts`` (NULL if any part is)."""

    column: str
    parts: tuple[str, ...]


@dataclass(frozen=True)
class DomainSpec:
    name: str
    key: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]
    required: tuple[str, ...] = ()
    feeds: tuple[Feed, ...] = ()  # preferred feed first
    source_column: str | None = None
    upper_trim: tuple[str, ...] = ()
    ranges: tuple[Range, ...] = ()
    defaults: tuple[Default, ...] = ()
    sums: tuple[SumOf, ...] = ()
    stamps: tuple[str, ...] = ()  # audit timestamps, filled with the run time when absent
    partition: str | None = None  # DATE column, in the key or determined by it, that partitions the history
    rejects: str = "fail"  # a NULL or repeated key: the batch fails (fail) or goes on without the row (quarantine)
    absent: str = "keep"  # keys a delivery does not mention: they stay current (keep) or end (close)

    @property
    def column_names(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.columns)

    @property
    def types(self) -> dict[str, str]:
        return dict(self.columns)

    def feed(self, name: str) -> Feed:
        for feed in self.feeds:
            if feed.name == name:
                return feed
        raise KeyError(f"{self.name} has no feed {name!r}")

    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(name, canonical_type(type_name), name not in self.required)
                for name, type_name in self.columns
            ]
        )
