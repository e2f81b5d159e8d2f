"""The campaign configuration and its constraints."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Sampling:
    """Sampling settings of a call."""

    temperature: float = 1.0
    top_p: float = 1.0
    max_tokens: int = 512


@dataclass(frozen=True)
class Band:
    """A length band."""

    min_tokens: int
    max_tokens: int
    share: float
    min_exchanges: int = 1
    max_exchanges: int = 1

    def __post_init__(self) -> None:
        if not 1 <= self.min_tokens <= self.max_tokens or not 1 <= self.min_exchanges <= self.max_exchanges or self.share <= 0:
            raise ValueError("a band needs 1 <= least <= most and a positive share")


@dataclass(frozen=True)
class Lane:
    """A language lane with its prompts and shares by complexity."""

    language: str
    accepted_target: int
    system_prompts: dict[str, str]
    complexity_shares: dict[str, float]
    oversample: float = 1.5

    def __post_init__(self) -> None:
        if self.system_prompts.keys() != self.complexity_shares.keys():
            raise ValueError("prompts and shares need the same complexities")
        if abs(sum(self.complexity_shares.values()) - 1) > 1e-8:
            raise ValueError("the shares of a lane must add up to 1")


@dataclass(frozen=True)
class Selection:
    """Targets of the final selection."""

    targets: dict[str, int]
    audit_buffer: float = 1.05
    fallback_retention: float = 0.97
    require_targets: bool = True
    retain_surplus: bool = False

    def __post_init__(self) -> None:
        if any(t < 1 for t in self.targets.values()) or self.audit_buffer < 1 or not 0 < self.fallback_retention <= 1:
            raise ValueError("targets of at least 1, a buffer of at least 1 and a retention in (0, 1] are needed")


@dataclass(frozen=True)
class Campaign:
    """A whole configuration."""

    lanes: tuple[Lane, ...]
    bands: dict[str, Band] = field(default_factory=lambda: {"default": Band(1, 3968, 1.0)})
    selection: Selection | None = None
    seed: int = 0
    shard_size: int = 2048
    max_sequence: int = 4096
    soft_sequence: int = 3968
    min_user: int = 64
    min_assistant: int = 192
    minimum_quality: int = 4
    max_retries: int = 4
    audit_requests: bool = True
    boundary: str = "<|im_end|>"
    control_tokens: tuple[str, ...] = ("<|im_start|>", "<|im_end|>")

    def __post_init__(self) -> None:
        names = [lane.language for lane in self.lanes]
        if len(set(names)) != len(names):
            raise ValueError("a language has more than one lane")
        if self.soft_sequence > self.max_sequence or any(b.max_tokens > self.soft_sequence for b in self.bands.values()):
            raise ValueError("bands must end at the soft limit, and that at the limit")
        if abs(sum(b.share for b in self.bands.values()) - 1) > 1e-8:
            raise ValueError("the shares of the bands must add up to 1")
        if self.selection and set(self.selection.targets) - set(names):
            raise ValueError("a target has no lane")

    def receipt(self) -> str:
        """SHA-256 of the configuration."""
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, ensure_ascii=False).encode()).hexdigest()

    def frames(self, spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(lanes, complexities, bands) as small frames for the planner."""
        lanes = spark.createDataFrame([(lane.language, lane.accepted_target, lane.oversample) for lane in self.lanes], "language string, target long, oversample double")
        shares = spark.createDataFrame([(lane.language, c, s) for lane in self.lanes for c, s in lane.complexity_shares.items()], "language string, complexity string, share double")
        bands = spark.createDataFrame([(n, b.min_tokens, b.max_tokens, b.share, b.min_exchanges, b.max_exchanges) for n, b in self.bands.items()], "length_band string, min_tokens int, max_tokens int, share double, min_exchanges int, max_exchanges int")
        return lanes, shares, bands


def load(path: str) -> Campaign:
    """A configuration from YAML."""
    import yaml

    with open(path, encoding="utf-8") as lines:
        raw = yaml.safe_load(lines)
    lanes = tuple(Lane(**lane) for lane in raw.pop("lanes"))
    bands = {name: Band(**band) for name, band in raw.pop("bands", {}).items()}
    chosen = raw.pop("selection", None)
    return Campaign(lanes=lanes, selection=Selection(**chosen) if chosen else None, **({"bands": bands} if bands else {}), **raw)


def catalog(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(topics, modes) of a YAML catalogue; topics carry their domain."""
    import yaml

    with open(path, encoding="utf-8") as lines:
        raw = yaml.safe_load(lines)
    topics = [(d["id"], t["id"], t["en"], t["da"]) for d in raw["domains"] for t in d["topics"]]
    modes = [(m["id"], m["en"], m["da"], bool(m.get("embedded_input", False))) for m in raw["modes"]]
    return spark.createDataFrame(topics, "domain string, id string, en string, da string"), spark.createDataFrame(modes, "id string, en string, da string, embedded_input boolean")
