"""The operator queries (importing a module registers its query)."""

from __future__ import annotations

from . import (  # noqa: F401
    byte_bpe,
    decontaminate,
    exact_dedup,
    language_id,
    lm_score,
    merkle,
    near_dup,
    pieces,
    pii,
    quality,
    sharding,
    substring_dedup,
    whitening,
)
from .registry import ORACLE, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
