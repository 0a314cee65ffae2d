"""Tunable rules. Defaults are the published ones; pass a changed copy to any operator that takes `settings`."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Thresholds and limits that results depend on.
    institution_domain: str = "campus.example.edu"
    min_body_chars: int = 50
    max_attachment_bytes: int = 50 * 1024 * 1024
    future_tolerance_seconds: int = 300
    dedup_ttl_seconds: int = 604_800
    routing_threshold: float = 0.75
    gate_threshold: float = 0.70
    gate_cap: float = 0.90
    query_max_chars: int = 200
    semantic_threshold: float = 0.5
    hybrid_semantic_threshold: float = 0.3
    storage_semantic_threshold: float = 0.7
    rrf_k: int = 60
    rate_limit_attempts: int = 5
    rate_limit_window_seconds: int = 60
    embedding_dim: int = 768


DEFAULTS = Settings()
