"""Settings of a preparation run."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace

from kinmatch.operators.blocking import Limits


@dataclass(frozen=True)
class Preparation:
    hash_bits: int = 18
    validation_fraction: float = 0.2
    seed: int = 42
    block_limit: int = 100
    lexical_pool: int = 120
    lexical_top_k: int = 25
    max_candidates: int = 80
    query_terms: int = 16
    retrieval: str = "rowid"
    hash_fn: str = "blake2b"

    def __post_init__(self):
        if not 8 <= self.hash_bits <= 22:
            raise ValueError("hash_bits must be from 8 to 22")
        if not 0 < self.validation_fraction < 1:
            raise ValueError("validation_fraction must be between 0 and 1")
        for name in ("block_limit", "lexical_pool", "lexical_top_k", "max_candidates", "query_terms"):
            if type(getattr(self, name)) is not int or getattr(self, name) <= 0:
                raise ValueError(f"{name} must be a whole number above 0")
        if self.hash_fn not in ("blake2b", "md5") or self.retrieval not in ("rowid", "bm25"):
            raise ValueError("hash_fn is blake2b or md5; retrieval is rowid or bm25")

    @classmethod
    def load(cls, path: str | None = None, **overrides) -> Preparation:
        said = {}
        if path:
            with open(path, encoding="utf-8") as f:
                said = json.load(f)
        said |= {k: v for k, v in overrides.items() if v is not None}
        unknown = sorted(set(said) - set(cls.__dataclass_fields__))
        if unknown:
            raise ValueError(f"unknown settings {unknown}")
        return replace(cls(), **said)

    def limits(self) -> Limits:
        return Limits(self.block_limit, self.lexical_pool, self.lexical_top_k, self.max_candidates, self.query_terms, self.retrieval)

    def as_dict(self) -> dict:
        return asdict(self)
