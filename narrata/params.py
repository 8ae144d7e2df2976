"""Job parameters with the value checks that every job shares."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

# --- fixed values: column names of the raw table and default job parameters ---
EXPECTED_COLUMNS = [
    "Date received", "Product", "Sub-product", "Issue", "Sub-issue",
    "Consumer complaint narrative", "Company public response", "Company", "State", "ZIP code",
    "Tags", "Consumer consent provided?", "Submitted via", "Date sent to company",
    "Company response to consumer", "Timely response?", "Consumer disputed?", "Complaint ID",
]
ESSENTIAL_COLUMNS = [
    "Date received", "Product", "Sub-product", "Issue", "Sub-issue",
    "Consumer complaint narrative", "Company", "State", "ZIP code", "Complaint ID",
]
CHUNK_METADATA = ["Product", "Issue", "Company", "State", "Date received", "Complaint ID"]
TARGET_PRODUCTS = ["Credit card", "Personal loan", "Savings account", "Money transfers"]
TARGET_SAMPLE_RANGE = (10_000, 15_000)
ENVIRONMENT = {
    "SAMPLE_SIZE": "sample_size",
    "STRATIFY_COLUMN": "stratify_col",
    "RANDOM_STATE": "seed",
    "MIN_SAMPLES_PER_STRATUM": "min_per_stratum",
    "CHUNK_SIZE": "chunk_size",
    "CHUNK_OVERLAP": "chunk_overlap",
    "NORMALIZE_EMBEDDINGS": "normalize",
}
SEPARATORS = ["\n\n", "\n", ". ", "! ", "? ", "; ", ", ", " ", ""]
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class JobParams:
    """Parameters of the index and answer jobs. Column names fit the raw table by default."""

    key_col: str = "Complaint ID"
    text_col: str = "Consumer complaint narrative"
    product_col: str = "Product"
    metadata: list[str] = field(default_factory=lambda: list(CHUNK_METADATA))
    products: list[str] = field(default_factory=lambda: list(TARGET_PRODUCTS))
    sample_size: int = 12_500
    stratify_col: str = "Product"
    seed: int = 42
    min_per_stratum: int = 1
    chunk_size: int = 500
    chunk_overlap: int = 50
    splitter: str = "recursive"
    embedding_dim: int = 384
    normalize: bool = True
    top_k: int = 5
    max_context: int = 2000

    @classmethod
    def from_environment(cls, **changes) -> JobParams:
        """Parameters from environment variables; ``changes`` win over them."""
        found = {}
        for variable, name in ENVIRONMENT.items():
            text = os.environ.get(variable)
            if text is not None:
                kind = type(getattr(cls, name))
                found[name] = text.lower() == "true" if kind is bool else kind(text)
        return cls(**{**found, **changes})

    def __post_init__(self) -> None:
        if self.sample_size <= 0:
            raise ValueError(f"sample_size must be positive, got {self.sample_size}")
        if self.seed < 0:
            raise ValueError("seed must be non-negative")
        if self.min_per_stratum < 1:
            raise ValueError("min_per_stratum must be at least 1")
        check_chunking(self.chunk_size, self.chunk_overlap)
        if self.splitter not in ("recursive", "window"):
            raise ValueError(f"unknown splitter: {self.splitter}")
        if self.embedding_dim <= 0 or self.top_k <= 0 or self.max_context <= 0:
            raise ValueError("embedding_dim, top_k and max_context must be positive")


def check_chunking(size: int, overlap: int) -> None:
    """Refuse a chunk size or overlap that cannot make progress."""
    if size <= 0:
        raise ValueError("chunk size must be positive")
    if overlap < 0:
        raise ValueError("chunk overlap must be non-negative")
    if overlap >= size:
        raise ValueError("chunk overlap must be less than the chunk size")


def require_columns(df, columns: list[str]) -> None:
    """Raise before planning when a column that an operator needs is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}; available: {df.columns}")
