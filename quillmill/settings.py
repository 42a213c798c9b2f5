"""Parameters of the pipeline, from arguments, an environment or a file of NAME=value lines."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from enum import Enum
from pathlib import Path


class Chunking(str, Enum):
    STANDARD = "standard"
    ADVANCED = "advanced"


class NamespaceStrategy(str, Enum):
    NONE = "none"
    BY_FILE = "by_file"
    BY_FOLDER = "by_folder"
    BY_PROVIDER = "by_provider"


#: name -> (least, greatest)
_BOUNDS = {
    "chunk_size": (100, 10_000), "chunk_overlap": (0, 1000), "chunk_min_size": (50, 5000), "chunk_max_size": (200, 20_000), "chunk_max_tokens": (50, 8000), "min_chunk_quality": (0.0, 1.0),
    "embedding_batch_size": (1, 100), "embedding_dimension": (1, 10_000), "provider_batch_size": (1, 30), "boundary_threshold": (0.0, 1.0), "top_k": (1, 10_000),
}


@dataclass(frozen=True)
class Settings:
    chunking: Chunking = Chunking.ADVANCED
    chunk_size: int = 1000
    chunk_overlap: int = 200
    chunk_min_size: int = 400
    chunk_max_size: int = 2000
    chunk_max_tokens: int = 600
    merge_strategy: str = "hybrid"
    min_chunk_quality: float = 0.5
    use_tokens: bool = True
    filter_quality: bool = True
    merge_small: bool = True
    prioritize: bool = True
    drop_corrupted_lines: bool = True
    use_sentence_windows: bool = False
    boundary_fallback: bool = False
    boundary_threshold: float = 0.5
    embedding_model: str = "default"
    embedding_dimension: int = 64
    embedding_batch_size: int = 100
    embed_with_context: bool = True
    provider_batch_size: int = 15
    namespace_strategy: NamespaceStrategy = NamespaceStrategy.NONE
    namespace_prefix: str = ""
    namespace_definitions: str = ""
    metric: str = "cosine"
    top_k: int = 5

    def __post_init__(self):
        for name, (low, high) in _BOUNDS.items():
            if not low <= getattr(self, name) <= high:
                raise ValueError(f"{name} must lie between {low} and {high}")
        if self.chunk_overlap >= self.chunk_size:
            raise ValueError("chunk_overlap must be less than chunk_size")
        if self.chunk_min_size > self.chunk_max_size:
            raise ValueError("chunk_min_size must not exceed chunk_max_size")

    @classmethod
    def of(cls, values: dict[str, str], **given) -> Settings:
        """From names in any case and values as text, such as an environment; unknown names don't matter."""
        known = {k.lower(): v for k, v in values.items()}
        base = cls()

        def read(old, text: str):
            if isinstance(old, bool):
                if text.strip().lower() not in ("1", "true", "yes", "on", "0", "false", "no", "off", ""):
                    raise ValueError(f"neither true nor false: {text}")
                return text.strip().lower() in ("1", "true", "yes", "on")
            return type(old)(text)

        return replace(base, **{f.name: read(getattr(base, f.name), known[f.name]) for f in fields(cls) if f.name in known} | given)

    @classmethod
    def from_file(cls, path: str, **given) -> Settings:
        rows = (x.strip() for x in Path(path).read_text().splitlines())
        pairs = (x.removeprefix("export ").split("=", 1) for x in rows if "=" in x and not x.startswith("#"))
        return cls.of({k.strip(): v.strip().strip("\"'") for k, v in pairs}, **given)
