"""Public vocabulary files; operators take the path as a parameter."""

from __future__ import annotations

import base64
from functools import lru_cache
from typing import Dict


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ranks(path: str) -> Dict[bytes, int]:
    """Token bytes to ids of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def encoding(path: str):
    """The byte-level BPE of a ``.tiktoken`` file, without special tokens."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})
