"""The installed tokenizers library, asked once per distinct pre-token."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

import numpy as np

from stayscope.llm.known import KnownPieces

_made: dict[str, tuple] = {}


def special_strings(content: str) -> tuple[bytes, ...]:
    """The strings that the library cuts out of a text before anything else."""
    described = json.loads(content)
    cutter = described.get("pre_tokenizer") or {}
    plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space")
    tokens = described.get("added_tokens") or []
    loose = any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in tokens)
    if not plain or described.get("normalizer") or loose:
        raise ValueError("a byte-level vocabulary without normaliser and prefix space is needed")
    return tuple(t["content"].encode() for t in tokens)


def library_of(content: str) -> tuple[Callable[[list[bytes]], list[np.ndarray]], tuple[bytes, ...], KnownPieces]:
    """For this worker: the encoder of pre-tokens, the special strings, and the pre-tokens met so far.

    A pre-token encoded alone has the ids it has within any text, since the
    library merges inside pre-tokens only.
    """
    key = str(hash(content))
    if key not in _made:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(content)
        library.no_truncation()
        library.no_padding()

        def encode(pieces: list[bytes]) -> list[np.ndarray]:
            done = library.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
            return [np.array(e.ids, dtype=np.int32) for e in done]

        _made[key] = encode, special_strings(content), KnownPieces()
    return _made[key]
