"""Byte-level BPE ids for Arrow tasks.

``encoder(path)`` reads a byte-level BPE file of the ``tokenizers`` library.
Its ids come from ``tiktoken`` fed with the same vocabulary (several times
faster, same ids: tests compare them); texts that contain one of the file's
special tokens go through ``tokenizers`` itself, which alone gives them their
special ids.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Callable

import numpy as np


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int], int]:
    """(ids by bytes, ids of special tokens, number of ids)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    vocab = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
    ids = [spec["model"]["vocab"][m.replace(" ", "", 1)] for m in merges]
    if ids != sorted(ids):
        raise ValueError(f"{path}: ids don't follow the order of merges")
    return vocab, special, max([*vocab.values(), *special.values()]) + 1


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """text -> uint32 ids, as ``Tokenizer.encode(text, add_special_tokens=False)``."""
    import tiktoken
    from public_tokenizers import PATTERN

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    vocab, special, _ = vocabulary(path)
    fast = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={})
    named = re.compile("|".join(map(re.escape, special))) if special else None

    def encode(text: str) -> np.ndarray:
        if named is not None and named.search(text):
            return np.array(_library(path).encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.array(fast.encode_ordinary(text), dtype=np.uint32)

    return encode


@functools.lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def sentence_ends(path: str) -> np.ndarray:
    """Per id: whether a sentence may end after it (.!? with closers, or a line end)."""
    vocab, _, size = vocabulary(path)
    ends = np.zeros(size, dtype=bool)
    closing = re.compile(rb"[.!?][\"')\]]*\s*$|\n")
    for piece, i in vocab.items():
        ends[i] = closing.search(piece) is not None
    return ends
