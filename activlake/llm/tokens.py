"""Encoding with public tokenizer files inside tasks.

A file is named by its path, which is a parameter; every worker process reads it once.
``*.tiktoken`` files hold ranks; a ``*.json`` file is read for its vocabulary and encodes through
the same ranks, which gives the ids of its own library (tested) several times faster. As there, the
string of an added token of the file, such as ``<|endoftext|>``, is that one token wherever it stands.
"""

from __future__ import annotations

import base64
import json
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import tiktoken

#: File name of the 50,257 ids byte-level vocabulary.
BYTE_BPE = "byte_bpe_50k.json"


def vocabulary_path(name: str = BYTE_BPE) -> str:
    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """Bytes of the printable letters in which byte-level vocabularies write their tokens."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks of the ordinary tokens and ids of the added ones."""
    if path.endswith(".tiktoken"):
        lines = (line.split() for line in Path(path).read_bytes().splitlines() if line)
        return {base64.b64decode(token): int(rank) for token, rank in lines}, {}
    model = json.loads(Path(path).read_text(encoding="utf-8"))
    added = {t["content"]: t["id"] for t in model.get("added_tokens", ())}
    letters = _byte_letters()
    return {
        bytes(letters[c] for c in token): rank
        for token, rank in model["model"]["vocab"].items()
        if token not in added
    }, added


@lru_cache(maxsize=4)
def encoder(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a vocabulary file and the byte length of every token."""
    ranks, added = _ranks(path)
    lengths = np.zeros(max([*ranks.values(), *added.values()]) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    for token, rank in added.items():
        lengths[rank] = len(token.encode())
    found = tiktoken.Encoding(
        Path(path).name,
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens=added,
    )
    return found, lengths


def encode(text: str, path: str) -> np.ndarray:
    """Ids of a whole text."""
    found = encoder(path)[0]
    added = {token for token in found.special_tokens_set if token in text}
    ids = found.encode_to_numpy(text, allowed_special=added, disallowed_special=())
    return np.asarray(ids, dtype=np.int64)


def char_spans(text: str, ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and end (exclusive) of every token.

    A token may hold a part of a character only; it then spans the whole character.
    """
    if not len(ids):
        return ids, ids
    sizes = encoder(path)[1][ids]
    begins = np.cumsum(sizes) - sizes
    heads = (np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0) != 0x80
    opened = np.cumsum(np.add.reduceat(heads, begins, dtype=np.int64))
    before = np.concatenate([[0], opened[:-1]])
    return np.where(heads[begins], before, before - 1), opened
