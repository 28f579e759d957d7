"""Byte-level BPE ids of whole texts, with a bounded memory of chunks already encoded."""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import public_tokenizers
import tiktoken

#: Chunks a task remembers; then it starts anew. Longer chunks are not remembered.
CHUNK_CACHE, LONGEST_CACHED = 500_000, 48
#: A space beside other white space: such texts are encoded in one go.
_ODD_SPACE = re.compile(r" \s|\s ")


def vocabulary(path: str | None = None) -> str:
    return path or public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary of a tokenizer file. Its merges must stand in the order of their ids."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    vocab, letters = content["model"]["vocab"], _byte_letters()
    merges = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
    if any(vocab["".join(m)] != 256 + i for i, m in enumerate(merges)):
        raise ValueError(f"{path}: merges are not in the order of ids")
    special = {t["content"] for t in content.get("added_tokens", [])}
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


class _Chunks(dict):
    """Chunk without its leading space -> the ids with it, as little-endian 32-bit integers."""

    def __init__(self, encoding: tiktoken.Encoding):
        super().__init__()
        self.encoding = encoding

    def __missing__(self, chunk: str) -> bytes:
        value = array("I", self.encoding.encode_ordinary(" " + chunk)).tobytes()
        if len(chunk) <= LONGEST_CACHED:
            if len(self) >= CHUNK_CACHE:
                self.clear()
            self[chunk] = value
        return value


class Encoder:
    """Ids as the ``tokenizers`` library gives them for the same file, special strings as text.

    No token of such a vocabulary crosses a space that follows a visible character, so a text
    with single spaces only is the sum of its chunks, and most chunks are met again.
    """

    def __init__(self, path: str):
        self.encoding = _encoding(path)
        self.chunks = _Chunks(self.encoding)

    def ids(self, text: str | None) -> bytes:
        """Four bytes for each id, little-endian."""
        if not text:
            return b""
        if _ODD_SPACE.search(text):
            return array("I", self.encoding.encode_ordinary(text)).tobytes()
        first, *rest = text.split(" ")
        head = array("I", self.encoding.encode_ordinary(first)).tobytes()
        return head + b"".join(map(self.chunks.__getitem__, rest))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process and file."""
    return Encoder(path)
