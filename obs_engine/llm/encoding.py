"""Byte-level BPE ids of whole texts, with a bounded memory of words seen before.

A space that stands before a character that is no white space always begins a new
token in byte-level BPE, so a text may be cut there, and each piece encoded by itself.
Most pieces are words met before; their ids come from a dictionary.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import tiktoken
from tokenizers import Tokenizer

CUT = re.compile(r" (?=\S)")
# Fixed values of the public vocabulary: how it splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONGEST_KEPT = 64


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 as itself, other bytes from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class _Pieces(dict):
    """Ids of pieces, as little-endian 32-bit integers; None if a cut before it isn't safe."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, piece: str):
        if not piece or piece[0].isspace():
            return None
        ids = self.encode(" " + piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = ids
        return ids


class SubwordEncoder:
    """Encodes as ``tokenizers`` does with the same file and no special tokens added.

    Pieces that are not in memory are merged by tiktoken where the file's merges are in
    the order of its ids (then both give the same ids), otherwise by ``tokenizers``.
    Texts that hold the string of a special token always go through ``tokenizers``.
    """

    def __init__(self, path: str, remember: int = 400_000):
        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.merge = self._merger(spec)
        self.pieces = _Pieces(self._ids, remember)
        self.size = self.exact.get_vocab_size()

    def _merger(self, spec: dict):
        vocab = {k: v for k, v in spec["model"]["vocab"].items() if k not in self.special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        order = [vocab["".join(p)] for p in pairs]
        byte_level = (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        if not byte_level or any(a >= b for a, b in zip(order, order[1:])):
            return lambda text: self.exact.encode(text, add_special_tokens=False).ids
        byte_of = _byte_of()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items()}
        return tiktoken.Encoding(
            "file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def _ids(self, text: str) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in self.merge(text))

    def encode(self, text: str) -> bytes:
        """All ids of a text, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if any(s in text for s in self.special):
            ids = self.exact.encode(text, add_special_tokens=False).ids
            return b"".join(i.to_bytes(4, "little") for i in ids)
        first, *rest = text.split(" ")
        get = self.pieces.__getitem__
        if first:
            try:
                return self._ids(first) + b"".join(map(get, rest))
            except TypeError:  # a piece begins with white space
                pass
        parts = CUT.split(text)
        return self._ids(parts[0]) + b"".join(map(get, parts[1:]))


@lru_cache(maxsize=2)
def encoder(path: str) -> SubwordEncoder:
    """One encoder for each Python worker, kept between tasks."""
    return SubwordEncoder(path)


def default_tokenizer() -> str:
    """The place of the public byte-level vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
