"""Byte-level BPE of whole texts to flat little-endian ids, fast enough to re-tokenise a corpus in every job.

Texts are cut at blanks. A unit is a blank (left out in the key) and the characters up to the next one; as no pre-token of
this vocabulary has a blank inside unless white space follows white space, a text without such runs is the concatenation
of its units. Units are remembered up to a limit; texts with
runs of white space go through the library whole."""

from __future__ import annotations

import base64
import re
from array import array

SPECIAL = "<|endoftext|>"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Default place of a vocabulary; every operator takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id, from a .tiktoken file or from the vocabulary of a byte-level tokenizer.json."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    import json

    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    return {bytes(letters[c] for c in token): i for token, i in vocab.items() if token != SPECIAL}


class FlatEncoder:
    """encode(text) -> bytes of unsigned 32-bit little-endian ids. A special token's string in a text gives its id, as the
    tokenizer file says; with special=False it is ordinary text. limit: units remembered at most; later ones are encoded anew
    each time. Empty text gives no ids; a text of any length is encoded whole; lone surrogates become replacement characters."""

    def __init__(self, path: str, limit: int = 400_000, special: bool = True):
        import public_tokenizers
        import tiktoken

        ranks = load_ranks(path)
        self.marks = {SPECIAL} if special else set()
        self.special = tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: 50256})
        self.ordinary, self.single = self.special._core_bpe.encode_ordinary, self.special._core_bpe.encode_single_piece
        self.limit, self.units = limit, {}

    def _whole(self, text: str) -> bytes:
        try:
            return array("I", self.special.encode(text, allowed_special=self.marks, disallowed_special=())).tobytes()
        except UnicodeEncodeError:  # lone surrogates
            return self._whole(text.encode("utf-16", "surrogatepass").decode("utf-16", "replace"))

    def _unit(self, unit: str) -> bytes:
        if unit.isalpha():
            return array("I", self.single((" " + unit).encode())).tobytes()
        if unit[0] == "\x00":
            return array("I", self.ordinary(unit[1:])).tobytes()
        if unit[-1] in ".,;:!?" and unit[:-1].isalpha():
            return array("I", self.single((" " + unit[:-1]).encode()) + self.single(unit[-1:].encode())).tobytes()
        return array("I", self.ordinary(unit if unit[0] == "\n" else " " + unit)).tobytes()

    def encode(self, text: str) -> bytes:
        if "\x00" in text or self.marks and SPECIAL in text:
            return self._whole(text)
        parts, units = text.replace("\n", " \n").split(" "), self.units
        parts[0] = "\x00" + parts[0]  # no blank stands before the first one
        try:
            return b"".join(map(units.__getitem__, parts))
        except KeyError:
            if "" in parts or "\n" in parts:
                return self._whole(text)
            make, out = self._unit, []
            for u in parts:
                ids = units.get(u)
                if ids is None:
                    ids = make(u)
                    if len(units) < self.limit:
                        units[u] = ids
                out.append(ids)
            return b"".join(out)
