"""Token ids of a public tokenizer file, with the repeated work of whole corpora cached.

The vocabulary (a BPE with lower-casing, white space dropped) merges inside
words only.  Texts of Latin letters, digits and ASCII signs are cut as the
file's pre-tokenizer cuts them; every distinct word goes through the library's
BPE model once per worker and is kept in a cache of bounded size.  A text with
any other character is cut at its spaces (ids never join characters across
white space) and its other chunks go through the library's whole ``encode``.
This holds for files with the normaliser and pre-tokenizer of ``RULES``; with
any other file every text goes through the library whole.
"""

from __future__ import annotations

import json
import sys
from array import array
from functools import lru_cache

#: Characters that no normalisation form changes and whose lower case is one character.
PLAIN = r"[\x21-\x7eÀ-ÖØ-öø-įı-ňŊ-ž \t\n\r]*"
#: The pre-tokenizer's cut (fixed value of the vocabulary file), for lower-cased plain texts.
CUT = r"[a-zß-öø-ž]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[!-/:-@\[-`{-~]+"
#: A full stop or comma next to another sign is part of one longer piece.
RUN = r"[.,][!-/:-@\[-`{-~]|[!-/:-@\[-`{-~][.,]"
#: The rules of a file that CUT and PLAIN stand for (fixed values of the vocabulary file).
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
CACHE = 600_000


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class Encoder:
    """``encode(text)`` gives the ids as little-endian bytes, 2 per id."""

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        if self.lib.get_vocab_size() > 1 << 16 or sys.byteorder != "little":
            raise ValueError("ids of 16 bits on little-endian machines only")
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.fast = all(file[k] == v for k, v in RULES.items())
        self.plain, self.cut = re.compile(PLAIN), re.compile(CUT)
        self.run = re.compile(RUN)
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.known: dict[str, bytes] = {}

    def _core(self, core: str) -> bytes:
        ids = self.known.get(core)
        if ids is None:
            byted = core.encode().decode("latin-1").translate(self.letters)
            ids = self.known[core] = array("H", [t.id for t in self.lib.model.tokenize(byted)]).tobytes()
        return ids

    def _plain(self, text: str) -> bytes:
        low, known = text.lower(), self.known
        if self.run.search(low):
            pieces = self.cut.findall(low)
        else:
            pieces = low.replace(".", " . ").replace(",", " , ").split()
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            if len(known) >= CACHE:
                known.clear()
            for p in pieces:
                if p not in known:
                    known[p] = self._core(p) if p.isalpha() else b"".join(map(self._core, self.cut.findall(p)))
            return b"".join(map(known.__getitem__, pieces))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.fast:
            return array("H", self.lib.encode(text, add_special_tokens=False).ids).tobytes()
        if "<|" not in text and self.plain.fullmatch(text):
            return self._plain(text)
        return b"".join(self._plain(c) if "<|" not in c and self.plain.fullmatch(c) else
                        array("H", self.lib.encode(c, add_special_tokens=False).ids).tobytes() for c in text.split(" "))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
