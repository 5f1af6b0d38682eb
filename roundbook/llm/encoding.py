"""Encoding of whole texts with a public tokenizer file, word by word.

The library's own encoder spends most of its time in normalisation and
pre-tokenization. For the kind of tokenizer described by :data:`WORD_BPE` this
module does both steps for texts of ASCII and Latin-1 letters, where they are
plain lower-casing and one regular expression, and hands each distinct word to
the library's BPE model. Any other text, and any tokenizer of another kind,
goes to the library whole. The results are the library's (tested).
"""

from __future__ import annotations

import json
import re

import numpy as np

# The tokenizer's own normalizer and pre-tokenizer.
WORD_BPE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s0-9{_LETTERS}]+")
#: Distinct words kept by one Python worker; at that number the table starts anew.
KEPT_WORDS = 800_000


def default_tokenizer() -> str:
    """Path of the public word-level BPE file (imported where it is used)."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def id_type(path: str, *more_ids: int) -> np.dtype:
    """The narrowest unsigned type that holds all ids of the tokenizer."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    top = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]), *more_ids])
    return np.dtype(np.uint16 if top < 1 << 16 else np.uint32)


def _byte_alphabet() -> dict[int, str]:
    """The usual byte-to-character alphabet of byte-level BPE, by its rule."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


class Encoder(dict):
    """Text to ids; the mapping itself holds the ids of words met so far."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = all(spec[k] == v for k, v in WORD_BPE.items()) and not spec["truncation"] and not spec["padding"] and not spec["post_processor"] and all(t["content"].startswith("<|") for t in spec["added_tokens"])
        alphabet = _byte_alphabet()
        self._shown = {c: "".join(alphabet[b] for b in chr(c).encode()) for c in range(0x20, 0x100)}

    @classmethod
    def shared(cls, path: str) -> Encoder:
        """One encoder for each file and Python worker, reused by later tasks."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __missing__(self, word: str) -> bytes:
        ids = np.array([t.id for t in self.model.tokenize(word.translate(self._shown))], np.uint32).tobytes()
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = ids
        return ids

    def __call__(self, text: str) -> np.ndarray:
        """All ids of the text (no special ones added), as unsigned 32-bit."""
        if self.by_word and "<|" not in text and _PLAIN.fullmatch(text):
            return np.frombuffer(b"".join(map(self.__getitem__, _WORD.findall(text.lower()))), np.uint32)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
