"""Whole texts to token ids with the ``tokenizers`` library.

The vocabulary file is read on the driver (its size is that of a vocabulary,
checked) and its text is broadcast, so executors need no file of their own.

A pre-token's ids do not depend on its neighbours, so the ids of each
different pre-token come from the library once and are kept in a bounded memo.
That path is taken only by texts made of characters whose classes (letter,
number, space) are the same in every Unicode version, and only for the two
pre-token rules known here; any other text or tokenizer goes through the
library whole.  So does a text that holds one of the file's added tokens
(``<|endoftext|>``), which the library reads as one id.
"""

from __future__ import annotations

import json
import re
from array import array

from pyspark import Broadcast
from pyspark.sql import SparkSession

MAX_VOCABULARY_BYTES = 64 << 20
MEMO_ENTRIES = 300_000
MEMO_LENGTH = 13

_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xffŒœ"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_ODD = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-\xffŒœ]")
_BYTE_LEVEL = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
_WORD = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")
_WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def broadcast_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    with open(path, encoding="utf-8") as f:
        text = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(text) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is no vocabulary file: over {MAX_VOCABULARY_BYTES} characters")
    return spark.sparkContext.broadcast(text)


def _pattern(spec: dict) -> tuple[re.Pattern | None, bool]:
    """(pattern of pre-tokens on plain characters, lower-case first)."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and norm is None:
        return _BYTE_LEVEL, False
    steps = pre.get("pretokenizers", [])
    kinds = [n.get("type") for n in (norm or {}).get("normalizers", [])]
    if (
        len(steps) == 2
        and steps[0].get("pattern") == {"Regex": _WORD_RULE}
        and (steps[0].get("behavior"), steps[0].get("invert")) == ("Removed", True)
        and (steps[1].get("type"), steps[1].get("use_regex"), steps[1].get("add_prefix_space")) == ("ByteLevel", False, False)
        and kinds == ["NFC", "Replace", "Lowercase"]
    ):
        return _WORD, True
    return None, False


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as one printable character: a
    printable byte as itself, the others, in order, from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(others)}


class _Memo(dict):
    """Pre-token -> ids.  A missing one goes to the library's merge model.

    Long pre-tokens seldom come again and are not kept.  A full memo takes no
    more, since the frequent ones are in it; when very many have been missing
    since, the texts have changed and it starts anew.
    """

    def __init__(self, library):
        super().__init__()
        self.tokenize = library.model.tokenize
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.missed = 0

    def __missing__(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            letters = piece.replace(" ", self.space)
        else:
            letters = piece.encode().decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.tokenize(letters)]).tobytes()
        if len(piece) <= MEMO_LENGTH:
            if len(self) < MEMO_ENTRIES:
                self[piece] = ids
            else:
                self.missed += 1
                if self.missed > 10 * MEMO_ENTRIES:
                    self.missed = 0
                    self.clear()
        return ids


class Encoder:
    """``ids(text)``: little-endian unsigned 32-bit ids of a whole text, as bytes."""

    def __init__(self, spec: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        rules = json.loads(spec)
        self.pattern, self.lower = _pattern(rules)
        added = [t for t in rules.get("added_tokens") or [] if t["content"]]
        if rules.get("normalizer") and any(t.get("normalized") for t in added):
            self.pattern = None  # these are looked for in the normalized text
        self.added = re.compile("|".join(re.escape(t["content"]) for t in added) or r"(?!)")
        if self.pattern is not None:
            self.memo = _Memo(self.library)

    def whole(self, text: str) -> bytes:
        return array("I", self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def ids(self, text: str) -> bytes:
        if self.pattern is None or self.added.search(text) or _ODD.search(text):
            return self.whole(text)
        return b"".join(map(self.memo.__getitem__, self.pattern.findall(text.lower() if self.lower else text)))


_ENCODERS: dict[int, Encoder] = {}


def encoder(vocabulary: Broadcast) -> Encoder:
    """One encoder for each vocabulary and Python worker; it lives as long as the worker."""
    key = hash(vocabulary.value)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(vocabulary.value)
    return _ENCODERS[key]
