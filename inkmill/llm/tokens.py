"""Token ids of whole texts, exactly those of the tokenizers library, a piece at a time.

The two public vocabularies split a text before they merge bytes, and some borders are always split: that between a
character that is no white space and a following ASCII white space, and that between a letter or digit and a following
ASCII punctuation mark. A text's ids are the ids of its pieces between such borders, so pieces that come again are
taken from a table. A text with other white space than ASCII's, or with a piece whose end isn't a letter or digit beyond doubt,
is encoded as a whole. The table of a worker process is bounded; pieces above 64 bytes aren't kept in it.
Strings of special tokens in a text are encoded as the library does by default, as those tokens. A tokenizer
file of another make is always used on whole texts.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from functools import lru_cache
from pathlib import Path

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
TABLE = 250_000
LONGEST = 64
#: Where a megabyte of text may be cut: after a character that is no white space and before an ASCII one.
_BORDER = re.compile(rb"[^ \t-\r](?=[ \t-\r])")
_MARK = rb"!-/:-@\[-`{-~"
_PIECE = re.compile(rb"[ \t-\r]*[^ \t-\r%b]+|[%b][^ \t-\r]*|[ \t-\r]+[^ \t-\r]*" % (_MARK, _MARK))
_PIECE_NO_SPACE = re.compile(rb"[^ \t-\r%b]+|[%b][^ \t-\r]*" % (_MARK, _MARK))
#: White space other than ASCII's six, and characters that some libraries count as such.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    ⁠　﻿]")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _kind(made: dict) -> str:
    """byte: white space counts, nothing is normalised; word: lower case, white space only parts; else other."""
    before, norm = made.get("pre_tokenizer") or {}, made.get("normalizer")
    if norm is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space"):
        return "byte"
    steps = [x.get("type") for x in (norm or {}).get("normalizers", [])]
    split = [x.get("behavior") for x in before.get("pretokenizers", []) if x.get("type") == "Split"]
    return "word" if steps == ["NFC", "Replace", "Lowercase"] and split == ["Removed"] else "other"


def _settings(text: str) -> dict:
    """What a tokenizer file says besides its vocabulary, which comes last and is large."""
    head, found, _ = text.rpartition('"model":')
    try:
        return json.loads(head.rstrip().rstrip(",") + "}") if found else json.loads(text)
    except ValueError:
        return json.loads(text)


def _sure_end(text: str) -> bool:
    """Whether a piece ends in ASCII or in a letter or digit, also in lower case (which may add an accent of its own)."""
    return text[-1] < "\x80" or all(unicodedata.ucd_3_2_0.category(c)[0] in "LN" for c in (text[-1], text.lower()[-1]))


class Encoder:
    """text (UTF-8) -> its ids as little-endian u32 bytes.

    The table has two generations of at most size pieces (of 140 bytes or so each): a piece found in the old one moves to the new one, and
    when the new one is full it becomes the old one.
    """

    def __init__(self, path: str, size: int = TABLE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = size
        self.kind = _kind(_settings(Path(path).read_text(encoding="utf-8")))
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def whole(self, data: bytes) -> bytes:
        return array("I", self.tokenizer.encode(data.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()

    def __call__(self, data: bytes) -> bytes:
        if self.kind == "other":
            return self.whole(data)
        find, source = _PIECE.findall, data
        if self.kind == "word":
            find = _PIECE_NO_SPACE.findall
            if b"<|" not in data:  # a special token's string in other case isn't one
                source = data.translate(_LOWER)
        out, at = [], 0
        while at < len(source):  # a megabyte or so at a time, cut where a piece begins
            end = at + (1 << 20)
            if end < len(source):
                cut = _BORDER.search(source, end)
                end = cut.start() + 1 if cut else len(source)
            ids = self._ids(find(source[at:end]))
            if ids is None:
                return self.whole(data)
            out.append(ids)
            at = end
        return b"".join(out)

    def _ids(self, pieces: list[bytes]) -> bytes | None:
        """The ids of pieces; None if one of them can't be told apart from its neighbours."""
        out = list(map(self.new.get, pieces))
        missing = [i for i, x in enumerate(out) if x is None]
        if missing:
            met = {p: self.old.get(p) for p in map(pieces.__getitem__, missing)}
            fresh = [p for p, x in met.items() if x is None]
            texts = [p.decode("utf-8", "replace") for p in fresh]
            if _OTHER_SPACE.search("".join(texts)) or not all(map(_sure_end, texts)):
                return None
            for p, e in zip(fresh, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                met[p] = array("I", e.ids).tobytes()
            for i in missing:
                out[i] = met[pieces[i]]
            self.new.update((p, x) for p, x in met.items() if len(p) <= LONGEST)
            if len(self.new) > self.size:
                self.old, self.new = self.new, {}
        return b"".join(out)


@lru_cache(maxsize=4)
def encoder(path: str, size: int = TABLE) -> Encoder:
    """The encoder of a vocabulary file, one a worker process."""
    return Encoder(path, size)
