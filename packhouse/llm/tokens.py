"""Token ids of whole texts by a public tokenizer file, as 16-bit little-endian bytes.

The word tokenizer drops white space and never joins across it, so a text's ids
are those of its space-separated parts in a row.  Parts seen before are looked
up; new ones are encoded together, with a special token between them.
"""

from __future__ import annotations

import functools
import os
import re
from array import array

import numpy as np

# The table is emptied once it holds so many bytes: what its parts and ids take, and what an entry costs besides.
_KEEP = 176 << 20
_ENTRY = 180
_loaded: dict[str, WordIds] = {}
# Characters beyond U+024F, and the one below that has two in lower case.
_OTHERS = re.compile("[^\x00-\u012f\u0131-\u024f]")


def _lower(t: bytes) -> bytes:
    """Lower case, where that is what the tokenizer's own normalizing would come to: up to U+024F, all characters are composed."""
    if t.isascii():
        return t.lower()
    text = t.decode("utf-8", "replace")
    return t if _OTHERS.search(text) else text.lower().encode()


def _normal(text: str) -> bool:
    return text == text.lower() and (text.isascii() or not _OTHERS.search(text))


def _byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next free one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return {b: chr(b) if b in shown else chr(next(free)) for b in range(256)}


_BYTES = _byte_characters()
# Signs that are words of their own to the tokenizer after a letter or digit.
_SIGNS = frozenset(b".,!?;:")


class WordIds:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        self.path = path
        # For text that is normal already; normalizing costs more than the merges.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        special = self.plain.get_added_tokens_decoder()
        if self.plain.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.special = [t.content.encode() for t in special.values()]
        self.mark_id, self.mark = next((i, t.content) for i, t in special.items())
        self.known: dict[bytes, bytes] = {}
        self.held = 0
        self.signs = {s: self._ids(self.plain, chr(s)) for s in _SIGNS}

    @functools.cached_property
    def tokenizer(self):
        """With its normalizer: loaded where a text needs it, which few do."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @staticmethod
    def _ids(tokenizer, text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _whole(self, text: bytes) -> bytes:
        return self._ids(self.tokenizer, text.decode("utf-8", "replace"))

    def _learn(self, new: set[bytes]) -> None:
        others: tuple[list[str], list[str]] = ([], [])
        merge = self.plain.model.tokenize
        known = self.known

        def letters(x: bytes) -> bytes | None:
            """Ids of a run of letters: one word of the model, in the characters that stand for its bytes."""
            # Letters of ASCII stand for their own bytes; of bytes, only these count as letters.
            if x.isalpha() and x.islower():
                shown = x.decode("ascii")
            else:
                text = x.decode("utf-8", "replace")
                if not (text.isalpha() and _normal(text)):
                    return None
                shown = x.decode("latin-1").translate(_BYTES)
            found = known.get(x)
            if found is None:
                found = known[x] = array("H", [t.id for t in merge(shown)]).tobytes()
            return found

        for x in new:
            if x[-1] in _SIGNS and (base := letters(x[:-1])) is not None:
                known[x] = base + self.signs[x[-1]]
            elif letters(x) is None:
                text = x.decode("utf-8", "replace")
                others[_normal(text)].append(text)
        for words, plain in zip(others, (False, True)):
            tokenizer = self.plain if plain else self.tokenizer if words else None
            for lo in range(0, len(words), 256):
                part = words[lo : lo + 256]
                ids = np.array(tokenizer.encode_batch_fast([f" {self.mark} ".join(part)], add_special_tokens=False)[0].ids, "<u2")
                ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
                start = 0
                for x, end in zip(part, ends.tolist(), strict=True):
                    self.known[x.encode()] = ids[start:end].tobytes()
                    start = end + 1

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if self.held > _KEEP:
            self.known.clear()
            self.held = 0
        look = self.known.get
        found: list[list[bytes | None]] = []
        gaps: list[tuple[list[bytes | None], list[bytes]]] = []
        for t in texts:
            # The names of special tokens are tokens as they stand, in their own case only.
            if any(s in t for s in self.special):
                found.append([self._whole(t)])
                continue
            parts = _lower(t).split()
            ids = list(map(look, parts))
            if None in ids:
                gaps.append((ids, parts))
            found.append(ids)
        new = {x for ids, parts in gaps for i, x in zip(ids, parts) if i is None}
        self._learn(new)
        # Ids are at most two bytes a byte; letters before a sign are an entry of their own.
        self.held += sum(3 * len(x) + _ENTRY for x in new) * 3 // 2
        for ids, parts in gaps:
            for at, i in enumerate(ids):
                if i is None:
                    ids[at] = self.known[parts[at]]
        return [b"".join(ids) for ids in found]


def word_ids(path: str) -> WordIds:
    """The tokenizer of a file, loaded once in a worker."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]
