"""Byte-level BPE ids of many texts at once.

The pre-tokens of a chunk are cut with numpy by the classes of their characters, and each distinct one goes through the
public tokenizer, once for as long as the cache keeps it. The ids are those of ``Tokenizer.encode`` with
``add_special_tokens=False``: the string of an added token is that token wherever it stands.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata

import numpy as np

from lexalign.llm.words import U64, ranges_hash

OTHER, LETTER, NUMBER, BLANK, UNKNOWN = range(5)
#: Entries of the cache of a process; it starts afresh before texts that would go beyond. Texts that have more themselves are
#: read with a cache of their own size, which goes with the next ones.
CACHE = 1 << 19
#: Pre-tokens that go through the tokenizer at once.
BATCH = 1 << 12
VOCABULARY = "byte_bpe_50k.json"

_classes: list[np.ndarray] = []
_encoders: dict[str, Encoder] = {}


def classes() -> np.ndarray:
    """Class of each code point, as the pre-tokenizer's pattern has them."""
    if not _classes:
        kinds = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((UNKNOWN if (c := unicodedata.category(chr(i))) == "Cn" else kinds.get(c[0], OTHER) for i in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
        table[[*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = BLANK
        _classes.append(table)
    return _classes[0]


def pretokens(points: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of pre-tokens in the code points of texts that begin at ``offsets`` (and end at the last of them)."""
    n = len(points)
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    start = begins[:n].copy()
    start[1:] |= kinds[1:] != kinds[:-1]
    # the last blank before a word belongs to it if it is a space, and else stands alone
    after = np.flatnonzero((kinds[1:] != BLANK) & (kinds[:-1] == BLANK) & ~begins[1:n]) + 1
    start[after] = points[after - 1] != 0x20
    start[after - 1] = True
    # 's 't 'm 'd 're 've 'll where a pre-token begins with the apostrophe
    quote = np.flatnonzero(start[: n - 1] & (points[: n - 1] == 0x27) & (kinds[1:n] == LETTER) & ~begins[1:n]) if n > 1 else np.zeros(0, np.int64)
    if len(quote):
        padded, ends = np.append(points, [0, 0, 0]), np.append(begins, [True, True])
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.any([(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")], axis=0) & ~ends[quote + 2]
        for at, size in ((quote[short], 2), (quote[long], 3)):
            start[at + 1] = False
            rest = at + size
            start[rest[rest < n]] = True
    return np.flatnonzero(start)


class Encoder:
    """One tokenizer and its cache of pre-tokens, for one process."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        #: Added tokens that are cut out of a text as they stand; others change the text around them.
        self.plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added)
        self.added = re.compile("|".join(re.escape(t.content) for t in sorted(added, key=lambda t: -len(t.content)))) if added else None
        (self.line,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.clear()

    def clear(self) -> None:
        """The cache: keys in order, and where each one's ids begin in the pool and how many there are."""
        self.keys = np.zeros(0, U64)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 12, np.uint32), 0

    def _learn(self, keys: np.ndarray, pieces: list[str], blank: np.ndarray) -> None:
        """Adds the ids of new pre-tokens, ``keys`` in order. Those that aren't blank go through the tokenizer as lines of one
        text: a line's end is a pre-token of its own there, whatever stands around it, and its id cuts the ids again."""
        at, size, ids = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int32), []
        total = self.used
        plain = np.flatnonzero(~blank)
        for begin in range(0, len(plain), BATCH):
            mine = plain[begin : begin + BATCH]
            got = np.array(self.tokenizer.encode("\n".join([*(pieces[i] for i in mine), ""]), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(got == self.line)
            if len(ends) != len(mine):
                raise AssertionError("a pre-token holds the end of a line")
            size[mine] = np.diff(ends, prepend=-1) - 1
            at[mine] = total + np.cumsum(size[mine]) - size[mine]
            ids.append(got[got != self.line])
            total += len(ids[-1])
        for i in np.flatnonzero(blank):
            got = self.tokenizer.encode(pieces[i], add_special_tokens=False).ids
            at[i], size[i] = total, len(got)
            ids.append(np.array(got, np.uint32))
            total += len(got)
        if total > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(total, np.uint32)])
        self.pool[self.used : total] = np.concatenate(ids)
        self.used = total
        where = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.size = np.insert(self.keys, where, keys), np.insert(self.at, where, at), np.insert(self.size, where, size)

    def _within(self, text: str, begin: np.ndarray, found: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Places of added tokens in each text; where one of ``found`` runs over the end of a text, the texts are read singly."""
        if all(begin[np.searchsorted(begin, a, "right")] >= b for a, b in found):
            return found
        return [(int(x) + m.start(), int(x) + m.end()) for x, y in zip(begin[:-1], begin[1:], strict=True) for m in self.added.finditer(text[x:y])]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in ``data`` (UTF-8), and where each text's begin, and the end."""
        try:
            text = data.tobytes().decode()
        except UnicodeDecodeError:
            parts = [data[a:b].tobytes().decode(errors="replace").encode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            return self.encode(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        where = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=where[1:])
        begin = where[offsets]
        kinds = classes()[points]
        special = [m.span() for m in self.added.finditer(text)] if self.added else []
        if (kinds == UNKNOWN).any() or special and not self.plain:  # newer characters than this table has: whole texts go through the tokenizer
            got = [self.tokenizer.encode(text[a:b], add_special_tokens=False).ids for a, b in zip(begin[:-1], begin[1:], strict=True)]
            return np.array([x for ids in got for x in ids], np.uint32), np.cumsum([0, *map(len, got)])
        if special:
            special = self._within(text, begin, special)
        edges = np.unique(np.concatenate([begin, np.array(special, np.int64).ravel()])) if special else begin
        starts = pretokens(points, kinds, edges)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if special:  # one piece each
            a, b = np.array(special).T
            at = np.searchsorted(a, starts, "right") - 1
            starts = starts[(at < 0) | (starts == a[at]) | (starts >= b[at])]
        ends = np.append(starts[1:], len(points))
        keys = ranges_hash(points.astype(U64), starts, ends)
        keys, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        new = np.flatnonzero(~self._has(keys))
        if len(new):
            if len(self.keys) + len(new) > CACHE:
                self.clear()
                new = np.arange(len(keys))
            begins, stops = starts[first[new]], ends[first[new]]
            self._learn(keys[new], [text[x:y] for x, y in zip(begins.tolist(), stops.tolist(), strict=True)], kinds[stops - 1] == BLANK)
        entry = np.searchsorted(self.keys, keys)[inverse]
        size = self.size[entry].astype(np.int64)
        total = np.cumsum(size)
        ids = self.pool[np.repeat(self.at[entry] - total + size, size) + np.arange(total[-1])]
        return ids, np.append(0, total)[np.searchsorted(starts, begin)]

    def _has(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys


def encoder(path: str | None = None) -> Encoder:
    """The encoder of this process for a vocabulary file, by default the installed public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
