"""Token ids of many texts from a byte-level BPE file of the tokenizers library.

Each distinct piece (word with its leading space, number, punctuation run, white space) goes to
the library once per worker and is looked up afterwards; cutting a text into pieces and the look-up
are numpy operations. Texts with characters whose class is not settled by their bytes go to the
library whole, so the ids are always the library's own.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from docketry.llm.text_batches import ByteSums

LETTER, DIGIT, WHITE, OTHER, UNSURE = range(5)
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123)]] = LETTER
_CLASS[48:58] = DIGIT
_CLASS[[9, 10, 11, 12, 13, 32]] = WHITE
_CLASS[[*range(0x1C, 0x20)]] = UNSURE
_CLASS[128:] = UNSURE
_CLASS[0xC3] = LETTER
#: Pieces that a worker remembers; when there are more, it starts anew.
REMEMBERED = 1 << 21
_SEPARATOR = "\n"
_PER_CALL = 2000


def _classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte; two-byte letters from U+00C0 to U+00FF are letters but for the two signs."""
    kind = _CLASS[data]
    if (data >= 128).any():
        lead = np.concatenate([[False], data[:-1] == 0xC3])
        kind[lead & (data >= 128)] = LETTER
        kind[lead & ((data == 0x97) | (data == 0xB7))] = UNSURE
    return kind


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of all texts start, and which texts have bytes of an unsure class.

    Pieces follow the file's pattern: contractions; runs of letters, of digits or of other signs,
    each with one space before it; white space, of which the last before a sign stands alone.
    """
    n = len(data)
    kind = _classes(data)
    unsure = np.zeros(len(offsets) - 1, bool)
    if (kind == UNSURE).any():
        unsure[np.searchsorted(offsets, np.flatnonzero(kind == UNSURE), "right") - 1] = True
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[255], kind[:-1]]).astype(np.uint8)
    before[edge[:-1]] = 255
    run = kind != before
    spaced = np.concatenate([[False], data[:-1] == 32]) & ~edge[:-1]
    start = run & ((kind == WHITE) | ~spaced)
    after = np.concatenate([kind[1:], [255]]).astype(np.uint8)
    after[edge[1:]] = 255
    start |= (kind == WHITE) & (after != WHITE) & (after != 255)
    quotes = np.flatnonzero((data == 39) & run & ~spaced)
    if len(quotes):
        ends = offsets[np.searchsorted(offsets, quotes, "right")]
        one = np.where(quotes + 1 < ends, data[np.minimum(quotes + 1, n - 1)], 0)
        two = np.where(quotes + 2 < ends, data[np.minimum(quotes + 2, n - 1)], 0)
        short = np.isin(one, list(b"stmd"))
        long = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
        taken = short | long
        at, stop = quotes[taken], quotes[taken] + np.where(short, 2, 3)[taken]
        start[at + 1] = False
        stop = stop[stop < ends[taken]]
        # What follows a contraction is a new piece, but for a sign that a space before it goes with.
        start[stop] = True
    return np.flatnonzero(start | edge[:-1]) if n else np.zeros(0, np.int64), unsure


class Encoder:
    """Ids of texts by the tokenizers library, with the pieces it has seen kept in flat arrays."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._specials = [t.content.encode() for t in self._library.get_added_tokens_decoder().values()]
        self._separator = self._library.encode(_SEPARATOR, add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self._bits = 16
        self._slots = np.zeros(1 << self._bits, np.uint64)
        self._entry = np.zeros(1 << self._bits, np.int32)
        self._keys = np.zeros(0, np.uint64)
        self._from = np.zeros(1, np.int64)
        self._ids = np.zeros(0, np.int32)

    def _whole(self, text: str) -> list[int]:
        return self._library.encode(text, add_special_tokens=False).ids

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key, -1 where there is none: open addressing, all keys a step at a time."""
        mask = np.uint64(len(self._slots) - 1)
        found = np.full(len(keys), -1, np.int32)
        slot = (keys & mask).astype(np.int64)
        held = self._slots[slot]
        hit = held == keys
        found[hit] = self._entry[slot[hit]]
        left = np.flatnonzero(~hit & (held != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & int(mask)
            held = self._slots[slot[left]]
            hit = held == keys[left]
            found[left[hit]] = self._entry[slot[left[hit]]]
            left = left[~hit & (held != 0)]
        return found

    def _place(self, keys: np.ndarray, entries: np.ndarray) -> None:
        if 2 * (len(self._keys)) > len(self._slots):
            while 2 * len(self._keys) > len(self._slots):
                self._bits += 1
                self._slots = np.zeros(1 << self._bits, np.uint64)
            self._entry = np.zeros(1 << self._bits, np.int32)
            keys, entries = self._keys, np.arange(len(self._keys), dtype=np.int32)
        slot = (keys & np.uint64(len(self._slots) - 1)).astype(np.int64)
        while len(keys):
            free = self._slots[slot] == 0
            self._slots[slot[free]] = keys[free]
            mine = free & (self._slots[slot] == keys)
            self._entry[slot[mine]] = entries[mine]
            keys, entries, slot = keys[~mine], entries[~mine], (slot[~mine] + 1) & (len(self._slots) - 1)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        if len(self._keys) + len(keys) > REMEMBERED:
            self._forget()
        ids: list[list[int]] = []
        for a in range(0, len(texts), _PER_CALL):
            ids += self._encoded(texts[a : a + _PER_CALL])
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for one in ids for x in one), np.int32, int(counts.sum()))
        entries = np.arange(len(self._keys), len(self._keys) + len(keys), dtype=np.int32)
        self._keys = np.concatenate([self._keys, keys])
        self._from = np.concatenate([self._from, self._from[-1] + np.cumsum(counts)])
        self._ids = np.concatenate([self._ids, flat])
        self._place(keys, entries)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        """Ids of single pieces: many to a call with a line end between them, white space by itself."""
        solid = [t for t in texts if not t.isspace()]
        out: list[list[int]] = [[]]
        (mark,) = self._separator
        for x in self._whole(_SEPARATOR.join(solid)) if solid else ():
            if x == mark:
                out.append([])
            else:
                out[-1].append(x)
        if solid and len(out) != len(solid):
            return [self._whole(t) for t in texts]
        each = iter(out)
        return [self._whole(t) if t.isspace() else next(each) for t in texts]

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row and how many each text has; `end_id` is put after each text."""
        starts, apart = piece_starts(data, offsets)
        raw = data.tobytes()
        for special in self._specials:
            at = raw.find(special)
            while at >= 0:
                apart[np.searchsorted(offsets, at, "right") - 1] = True
                at = raw.find(special, at + 1)
        stops = np.append(starts[1:], len(data))
        of = np.searchsorted(offsets, starts, "right") - 1
        if apart.any():
            keep = ~apart[of]
            starts, stops, of = starts[keep], stops[keep], of[keep]
        keys = ByteSums(data).of(starts, stops) | np.uint64(1)
        entry = self._find(keys)
        if (entry < 0).any():
            new = np.flatnonzero(entry < 0)
            fresh, first = np.unique(keys[new], return_index=True)
            first = new[first]
            before = len(self._keys)
            self._learn(fresh, [raw[a:b].decode() for a, b in zip(starts[first].tolist(), stops[first].tolist(), strict=True)])
            entry = self._find(keys) if len(self._keys) < before + len(fresh) else np.where(entry < 0, self._find(keys), entry)
            if (entry < 0).any():  # all was forgotten meanwhile: this piece's own texts are learned again
                new = np.flatnonzero(entry < 0)
                fresh, first = np.unique(keys[new], return_index=True)
                first = new[first]
                self._learn(fresh, [raw[a:b].decode() for a, b in zip(starts[first].tolist(), stops[first].tolist(), strict=True)])
                entry = self._find(keys)
        size = self._from[entry + 1] - self._from[entry]
        docs = len(offsets) - 1
        counts = np.bincount(of, size, docs).astype(np.int64)
        whole = {int(d): np.array(self._whole(raw[offsets[d] : offsets[d + 1]].decode()), np.int32) for d in np.flatnonzero(apart)}
        for d, ids in whole.items():
            counts[d] = len(ids)
        counts += end_id is not None
        out = np.empty(int(counts.sum()), np.int32)
        where = np.concatenate([[0], np.cumsum(counts)])
        # The place of each piece's first id: the ids of its text before it, after the text's start.
        shift = np.cumsum(size) - size
        own = np.concatenate([[0], np.cumsum(np.bincount(of, size, docs).astype(np.int64))])
        place = where[of] + shift - own[of]
        inner = np.arange(int(size.sum())) - np.repeat(shift, size)
        out[np.repeat(place, size) + inner] = self._ids[np.repeat(self._from[entry], size) + inner]
        for d, ids in whole.items():
            out[where[d] : where[d] + len(ids)] = ids
        if end_id is not None:
            out[where[1:] - 1] = end_id
        return out, counts


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def ids_column(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
