"""Token ids of whole texts, with each distinct word of a batch encoded once.

A text is cut before white space that follows something else, and between a letter and a mark. The
tokenizers used here never make a token across such a place, so the ids of the pieces, one after
the other, are those of the text; a piece that occurs again costs a table lookup. Texts without
such places are one piece of any length.

A tokenizer that lower-cases, drops white space and tells letters, digits and marks apart, as ``_FOLDABLE`` says, is
asked for fewer pieces: letters of ASCII are lower-cased first, and texts are cut wherever two kinds of ASCII meet.
Its pieces go to the library as one text: those of Latin letters alone are the words it counts itself, others have a
mark between them whose id tells where each ends.

A worker remembers the ids of short pieces only, in a fixed number of bytes; others are encoded each time.
Null is an empty text, which has no ids.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa

from depotlake.llm.common import ragged_take, raw_texts

# Distinct pieces handed to the library at once: bounds the size of its result objects.
PIECES_AT_ONCE = 20_000
# What a worker remembers of pieces: short ones only, and about so many bytes of them in all.
PIECE_BYTES = 48
BYTES_KEPT = 80 << 20
# An entry's key, place and arrays besides the bytes of the piece and of its ids.
ENTRY_BYTES = 160

# What a byte is, by bits.
_WHITE, _LAST, _TWO, _MARK, _LETTER, _DIGIT, _SIGN = (1 << i for i in range(7))
_KINDS = bytearray(256)
for _bit, _bytes in (
    (_WHITE, [9, 10, 11, 12, 13, 32]),
    # Last bytes of the white space outside ASCII in UTF-8; after these a cut might split a run.
    (_LAST, [*range(0x80, 0x8B), 0xA0, 0xA8, 0xA9, 0xAF, 0x9F, *range(0x1C, 0x20)]),
    # First bytes of two-byte letters, which share those last bytes and are no white space.
    (_TWO, range(0xC3, 0xE0)),
    (_MARK, b".,;:!?"),
    (_LETTER, [*range(65, 91), *range(97, 123)]),
    (_DIGIT, range(48, 58)),
    # Neither the apostrophe, which begins an ending, nor what special tokens hold.
    (_SIGN, b"!\"#$%&()*+,-./:;=?@[\\]^`{}~"),
):
    for _byte in _bytes:
        _KINDS[_byte] |= _bit
_KINDS = bytes(_KINDS)
_SPACES = bytes(32 if _KINDS[b] & _WHITE else b for b in range(256))
_LOWER = _SPACES.lower()

# Steps of a tokenizer whose pieces can be folded. Lower-casing ASCII beforehand changes nothing but what a
# combining mark follows; white space is dropped, so all of it is as good as a space.
_FOLDABLE = (
    [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "Removed",
    True,
    [{"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}],
)
# Letters of ASCII and U+00C0 to U+00FF, which no normal form joins or parts.
_LATIN = re.compile(rb" *(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+").fullmatch
# One that no piece holds parts pieces that go to the library together. They are no other character's canonical form.
_BETWEEN = "@~^%&$#"


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _separators(path: str) -> dict[str, int]:
    """Marks that can part folded pieces, and their ids; none if the tokenizer's pieces are not to be folded."""
    steps = json.loads(tokenizer(path).to_str())
    splits = (steps["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    rest = [{k: s.get(k) for k in ("type", "add_prefix_space", "use_regex")} for s in splits[1:]]
    found = ((steps["normalizer"] or {}).get("normalizers"), splits[0].get("pattern"), splits[0].get("behavior"), splits[0].get("invert"), rest)
    special = "".join(t["content"] for t in steps["added_tokens"])
    whole = all(c in "<|>" or (c.islower() and c.isascii()) for c in special) and not any(
        t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in steps["added_tokens"]
    )
    if found != _FOLDABLE or not whole:
        return {}
    ids = {c: tokenizer(path).encode(c, add_special_tokens=False).ids for c in _BETWEEN}
    return {c: own[0] for c, own in ids.items() if len(own) == 1}


@cache
def _specials(path: str) -> list[bytes]:
    return [t.content.encode() for t in tokenizer(path).get_added_tokens_decoder().values()]


def _folded(data: np.ndarray, path: str) -> np.ndarray:
    """The bytes with spaces for white space and ASCII letters in lower case, but for those before a byte outside ASCII."""
    raw = data.tobytes()
    lower = raw.translate(_LOWER)
    if any(special in lower for special in _specials(path)):
        # It may be none in the text as it is written.
        return np.frombuffer(raw.translate(_SPACES), np.uint8)
    folded = np.frombuffer(lower, np.uint8)
    before = np.flatnonzero(data[1:] >= 0x80)
    before = before[(folded[before] != data[before]) & (folded[before] != 32)]
    if len(before):
        folded = folded.copy()
        folded[before] = data[before]
    return folded


def _cuts(bounds: np.ndarray, data: np.ndarray, fold: bool = False) -> np.ndarray:
    """Where pieces start, every document's own start included; ``fold`` cuts where kinds of ASCII meet."""
    kind = np.frombuffer(data.tobytes().translate(_KINDS), np.uint8)
    here, before = kind[1:], kind[:-1]
    white = (kind & _WHITE).view(bool)
    cut = white.copy()
    cut[1:] &= ~white[:-1]
    if fold:
        three = here & (_LETTER | _DIGIT | _SIGN)
        last = before & (_LETTER | _DIGIT | _SIGN)
        cut[1:] |= (three != last) & (three != 0) & (last != 0)
    else:
        # Both patterns end a run of letters before these marks, and no special token holds them.
        cut[1:] |= ((here & _MARK) != 0) & ((before & _LETTER) != 0)
    after = np.flatnonzero(cut)
    after = after[after > 0]
    doubtful = ((kind[after - 1] & _LAST) != 0) & ((kind[np.maximum(after - 2, 0)] & _TWO) == 0)
    cut[after[doubtful]] = False
    cut[: bounds[0]] = False
    cut[bounds[-1] :] = False
    cut[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    return np.flatnonzero(cut)


class _Pieces:
    """Ids of the short pieces seen by this worker, up to ``BYTES_KEPT``; the rest is encoded each time."""

    def __init__(self, path: str):
        self.path = path
        self.place: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.held = 0

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        word = np.zeros(len(pieces), bool)
        if _separators(self.path):
            word = np.fromiter((_LATIN(p) is not None for p in pieces), bool, len(pieces))
        order = np.argsort(~word, kind="stable")
        words = int(np.count_nonzero(word))
        for first, last in ((0, words), (words, len(pieces))):
            for i in range(first, last, PIECES_AT_ONCE):
                some = [pieces[k].decode() for k in order[i : min(i + PIECES_AT_ONCE, last)].tolist()]
                own, each = (first < words and self._words(some)) or self._together(some) or self._apart(some)
                ids.append(own)
                counts.append(each)
        flat, each = np.concatenate(ids), np.concatenate(counts)
        starts, sizes = np.zeros((2, len(pieces)), np.int64)
        starts[order], sizes[order] = np.cumsum(each) - each, each
        return ragged_take(flat, starts, sizes), sizes

    def _words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Of folded pieces of letters alone, each a word to the library; none if it counts others."""
        found = tokenizer(self.path).encode(" ".join(p.lstrip(" ") for p in pieces), add_special_tokens=False)
        if None in found.word_ids:
            return None
        counts = np.bincount(np.array(found.word_ids, np.int64), minlength=len(pieces))
        return (np.array(found.ids, np.uint32), counts) if len(counts) == len(pieces) and counts.all() else None

    def _apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = tokenizer(self.path).encode(pieces, is_pretokenized=True, add_special_tokens=False)
        return np.array(found.ids, np.uint32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(pieces))

    def _together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Of folded pieces as one text; none if the pieces cannot be told apart there."""
        separators = _separators(self.path)
        if not separators:
            return None
        text = "\n".join(pieces)
        for mark, number in separators.items():
            if mark not in text:
                found = np.array(tokenizer(self.path).encode(text.replace("\n", f" {mark} "), add_special_tokens=False).ids, np.uint32)
                ends = np.append(np.flatnonzero(found == number), len(found))
                if len(ends) == len(pieces):
                    return found[found != number], np.diff(ends, prepend=-1) - 1
        return None

    def lookup(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids in one array, and the start and count of each piece's ids in it."""
        places = np.fromiter(map(self.place.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(places < 0)
        # Short ones first, so that what is kept lies in front of what is used once.
        sizes = np.array([len(pieces[i]) for i in missing.tolist()], np.int64)
        missing, sizes = (x[np.argsort(sizes, kind="stable")] for x in (missing, sizes))
        new = [pieces[i] for i in missing.tolist()]
        ids, counts = self._encode(new)
        base = len(self.ids)
        all_ids = np.concatenate([self.ids, ids])
        starts = np.concatenate([self.starts, base + np.cumsum(counts) - counts])
        all_counts = np.concatenate([self.counts, counts])
        places[missing] = len(self.starts) + np.arange(len(missing))
        total = self.held + np.cumsum(ENTRY_BYTES + sizes + 4 * counts)
        kept = int(np.count_nonzero((sizes <= PIECE_BYTES) & (total <= BYTES_KEPT)))
        if kept:
            end = int(counts[:kept].sum())
            self.held = int(total[kept - 1])
            self.place.update(zip(new[:kept], range(len(self.starts), len(self.starts) + kept), strict=True))
            # Copies, so that the ids of long pieces are not held by a view.
            self.ids = all_ids[: base + end].copy()
            self.starts = starts[: len(self.starts) + kept].copy()
            self.counts = all_counts[: len(self.counts) + kept].copy()
        return all_ids, starts[places], all_counts[places]


@cache
def _pieces(path: str) -> _Pieces:
    return _Pieces(path)


def encode(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids (uint32) of a column of texts and the bounds of each text's ids."""
    bounds, data = raw_texts(column)
    fold = bool(_separators(path))
    cuts = _cuts(bounds, data, fold)
    if not len(cuts):
        return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
    edges = np.append(cuts, bounds[-1]).astype(np.int64)
    texts = _folded(data, path) if fold else data
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(cuts), [None, pa.py_buffer(edges), pa.py_buffer(texts)]
    ).dictionary_encode()
    ids, starts, counts = _pieces(path).lookup(pieces.dictionary.to_pylist())
    which = pieces.indices.to_numpy()
    lengths = counts[which]
    total = np.append(0, np.cumsum(lengths))
    return ragged_take(ids, starts[which], lengths), total[np.searchsorted(cuts, bounds)]


def with_end(ids: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each document."""
    out = np.insert(ids, bounds[1:], end) if len(bounds) > 1 else ids
    return out.astype(np.uint32), bounds + np.arange(len(bounds))
