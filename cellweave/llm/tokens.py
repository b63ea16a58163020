"""Token ids of whole texts, each distinct piece of a slice encoded once.

A byte-level tokenizer whose pre-tokeniser splits by its pattern never joins what comes before a
run of white space to the run, nor letters to the full stop or comma behind them, nor a line break that ends
a run and has a letter behind it to either side. So the ids of the pieces between such cuts, joined, are
those of the text, special tokens included (none holds a cut). Cuts are found over whole arrays, Arrow
encodes the pieces as a dictionary, the library gives the ids of pieces that the worker does not remember
(its model alone, where a piece is a word that the pattern leaves whole), and one gather puts them in place.
Tokenizers of another make encode whole texts.
"""

from __future__ import annotations

import json
import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

from . import rolling

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces after which a worker begins a new generation of its memory; of two, the older is forgotten.
CACHED = 300_000
#: Text, in bytes, whose pieces are told apart at once.
SLICE = 1 << 22
#: Longest piece, in characters, that is remembered.
LONGEST = 40
#: Pieces that are encoded as lines of one text.
LINES = 8192
BLANK = rolling.SPACE
#: What may stand before a cut: neither white space nor another control character.
INK = np.arange(256) > 0x20
#: First bytes of the characters that the pattern may take for white space, beyond ASCII.
WIDE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
#: First bytes of U+00C0 to U+024F, all letters but the signs of times and division.
LEAD = np.isin(np.arange(256), np.arange(0xC3, 0xCA))
LETTER = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))
STOP = np.isin(np.arange(256), list(b".,"))
#: The letters of a byte-level vocabulary: a printable byte is its own Latin-1 letter, the others follow from 256 on, in order.
PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + n for n, b in enumerate(sorted({*range(256)} - PRINTED))}


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cuts_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bounds of the pieces of all texts, in bytes; every bound of a text is one."""
    n = len(data)
    here = np.zeros(n + 1, bool)
    here[offsets] = True
    if n > 1:
        ink = INK[data]
        ink[1:] &= ~WIDE[data[:-1]]
        ink[2:] &= ~WIDE[data[:-2]]
        alone = (data[:-1] == 10) & (LETTER | LEAD)[data[1:]] & ~here[1:n]
        here[1:n] |= (BLANK[data[1:]] & ink[:-1]) | (STOP[data[1:]] & LETTER[data[:-1]]) | alone
        here[: n - 1] |= alone
    return np.flatnonzero(here)


def lines_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which pieces may be a line among others: no line break in them, and no blank or wide character at the end."""
    ends = offsets[1:]
    breaks = np.r_[0, np.cumsum(data == 10)]
    last = INK[data[ends - 1]] & ~WIDE[data[np.maximum(ends - 2, 0)]] & ~WIDE[data[np.maximum(ends - 3, 0)]]
    return last & (breaks[ends] == breaks[offsets[:-1]])


def words_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which pieces are letters up to U+024F alone, after one space at most."""
    lead = LEAD[data]
    letter = LETTER[data] | lead
    letter[1:] |= lead[:-1]
    letter[1:] &= ~((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    other = np.r_[0, np.cumsum(~letter)]
    spaced = data[offsets[:-1]] == 0x20
    return (other[offsets[1:]] - other[offsets[:-1]] == spaced) & (np.diff(offsets) > spaced)


class Encoder:
    """Ids as the library gives them for whole texts without added special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        step = made["pre_tokenizer"] or {}
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(" \t\n\x0b\x0c\r.,") or t["content"][:1].isalpha() for t in made["added_tokens"])
        self.in_pieces = plain and all(made[x] is None for x in ("normalizer", "truncation", "padding")) and step.get("type") == "ByteLevel" and step.get("use_regex", True) and not step.get("add_prefix_space")
        alone = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_break = alone[0] if len(alone) == 1 else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_of_pieces(self, pieces: list[str]) -> list[bytes]:
        """As ``_ids`` for pieces that may be lines: all are lines of one text, as a line break between them is a token of its own."""
        found: list[bytes] = []
        for i in range(0, len(pieces), LINES):
            lines = pieces[i : i + LINES]
            if self.line_break is not None:
                (coded,) = self.tokenizer.encode_batch_fast(["\n".join(lines)], add_special_tokens=False)
                ids = np.array(coded.ids, "<u4")
                ends = np.r_[np.flatnonzero(ids == self.line_break), len(ids)]
                if len(ends) == len(lines):
                    raw = ids.tobytes()
                    starts = np.r_[0, ends[:-1] + 1]
                    found += [raw[a:b] for a, b in zip((4 * starts).tolist(), (4 * ends).tolist())]
                    continue
            found += self._ids(lines)
        return found

    def _ids_of_words(self, pieces: list[str]) -> list[bytes]:
        """As ``_ids`` for words: the pattern would leave them whole, so the model has them as they are."""
        model, space, ids, ends = self.tokenizer.model, chr(BYTE_LETTERS[0x20]), [], [0]
        for p in pieces:
            letters = p.replace(" ", space) if p.isascii() else p.encode().decode("latin-1").translate(BYTE_LETTERS)
            ids += [t.id for t in model.tokenize(letters)]
            ends.append(len(ids))
        raw = np.array(ids, "<u4").tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]

    def _remembered(self, pieces: list[str], words: list[bool], lines: list[bool]) -> list[bytes]:
        """Ids of distinct pieces; ``words`` and ``lines`` say which are a word or may be a line. What is asked for again moves to the young generation."""
        found = list(map(self.young.get, pieces))
        holes = [i for i, x in enumerate(found) if x is None]
        if holes:
            before = list(map(self.old.get, [pieces[i] for i in holes]))
            missing = [i for i, x in zip(holes, before) if x is None]
            alone = [i for i in missing if words[i]]
            rest = [i for i in missing if not words[i]]
            odd = [i for i in rest if not lines[i]]
            plain = [i for i in rest if lines[i]]
            coded = self._ids_of_words([pieces[i] for i in alone]) + self._ids_of_pieces([pieces[i] for i in plain]) + self._ids([pieces[i] for i in odd])
            fresh = dict(zip(alone + plain + odd, coded))
            for i, x in zip(holes, before):
                found[i] = fresh[i] if x is None else x
                if len(pieces[i]) <= LONGEST:
                    self.young[pieces[i]] = found[i]
            if len(self.young) >= CACHED:
                self.old, self.young = self.young, {}
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, as unsigned 32-bit; bounds of each text's in them); null gives none."""
        if not self.in_pieces:
            parts = self._ids([x or "" for x in texts.to_pylist()])
            return np.frombuffer(b"".join(parts), "<u4"), np.r_[0, np.cumsum([len(x) // 4 for x in parts])].astype(np.int64)
        data, offsets = rolling.buffer_of(texts)
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        bounds = cuts_of(data, offsets)
        cut = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])
        coded = cut.dictionary_encode()
        held = rolling.buffer_of(coded.dictionary)
        known = self._remembered(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), words_of(*held).tolist(), lines_of(*held).tolist())
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        table = np.frombuffer(b"".join(known), "<u4")
        which = coded.indices.to_numpy()
        each = size[which]
        ids = table[rolling.ranges((np.cumsum(size) - size)[which], each)]
        ends = np.r_[0, np.cumsum(each)]
        return ids, ends[np.searchsorted(bounds, offsets)]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with end_id after each text's, and their bounds."""
    n = len(bounds) - 1
    out = np.full(len(ids) + n, end_id, "<u4")
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(bounds))] = ids
    return out, bounds + np.arange(n + 1)
