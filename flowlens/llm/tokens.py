"""Token ids of whole texts, by the tokenizers library inside tasks."""

from __future__ import annotations

import functools
import os
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Runs of these four characters are white space to every pre-tokenizer in use, and none of them joins what
# stands before such a run with the run, so the ids of a text are the ids of these pieces one after another.
_WHITE = " \t\n\r"
# Other white space and separators may join such a run; texts that hold any are encoded in one call.
_OTHER_SPACE = "[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿]"
_NOT_LATIN = "[^\x00-\xff]"
# A plain word: at most one space or line end, Latin-1 letters (all of one class, composed, and of one length in
# either case), then ASCII punctuation without the apostrophe. Pre-tokenizers part it into exactly these three.
_STOPS = "".join(c for c in string.punctuation if c != "'")
_PLAIN = r"\A[ \n]?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+\z"  # a plain word without the punctuation
LONGEST_KEPT = 48  # characters of a piece that is remembered
MOST_KEPT = 600_000  # pieces in each of the two generations a worker remembers, if not told otherwise
AT_ONCE = 1 << 22  # bytes of texts that are encoded together; a longer text is taken alone
PIECES_AT_ONCE = 1 << 20  # pieces that are looked up together


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the others
    for the letters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


def _cut(raw: bytes | np.ndarray | pa.Buffer | memoryview | None, ends: np.ndarray) -> list[bytes]:
    """The bytes between one end and the next."""
    data = pa.py_buffer(b"" if raw is None else raw)
    cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64, "C")), data])
    return cut.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Encodes texts to ids, remembering the pieces it has met; one per worker and vocabulary file."""

    def __init__(self, path: str, most_kept: int = MOST_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # A text that holds the string of an added token, in any case, is encoded in one call.
        added = [re.escape(t.content) for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._alone = "|".join([_OTHER_SPACE, *(f"(?i:{content})" for content in added)])
        self._model, self._letters = self._tokenizer.model, _byte_letters()
        # Vocabularies with word ends drop white space and case; the others keep both.
        self._drops = bool(self._model.end_of_word_suffix)
        self._most_kept = most_kept
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _pieces(self, texts: pa.LargeStringArray) -> tuple[pa.Array, np.ndarray]:
        """The pieces of texts one after another, and for each text how many lie before it, and then how many there are."""
        if self._drops:
            texts = pc.if_else(pc.match_substring_regex(texts, _NOT_LATIN), texts, pc.utf8_lower(texts))
        _, edges, data = texts.buffers()
        edges = np.frombuffer(edges, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        low, high = edges[[0, -1]]
        raw = np.frombuffer(data or b"", np.uint8)[low:high]
        white = (raw == 32) | (raw == 10) | (raw == 9) | (raw == 13)
        begins = white.copy()
        begins[1:] &= ~white[:-1]
        begins[edges[:-1][edges[:-1] < edges[1:]] - low] = True
        starts = np.flatnonzero(begins) + low
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, high)), data)
        return pc.ascii_ltrim(pieces, _WHITE) if self._drops else pieces, np.searchsorted(starts, edges)

    def _remembered(self, pieces: list[str]) -> list[bytes | None]:
        """The ids of pieces, None for those that are not remembered."""
        found = list(map(self._new.get, pieces))
        if self._old and None in found:
            at = [i for i, ids in enumerate(found) if ids is None]
            for i, ids in zip(at, map(self._old.get, [pieces[i] for i in at])):
                if ids is not None:
                    self._new[pieces[i]] = found[i] = ids
        return found

    def _remember(self, pieces: list[str], learnt: list[bytes]) -> None:
        self._new.update(zip(pieces, learnt))
        for piece in [piece for piece in pieces if len(piece) > LONGEST_KEPT]:
            del self._new[piece]

    def _parts(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct pre-tokens. New ones go to the model, as the library gives it each pre-token; each is a piece too."""
        found = self._remembered(parts)
        at = [i for i, ids in enumerate(found) if ids is None]
        if not at:
            return found
        new, tokenize = [parts[i] for i in at], self._model.tokenize
        letters = "\0".join(new).encode().decode("latin-1").translate(self._letters).split(self._letters[0])
        ids, ends = [], [0]
        for part in letters:
            ids += [t.id for t in tokenize(part)]
            ends.append(4 * len(ids))
        learnt = _cut(np.array(ids, "<u4"), np.array(ends))
        self._remember(new, learnt)
        for i, some in zip(at, learnt):
            found[i] = some
        return found

    def _parted(self, texts: pa.Array, words: pa.Array) -> list[bytes]:
        """The ids of plain words with the punctuation behind them, given the words also without it. A line end, the word and the
        punctuation are pre-tokens; all are slices of the texts, one after another."""
        if not len(texts):
            return []
        if self._drops:  # lower case has the same length
            texts = pc.utf8_lower(texts)
        _, starts, data = texts.buffers()
        starts = np.frombuffer(starts, np.int64)[:len(texts) + 1]
        bounds = np.repeat(starts[:-1, None], 3, axis=1)
        bounds[:, 1] += pc.starts_with(texts, "\n").to_numpy(zero_copy_only=False)
        bounds[:, 2] += pc.binary_length(words).to_numpy()
        parts = pa.LargeStringArray.from_buffers(bounds.size, pa.py_buffer(np.append(bounds, starts[-1])), data).dictionary_encode()
        found = self._parts(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        _, ends, raw = pa.array(found, pa.large_binary()).take(parts.indices).buffers()
        return _cut(raw, np.frombuffer(ends, np.int64)[:bounds.size + 1:3])

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """The ids of new pieces."""
        texts = pa.array(pieces, pa.large_string())
        words = pc.ascii_rtrim(texts, _STOPS)
        plain = pc.match_substring_regex(words, _PLAIN)
        parted = iter(self._parted(texts.filter(plain), words.filter(plain)))
        return [next(parted) if one else self._whole(piece) for piece, one in zip(pieces, plain.to_numpy(zero_copy_only=False).tolist())]

    def _known(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces."""
        if len(self._new) >= self._most_kept:
            self._old, self._new = self._new, {}
        found = self._remembered(pieces)
        at = [i for i, ids in enumerate(found) if ids is None]
        if at:
            missing = [pieces[i] for i in at]
            learnt = self._learn(missing)
            self._remember(missing, learnt)
            for i, ids in zip(at, learnt):
                found[i] = ids
        return found

    def _ids(self, pieces: pa.Array) -> tuple[np.ndarray, memoryview]:
        """Where the ids of each piece end, in bytes, and the ids of all pieces one after another."""
        coded = pieces.dictionary_encode()
        found = pa.array(self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        _, ends, raw = found.take(coded.indices).buffers()
        return np.frombuffer(ends, np.int64)[1:len(pieces) + 1], memoryview(raw or b"")

    def _together(self, texts: pa.LargeStringArray) -> list[bytes]:
        """The ids of texts without other white space and added tokens."""
        if not len(texts):
            return []
        pieces, before = self._pieces(texts)
        ends, parts, size = [np.zeros(1, np.int64)], [], 0
        for i in range(0, len(pieces), PIECES_AT_ONCE):
            until, raw = self._ids(pieces.slice(i, PIECES_AT_ONCE))
            ends.append(until + size)
            parts.append(raw[:until[-1]])
            size += int(until[-1])
        return _cut(parts[0] if len(parts) == 1 else b"".join(parts), np.concatenate(ends)[before])

    def _some(self, texts: pa.LargeStringArray) -> Iterator[bytes]:
        whole = pc.match_substring_regex(texts, self._alone)
        known = iter(self._together(texts.filter(pc.invert(whole))))
        for text, alone in zip(texts, whole.to_pylist()):
            yield self._whole(text.as_py()) if alone else next(known)

    def encode_all(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers. The pieces of few texts are held at a time."""
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        edges, start = np.cumsum(pc.binary_length(texts).to_numpy()), 0
        while start < len(texts):
            before = edges[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(edges, before + AT_ONCE, "right")))
            yield from self._some(texts.slice(start, end - start))
            start = end

    def encode(self, text: str) -> bytes:
        """The ids of one text."""
        return next(self.encode_all([text]))


@functools.lru_cache(maxsize=4)
def encoder(path: str, most_kept: int = MOST_KEPT) -> Encoder:
    """The worker's encoder for a vocabulary file; workers are used again, so are the pieces."""
    return Encoder(path, most_kept)
