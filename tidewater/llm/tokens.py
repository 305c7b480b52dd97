"""Token ids of whole texts with a public tokenizer file, for the packing and
the token-output operators.

The tokenizer drops white space and never merges across it, nor across the
border between letters and ASCII symbols, so a text's ids are the ids of the
chunks between them in order. Chunks repeat far more often than texts, so a
batch is cut into chunks as one array of bytes, equal chunks are counted by
Arrow, and each worker encodes a chunk once and keeps its ids in a cache of
bounded size. New words that the tokenizer's normalizer leaves as they are go
to its model without it; the others pass the whole tokenizer. A text that holds
the tokenizer's special-token marker is encoded in one piece instead, because
those strings are found before lower-casing.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np
import pyarrow as pa

from tidewater.llm.common import LOWER, spread

_MARK = b"<|"
#: Kinds of bytes: white space, ASCII letters, the second byte of a letter from U+00C0 to
#: U+00FF, ASCII symbols, the apostrophe (it may join letters: 's), all others.
_SPACE, _LETTER, _LATIN, _SYMBOL, _QUOTE, _OTHER = range(6)


def _kind(b: int) -> int:
    if b in b" \t\n\r\x0b\x0c":
        return _SPACE
    if 97 <= b <= 122:
        return _LETTER
    return _QUOTE if b == 39 else _SYMBOL if 33 <= b <= 126 and not chr(b).isalnum() else _OTHER


_KINDS = bytes(map(_kind, range(256)))
#: Bytes that after 0xC3 make a letter: all but the signs of multiplication and division.
_AFTER_C3 = np.array([0x80 <= b <= 0xBF and b not in (0x97, 0xB7) for b in range(256)])
#: Whether a chunk starts at a byte: by 6 times the kind of the byte before and its own.
_STARTS = bytes([now != _SPACE and (before == _SPACE or (before in (_LETTER, _LATIN) and now in (_SYMBOL, _QUOTE))
                                    or (before == _SYMBOL and now == _LETTER)) for before in range(6) for now in range(6)]
                ).ljust(256, b"\0")
#: Lower-case Latin, Greek and Cyrillic letters: normalizing leaves words of them as they are.
SETTLED = "".join(c for c in map(chr, range(0x530)) if c.isalpha() and unicodedata.normalize("NFC", c).lower() == c)
_SETTLED = re.compile(f"[{SETTLED}]+")


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def cut_chunks(raws: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All chunks of the texts, A-Z lower-cased, one after the other, and each text's count."""
    low = b" ".join([*raws, b""]).translate(LOWER)
    data, kinds = np.frombuffer(low, np.uint8), np.frombuffer(bytearray(low.translate(_KINDS)), np.uint8)
    if len(lead := np.flatnonzero(data[:-1] == 0xC3)):
        kinds[lead[_AFTER_C3[data[lead + 1]]] + 1] = _LATIN
    pairs = kinds.copy()
    pairs[1:] += kinds[:-1] * np.uint8(6)  # the first byte follows white space, kind 0
    starts = np.frombuffer(pairs.tobytes().translate(_STARTS), bool)
    at, solid = np.flatnonzero(starts), kinds != _SPACE
    ends = np.cumsum([len(r) + 1 for r in raws], dtype=np.int64)
    counts = np.diff(np.searchsorted(at, ends), prepend=0)
    solid_bytes = data[solid]
    offsets = np.append(np.flatnonzero(starts[solid]), len(solid_bytes)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(solid_bytes)]), counts


class _Codes(dict):
    """Chunk to its place in the cache; chunks asked for the first time get the next one."""

    def __init__(self, *args):
        super().__init__(*args)
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = code = len(self)
        self.new.append(chunk)
        return code


class ChunkEncoder:
    """Encodes texts to ids; at most ``max_cached`` chunks are kept between batches."""

    def __init__(self, path: str, max_cached: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit
        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.token_to_id("<|endoftext|>")
        # the same model for words that need no normalizing; ASCII letters stand for themselves at byte level
        self.ascii_words, self.settled_words = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
        self.ascii_words.pre_tokenizer = WhitespaceSplit()
        self.settled_words.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.max_cached = max_cached
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._clear()

    def _clear(self):
        self.code = _Codes()
        self.flat = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.seen = np.zeros(0, np.int64)

    def _evict(self):
        """Drop the chunks seen once; if that leaves too many, drop all."""
        stay = np.flatnonzero(self.seen > 1)
        if len(stay) > self.max_cached * 0.7:
            self._clear()
            return
        keys = np.array(list(self.code), object)[stay]
        self.code = _Codes((c, k) for k, c in enumerate(keys))
        lengths = self.length[stay]
        self.flat = self.flat[spread(self.start[stay], lengths)]
        self.start, self.length = np.cumsum(lengths) - lengths, lengths
        self.seen = np.ones(len(stay), np.int64)

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def whole(self, text: str) -> np.ndarray:
        return self._ids(self.tokenizer, text)

    def _encode_list(self, chunks: list[bytes], words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after the other, and each chunk's count. Chunks
        of letters only are one word each, so their ends show in the ids of the
        tokenizer ``words``; others are told apart by the end-of-text marker."""
        flat, lengths = [], []
        for at in range(0, len(chunks), 500):
            part = chunks[at:at + 500]
            if words is not None:
                ids = self._ids(words, b" ".join(part).decode())
                cuts = np.flatnonzero(self.ends_word[ids])
                if len(cuts) == len(part):
                    flat.append(ids)
                    lengths.append(np.diff(cuts, prepend=-1))
                    continue
            ids = np.append(self.whole(b" <|endoftext|> ".join(part).decode()), np.uint32(self.separator))
            cuts = np.flatnonzero(ids == self.separator)
            flat.append(ids[ids != self.separator])
            lengths.append(np.diff(cuts, prepend=-1) - 1)
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty.astype(np.uint32), *flat]), np.concatenate([empty, *lengths])

    def _learn(self, chunks: list[bytes]):
        """Encode new chunks and append their ids, in the order of the chunks."""
        ways = [self.ascii_words, self.settled_words, self.tokenizer, None]
        way = np.where(np.fromiter(map(bytes.isalpha, chunks), bool, len(chunks)), 0, 3)  # of bytes: ASCII letters alone
        for k in np.flatnonzero(way).tolist():
            text = chunks[k].decode()
            if not text.isascii():
                way[k] = 1 if _SETTLED.fullmatch(text) else 2 if text.lower().isalpha() else 3
        places = [np.flatnonzero(way == w) for w in range(len(ways))]
        done = [self._encode_list([chunks[k] for k in at.tolist()], words) for at, words in zip(places, ways)]
        order, counts = np.concatenate(places), np.concatenate([n for _, n in done])
        lengths, starts = np.empty(len(chunks), np.int64), np.empty(len(chunks), np.int64)
        lengths[order], starts[order] = counts, len(self.flat) + np.cumsum(counts) - counts
        self.start = np.concatenate([self.start, starts])
        self.flat = np.concatenate([self.flat, *[ids for ids, _ in done]])
        self.length = np.concatenate([self.length, lengths])
        self.seen = np.concatenate([self.seen, np.zeros(len(chunks), np.int64)])

    def batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and each text's count."""
        if len(self.code) > self.max_cached:
            self._evict()
        raws, wholes = [(text or "").encode("utf-8", "replace") for text in texts], {}
        for k, raw in enumerate(raws):
            if _MARK in raw:
                wholes[k], raws[k] = self.whole(texts[k]), b""
        chunks, counts = cut_chunks(raws)
        distinct = chunks.dictionary_encode()
        known = np.fromiter(map(self.code.__getitem__, distinct.dictionary.to_numpy(zero_copy_only=False)), np.int64, len(distinct.dictionary))
        if self.code.new:
            self._learn(self.code.new)
            self.code.new = []
        place = distinct.indices.to_numpy()
        self.seen[known] += np.bincount(place, minlength=len(known))
        at = known[place]
        lengths = self.length[at]
        ids = self.flat[spread(self.start[at], lengths)]
        ends = np.cumsum(counts)
        sums = np.concatenate([[0], np.cumsum(lengths)])
        per = sums[ends] - sums[ends - counts]
        if wholes:
            parts = np.split(ids, np.cumsum(per)[:-1])
            for k, w in wholes.items():
                parts[k] = w
            return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, per


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder a worker process and file; its cache outlives tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
