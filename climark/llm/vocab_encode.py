"""Token ids by a public tokenizer file, word by word from a memo.

A byte-pair tokenizer first splits a text into words and then encodes each
word on its own, so a text's ids are its words' ids one after the other.  The
encoder keeps the ids of words it has met, as the tokenizer gave them, and
asks the tokenizer only for new ones.  Texts with characters outside a plain
range (where Unicode tables of two libraries could differ) and texts with the string
of a token that the file adds to its model (such as an end mark) are given to the
tokenizer whole.  The results are those of the library's ``encode`` of whole texts.

``encode_all`` takes a column of texts.  Where words begin with the space before them, a
space ends whatever comes before it unless it stands inside or at the end of other white
space; so texts are cut at spaces by Arrow, equal pieces of a slice of texts are looked up
once, and the ids are put together by numpy.
"""

from __future__ import annotations

import re
import struct
import threading
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20  # text whose pieces are looked up together
MEMO_WORDS = 400_000  # words in one of the two halves of a task's memo

_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿŒœ"
_DIGIT = "0-9²³¹¼-¾"
_SPACE = "\t\n\r\x20"
_PLAIN = "\t\n\r\x20-\x7e¡-¬®-ÿŒœ–—‘’“”…€"
#: How each file's tokenizer splits a plain text into words.
_WORDS = {
    "byte_bpe_50k.json": re.compile(
        f" ?[{_LETTER}]+|'(?:[stmd]|re|ve|ll)| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+"
        f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"),
    "word_bpe_49k.json": re.compile(
        f"[{_LETTER}]+|'(?:[stmd]|re|ve|ll)|[{_DIGIT}]|[^{_SPACE}{_LETTER}{_DIGIT}]+"),
}
_ODD = re.compile(f"[^{_PLAIN}]")
#: By byte: 0 space, 1 other white space, 2 an ASCII character outside the plain range, 3 a
#: part of any other character that is not ASCII, 4 the rest.
_KINDS = bytes(0 if b == 32 else 1 if chr(b) in _SPACE else 3 if b > 127 else 2 if b < 32 or b == 127 else 4
               for b in range(256))
#: Byte-level tokenizers write each byte as one printable character: printable
#: Latin-1 bytes as themselves, the others from U+0100 on.
_PRINTABLE = [b for b in range(256) if 0x21 <= b <= 0x7e or 0xa1 <= b <= 0xac or 0xae <= b]
_BYTE_CHARS = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}
_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]
_ENCODERS: dict[str, "Encoder"] = {}
_LOCK = threading.Lock()


class _Memo(dict):
    """Ids by word.  When it is full it becomes the old half, from which words
    still in use come back, and the half before that is let go."""

    def __init__(self, encode):
        super().__init__()
        self._encode, self._old = encode, {}

    def __missing__(self, word):
        got = self._old.get(word)
        if got is None:
            got = self._encode(word)
        self[word] = got
        return got

    def turn(self):
        self._old = dict(self)
        self.clear()

    def forget(self):
        self._old = {}
        self.clear()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        name = path.rsplit("/", 1)[-1]
        self.words = _WORDS.get(name)
        self.lower = name == "word_bpe_49k.json"
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = [t.lower() for t in added] if self.lower else added
        self.memo = _Memo(self.word)
        self.span_memo = _Memo(self.word_spans)

    def word(self, word: str) -> bytes:
        """Ids of one word, from the tokenizer's model."""
        if word.isascii() and word.isprintable():
            chars = word.replace(" ", "\u0120")
        else:
            chars = word.encode().decode("latin-1").translate(_BYTE_CHARS)
        ids = [t.id for t in self.tokenizer.model.tokenize(chars)]
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)

    def pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of pieces of text that begin and end where words do.  The memo keeps words,
        and pieces of more words are put together from them."""
        known, words = self.memo, self.words.findall
        return [known[t] if t[1:].isalpha() and t[0] == " " and t.isascii() else b"".join([known[w] for w in words(t)])
                for t in texts]

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        plain = text.lower() if self.lower else text
        if self.words is None or _ODD.search(text) or any(t in plain for t in self.added):
            return self.whole(text)
        if len(self.memo) > MEMO_WORDS:
            self.memo.turn()
        return b"".join(map(self.memo.__getitem__, self.words.findall(plain)))

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """``encode`` of every text of a string column (null: empty)."""
        return list(self.encode_each(texts))

    def encode_each(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode_all``, holding the ids of one slice of texts at a time."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.words is None or self.lower:
            for text in texts:
                yield self.encode(text.as_py())
            return
        at = 0
        while at < len(texts):
            ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:][:len(texts) + 1]
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, side="right")) - 1)
            yield from self._slice(texts.slice(at, to - at), ends[at:to + 1])
            at = to

    def _by_pieces(self, texts: pa.Array, ends: np.ndarray) -> np.ndarray:
        """Whether a text may be cut at its spaces, for every text."""
        if ends[-1] == ends[0]:
            return np.ones(len(texts), bool)
        raw = texts.buffers()[2].slice(ends[0], ends[-1] - ends[0]).to_pybytes().translate(_KINDS)
        kinds, bounds = np.frombuffer(raw, np.uint8), ends - ends[0]
        white = kinds < 2
        bad = 1 + np.flatnonzero((kinds[1:] == 0) & white[:-1])          # spaces after white space
        row = np.searchsorted(bounds, bad, side="right") - 1
        last = bad + 1 == bounds[row + 1]
        cut = (bad > bounds[row]) & (last | white[np.minimum(bad + 1, len(raw) - 1)])
        fine = np.ones(len(texts), bool)
        fine[row[cut]] = False
        fine[np.searchsorted(bounds, np.flatnonzero(kinds == 2), side="right") - 1] = False
        wide = np.unique(np.searchsorted(bounds, np.flatnonzero(kinds == 3), side="right") - 1)
        fine[[k for k in wide.tolist() if _ODD.search(texts[k].as_py())]] = False
        for mark in self.added:
            fine &= ~pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        return fine

    def _slice(self, texts: pa.Array, ends: np.ndarray) -> list[bytes]:
        fine = self._by_pieces(texts, ends)
        if len(self.memo) > MEMO_WORDS:
            self.memo.turn()
        coded = self._pieces(texts.filter(pa.array(fine)))
        if fine.all():
            return coded
        rest = iter(coded)
        return [next(rest) if ok else self.encode(texts[k].as_py()) for k, ok in enumerate(fine.tolist())]

    def _pieces(self, texts: pa.Array) -> list[bytes]:
        if not len(texts):
            return []
        cut = pc.split_pattern(texts, " ")
        begin = cut.offsets.to_numpy()[:-1].astype(np.int64) - cut.offsets[0].as_py()
        found = cut.flatten().dictionary_encode()
        codes = found.indices.to_numpy().astype(np.int64)
        kinds = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        # the first piece of a text has no space before it
        first, codes[begin] = np.unique(codes[begin], return_inverse=True)
        mask = np.ones(len(codes), bool)
        mask[begin] = False
        codes[mask] += len(first)
        ids = self.pieces([kinds[k] for k in first.tolist()]) + self.pieces([" " + k for k in kinds])
        size = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        flat, place = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        n = size.take(codes)
        stop = np.cumsum(n)
        index = np.repeat(place.take(codes) - (stop - n), n)
        index += np.arange(stop[-1])
        raw = flat.take(index).tobytes()
        at = np.append((stop - n)[begin], stop[-1]) * 4
        return [raw[a:z] for a, z in zip(at.tolist(), at[1:].tolist())]

    def word_spans(self, word: str) -> bytes:
        got = self.tokenizer.encode(word, add_special_tokens=False).offsets
        return np.array(got, dtype=np.int32).tobytes()

    def spans(self, text: str) -> np.ndarray:
        """(first character, end) of every token of a text, as the tokenizer's
        offsets; for tokenizers whose words cover the whole text."""
        if self.words is None or self.lower or _ODD.search(text) or any(t in text for t in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
        if len(self.span_memo) > MEMO_WORDS:
            self.span_memo.turn()
        words = self.words.findall(text)
        found = list(map(self.span_memo.__getitem__, words))
        begin = np.cumsum([0, *map(len, words)])[:-1]
        spans = np.frombuffer(b"".join(found), np.int32).reshape(-1, 2).astype(np.int64)
        return spans + np.repeat(begin, [len(f) // 8 for f in found])[:, None]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    with _LOCK:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        return _ENCODERS[path]


def with_encoder(path: str, run: Callable) -> Callable:
    """``run(encoder, batches)`` as a function of batches.  The words met are let go when the
    task ends: idle workers stay beside those of later stages and would keep theirs."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        try:
            yield from run(enc, batches)
        finally:
            enc.memo.forget()
            enc.span_memo.forget()
            pa.default_memory_pool().release_unused()

    return task
