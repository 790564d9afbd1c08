"""Language identification with hyperdimensional profiles.

Every letter owns a random vector of +1 and -1 in ``DIM`` dimensions, drawn
from its code point.  A trigram's vector binds (multiplies) its letters'
vectors, the first rotated by two places and the second by one; a text's
vector bundles (adds) those of its trigrams, a language's prototype those of
its training texts, each text scaled to length one.  A text gets the language
whose prototype has the largest cosine with its vector, after taking the mean
prototype off both (what all languages share tells none apart).

The best of several centred cosines is never below 0, so rejecting needs a floor
above that.  A text like no language has a random vector, whose cosines scatter
around 0 by 1/sqrt(DIM) however long it is: the least floors are three times that
(from 32 distinct trigrams) and four times (from 64).  ``calibrate`` sets the floor of each class of texts (by distinct trigrams, in
powers of two) to half the cosine that all but ``SPARED`` of the class's training
texts reach with their own language, where that is more.  Texts of fewer than 32
distinct trigrams have no least floor: real ones reach no more than noise.

Texts are lower-cased; letters stay (those above U+FFFF by codes that no letter
has), everything else is one blank.  Whole texts
count.  Training counts trigrams by language over all training rows and adds
up their vectors by task and dimension; only the prototypes (languages x DIM
numbers) reach the driver.

Defined results for odd input: a text that is null or has no letter is ``und``
with score 0; rows with a null label train nothing; with no training text at
all every text is ``und``; equal cosines go to the language first by name;
repeated rows are judged one by one; further columns are passed through, and
result columns replace input columns of the same name.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climark.llm.common import held_out, in_parts

DIM = 1024
UNDECIDED = "und"
NOISE = 1 / DIM ** 0.5 # spread of the cosines of a text like no language
LEAST = ((64, 4), (32, 3), (1, 0))   # distinct trigrams, least floor in NOISE
SPARED = 0.01          # share of a class's training texts left out of its floor
CLASS_ROWS = 100       # training texts from which a class has a floor of its own
_CLASSES, _BINS = 32, 200
_CODES = 1 << 16
_UNUSED, _N_UNUSED = 0xD800, 0x2100   # surrogates and private use: codes of the letters above U+FFFF
SLICE = 1024           # trigrams bundled at once, however many a text has
_KEPT = 60_000         # trigram vectors that a worker keeps (one bit per dimension)


@functools.lru_cache(maxsize=4096)
def letter_vector(code: int) -> np.ndarray:
    """The +1/-1 vector of a letter (all +1 for the blank)."""
    if code == 0:
        return np.ones(DIM, np.int8)
    seed = zlib.crc32(f"letter {code}".encode())
    return (np.random.Generator(np.random.PCG64(seed)).integers(0, 2, DIM) * 2 - 1).astype(np.int8)


def trigram_vector(key: int) -> np.ndarray:
    a, b, c = key // (_CODES * _CODES), key // _CODES % _CODES, key % _CODES
    return np.roll(letter_vector(a), 2) * np.roll(letter_vector(b), 1) * letter_vector(c)


class _Vectors:
    """A worker's trigram vectors, found by sorted key; a set bit is +1.  Rows stay
    where they were put first."""

    def __init__(self):
        self.keys, self.places = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.bits = np.zeros((0, DIM // 8), np.uint8)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Vectors of sorted distinct keys."""
        at = np.searchsorted(self.keys, keys)
        new = keys[self.keys.take(at, mode="clip") != keys] if len(self.keys) else keys
        if len(new):
            if len(self.keys) + len(new) > _KEPT:
                self.__init__()
                new = keys
            held = len(self.keys)
            if held + len(new) > len(self.bits):
                room = np.zeros((max(held + len(new), _KEPT), DIM // 8), np.uint8)
                room[:held] = self.bits[:held]
                self.bits = room
            for k, key in enumerate(new.tolist(), held):
                self.bits[k] = np.packbits(trigram_vector(key) > 0)
            place = np.searchsorted(self.keys, new)
            self.keys = np.insert(self.keys, place, new)
            self.places = np.insert(self.places, place, np.arange(held, held + len(new), dtype=np.int32))
            at = np.searchsorted(self.keys, keys)
        out = np.unpackbits(self.bits.take(self.places.take(at), axis=0), axis=1).view(np.int8)
        out += out
        out -= 1
        return out


_VECTORS = _Vectors()


def _fold() -> np.ndarray:
    """Code point -> lower-case letter, 0 for what is no letter."""
    out = np.zeros(_CODES, np.int64)
    for c in range(_CODES):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 and ord(low) < _CODES else c
    return out


_FOLD: list[np.ndarray] = []


def _high_letter(point: int) -> int:
    """Code of a letter above U+FFFF, 0 for what is no letter (emoji)."""
    ch = chr(point)
    low = ch.lower()
    return _UNUSED + ord(low if len(low) == 1 else ch) % _N_UNUSED if ch.isalpha() else 0


def letters(text: str | None) -> np.ndarray:
    """Lower-case letters as numbers with one 0 for each stretch between words."""
    if not _FOLD:
        _FOLD.append(_fold())
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = _FOLD[0].take(points, mode="clip")
    high = np.flatnonzero(points >= _CODES)
    if len(high):
        found, at = np.unique(points[high], return_inverse=True)
        codes[high] = np.array([_high_letter(c) for c in found.tolist()], np.int64)[at]
    codes = np.concatenate([[0], codes, [0]])
    keep = np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])
    return codes[keep]


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of a text (sorted keys) and their counts."""
    codes = letters(text)
    if not codes.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique((codes[:-2] * _CODES + codes[1:-1]) * _CODES + codes[2:], return_counts=True)


def _together(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of several texts (sorted keys) and their counts."""
    keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([c for _, c in found])).astype(np.int64)


def size_class(n_distinct: int) -> int:
    return min(int(n_distinct).bit_length() - 1, _CLASSES - 1)


def text_vector(text: str | None) -> np.ndarray | None:
    """Unit vector of a text, None if it has no letter."""
    return _bundle(*trigrams(text))


def _bundle(keys: np.ndarray, counts: np.ndarray) -> np.ndarray | None:
    if not len(keys):
        return None
    bundle = np.zeros(DIM)
    for i in range(0, len(keys), SLICE):
        # einsum: a plain loop, where a matrix library would start threads in every task
        bundle += np.einsum("i,ij->j", counts[i:i + SLICE].astype(np.float32),
                            _VECTORS.of(keys[i:i + SLICE]).astype(np.float32))
    length, bundle = float(np.sqrt((bundle ** 2).sum())), bundle.astype(np.float32)
    return bundle / np.float32(length) if length else bundle


@dataclass(frozen=True)
class Prototypes:
    languages: tuple
    vectors: np.ndarray     # unit rows around the mean
    mean: np.ndarray
    floors: tuple = tuple(next(NOISE * x for n, x in LEAST if 2 ** k >= n) for k in range(_CLASSES))   # least cosine by size class

    def cosines(self, text: str | None) -> tuple[np.ndarray | None, int]:
        """Cosine with each language (None without a letter) and the text's size class."""
        keys, counts = trigrams(text) if self.languages else ((), ())
        if not len(keys):
            return None, 0
        off = _bundle(keys, counts) - self.mean
        length = float(np.sqrt((off.astype(np.float64) ** 2).sum()))
        return (self.vectors @ off).astype(np.float64) / (length or 1.0), size_class(len(keys))

    def judge(self, text: str | None, reject: bool = False) -> tuple[str, float, float]:
        """(language, score, lead over the second); the score maps the cosine to 0..1.
        With ``reject`` a text below the floor of its class is undecided."""
        cosines, size = self.cosines(text)
        if cosines is None:
            return UNDECIDED, 0.0, 0.0
        best = int(np.argmax(cosines))
        if reject and cosines[best] < self.floors[size]:
            return UNDECIDED, 0.0, 0.0
        others = np.delete(cosines, best)
        lead = float(cosines[best] - others.max()) if len(others) else 1.0
        return self.languages[best], float(min(1.0, max(0.0, (cosines[best] + 1) / 2))), lead


def _training(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.filter(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string"), F.col(text_col).cast("string"))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Prototypes:
    """Prototypes from all rows with a language outside the held-out fold."""
    rows = _training(docs, id_col, text_col, lang_col)

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            held: dict = {}
            for part in in_parts([batch]):
                own: dict = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own.setdefault(lang, []).append(trigrams(text))
                for lang, found in own.items():
                    held.setdefault(lang, []).append(_together(found))
            for lang, found in held.items():
                keys, counts = _together(found)
                got = sums.setdefault(lang, np.zeros(DIM, np.int64))
                for i in range(0, len(keys), SLICE):
                    got += (counts[i:i + SLICE, None] * _VECTORS.of(keys[i:i + SLICE])).sum(axis=0)
        for lang, got in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * DIM, "k": pa.array(range(DIM), pa.int32()),
                                              "v": pa.array(got, pa.int64())})

    found = rows.mapInArrow(bundles, "lang string, k int, v long").groupBy("lang", "k").agg(F.sum("v").alias("v"))
    sums: dict = {}
    for lang, k, v in found.collect():
        sums.setdefault(lang, np.zeros(DIM))[k] = v
    languages = tuple(sorted(x for x in sums if sums[x].any()))
    if not languages:
        return Prototypes((), np.zeros((0, DIM), np.float32), np.zeros(DIM, np.float32))
    unit = np.array([sums[x] / np.sqrt((sums[x] ** 2).sum()) for x in languages])
    mean = unit.mean(axis=0) if len(languages) > 1 else np.zeros(DIM)
    off = unit - mean
    off /= np.maximum(np.sqrt((off ** 2).sum(axis=1, keepdims=True)), 1e-12)
    return Prototypes(languages, off.astype(np.float32), mean.astype(np.float32))


def calibrate(prototypes: Prototypes, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              lang_col: str = "lang") -> Prototypes:
    """``prototypes`` with floors from the cosines of all training rows with their own
    language; classes of fewer than ``CLASS_ROWS`` rows keep the floor they have."""
    shared = docs.sparkSession.sparkContext.broadcast(prototypes)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value, np.zeros((_CLASSES, _BINS + 1), np.int64)
        at = {lang: k for k, lang in enumerate(known.languages)}
        for batch in in_parts(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cosines, size = known.cosines(text)
                if cosines is not None and lang in at:
                    counts[size, int(max(0.0, min(1.0, cosines[at[lang]])) * _BINS)] += 1
        size, cell = counts.nonzero()
        yield pa.RecordBatch.from_pydict({"size": pa.array(size, pa.int32()), "bin": pa.array(cell, pa.int32()),
                                          "n": pa.array(counts[size, cell], pa.int64())})

    counts = np.zeros((_CLASSES, _BINS + 1), np.int64)
    found = _training(docs, id_col, text_col, lang_col).mapInArrow(tally, "size int, bin int, n long")
    for size, cell, n in found.groupBy("size", "bin").agg(F.sum("n")).collect():
        counts[size, cell] = n
    floors = list(prototypes.floors)
    for k, own in enumerate(counts):
        if own.sum() >= CLASS_ROWS:
            reached = int(np.argmax(own.cumsum() > SPARED * own.sum())) / _BINS
            floors[k] = max(floors[k], reached / 2)
    return replace(prototypes, floors=tuple(floors))


def identify(docs: DataFrame, prototypes: Prototypes, text_col: str = "text", reject: bool = False) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and lead (of the best cosine over the
    second); with ``reject`` texts below the floor of their class are ``und``."""
    names = ("lang_pred", "score", "lead")
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])
    at = [c.lower() for c in kept.columns].index(text_col.lower())
    shared = docs.sparkSession.sparkContext.broadcast(prototypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = functools.partial(shared.value.judge, reject=reject)
        for batch in in_parts(batches):
            lang, score, lead = zip(*map(judge, batch.column(at).cast(pa.string()).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(lead, pa.float64())],
                names=[*batch.schema.names, *names])

    schema = T.StructType(kept.schema.fields + [T.StructField("lang_pred", T.StringType()),
                                                T.StructField("score", T.DoubleType()),
                                                T.StructField("lead", T.DoubleType())])
    return kept.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, prototypes: Prototypes, text_col: str = "text") -> DataFrame:
    """``docs`` without the texts that are ``und`` or below the floor of their class."""
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    shared = docs.sparkSession.sparkContext.broadcast(prototypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = functools.partial(shared.value.judge, reject=True)
        for batch in in_parts(batches):
            texts = batch.column(at).cast(pa.string()).to_pylist()
            yield batch.filter(pa.array([judge(text)[0] != UNDECIDED for text in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
