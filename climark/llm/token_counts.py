"""Token counts of sections from one encoding of the whole document.

A document is encoded once, whole; every token keeps the characters it covers.
Sections are stretches of characters: the lines of a text, or the fields of a
record written one after another.  Tokens and sections, both in order, are
joined by interval, and a token that reaches over a boundary is allocated by
``rule``:

* ``most``: to the section with most of its characters, the earlier one on a tie;
* ``first`` / ``last``: to the section of its first / last character;
* ``split``: to every section it touches, by share of characters.

Under every rule the tokens of a document's sections add up to its tokens.

Defined results for odd input: a null text (or null fields) counts as empty; a
document without characters has one section, 0, of no characters and no
tokens; an empty field is a section without tokens; repeated rows are counted
each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climark.llm.vocab_encode import Encoder, with_encoder

RULES = ("most", "first", "last", "split")
ROW = "doc_id long, section int, start long, end long, n_tokens double, n_crossing long"


def line_ends(text: str) -> np.ndarray:
    """Ends of the lines of a text, each with its line break."""
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return np.array(ends, np.int64)


def attribute(spans: np.ndarray, ends: np.ndarray, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) of each section.  ``spans`` are the tokens'
    (first character, end); sections are consecutive, ending at ``ends``.  A
    token without characters belongs to the section of its place."""
    tokens, crossing = np.zeros(len(ends)), np.zeros(len(ends), np.int64)
    if not len(spans):
        return tokens, crossing
    start, stop = spans[:, 0], np.maximum(spans[:, 1], spans[:, 0] + 1)
    last_section = len(ends) - 1
    first = np.minimum(np.searchsorted(ends, start, side="right"), last_section)
    last = np.minimum(np.searchsorted(ends, stop - 1, side="right"), last_section)
    over = np.flatnonzero(last > first)
    goes = last if rule == "last" else first.copy()
    alone = np.ones(len(spans), bool)
    for k in over.tolist():
        sections = np.arange(first[k], last[k] + 1)
        share = np.minimum(ends[sections], stop[k]) - np.maximum(np.where(sections, ends[sections - 1], 0), start[k])
        crossing[sections[share > 0]] += 1
        if rule == "most":
            goes[k] = sections[int(np.argmax(share))]
        elif rule == "split":
            alone[k] = False
            tokens[sections] += share / share.sum()
    tokens += np.bincount(goes[alone], minlength=len(ends))
    return tokens, crossing


def section_counts(docs: DataFrame, tokenizer: str, fields: list[str] | None = None, separator: str = "\n",
                   rule: str = "most", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per section of each document: doc_id, section (from 0), start, end
    (characters), n_tokens, n_crossing (tokens that also reach into another
    section).  Without ``fields`` sections are the lines of ``text_col``; with
    them a document is its fields, each followed by ``separator``, and section k
    is field k."""
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")

    def run(enc: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for doc_id, *values in zip(*(c.to_pylist() for c in batch.columns)):
                parts = [(v or "") + separator for v in values] if fields else [values[0] or ""]
                text = "".join(parts)
                ends = np.cumsum([len(p) for p in parts]) if fields else line_ends(text)
                tokens, crossing = attribute(enc.spans(text), ends, rule)
                n = len(ends)
                for column, value in zip(out, ([doc_id] * n, range(n), [0, *ends[:-1].tolist()], ends.tolist(),
                                               tokens.tolist(), crossing.tolist())):
                    column.extend(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=[
                "doc_id", "section", "start", "end", "n_tokens", "n_crossing"])

    columns = [F.col(c).cast("string").alias(f"_f{k}") for k, c in enumerate(fields or [text_col])]
    return docs.select(F.col(id_col).cast("long").alias("_id"), *columns).mapInArrow(
        with_encoder(tokenizer, run), ROW)
