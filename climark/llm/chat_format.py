"""Chat formatting: roles of transcript lines by a hidden Markov model.

A transcript is plain text.  Each line is the first of a turn or a later one,
of a speaker role, which gives two states per role; what is seen of a line is its
speaker marker (``User:``, ``AI:``, ``Q:``, an unknown name, or none), whether
the line before is blank, its length and whether it asks.  The model's tables are
counted from transcripts of known roles (add-one smoothing), Viterbi finds the
likeliest states, and the turns are rendered canonically:
``<|role|>`` + line break + text + ``<|end|>``, one after another.  Only a line that
begins a turn loses its marker, and only one of the turn's own role; all other
lines, and blank lines within a turn, stay as they are.  Blank lines at the ends
of a turn are separators.

Counting is one aggregation to tables of bounded size; parsing is one pass, row
by row.

Defined results for odd input: a null or blank transcript has no turns and
renders empty; a transcript of unknown markers still gets roles from the rest
of what is seen; equal paths go to the state first in ``STATES``; repeated
transcripts are parsed each; further columns are passed through, result columns
replace input columns of the same name.  ``transcripts_of`` takes a turn that
the table repeats word for word once, puts a null turn number first, drops rows
without a conversation, and cuts conversations into parts of ``PART_TURNS`` turns
so that no conversation is one unbounded row.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROLES = ("system", "user", "assistant")
STATES = [(role, begins) for role in ROLES for begins in (True, False)]
PART_TURNS = 512
_MARKERS = {
    "system": "system instructions context setup".split(),
    "user": "user human q question customer me".split(),
    "assistant": "assistant ai bot a answer agent model".split(),
}
_KNOWN = {name: role for role, names in _MARKERS.items() for name in names}
_MARKER = re.compile(r"^\s*(?:\*\*|\[|<\|?|#+\s*)?([A-Za-z][A-Za-z ]{0,18}?)(?:\*\*|\]|\|?>)?\s*(?::|>|-{1,2}(?=\s))(?:\*\*)?[ \t]?")
KINDS = ("none", "system", "user", "assistant", "name")
SEEN = (len(KINDS), 2, 4, 2)          # marker, blank line before, length, question

#: Marker styles in which ``transcripts_of`` writes labelled conversations.
STYLES = [
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "Instructions: ", "user": "Human: ", "assistant": "AI: "},
    {"system": "Context: ", "user": "Q: ", "assistant": "A: "},
    {"system": "[System]: ", "user": "[Customer]: ", "assistant": "[Agent]: "},
    {"system": "**Setup:** ", "user": "**Me:** ", "assistant": "**Bot:** "},
]
MARKER_LOST_PERCENT = 10              # of turns that are written without their marker


def split_marker(line: str) -> tuple[str, str]:
    """(kind, line without its speaker marker)."""
    found = _MARKER.match(line)
    if not found:
        return "none", line
    role = _KNOWN.get(found[1].strip().lower())
    return (role, line[found.end():]) if role else ("name", line)


def observations(text: str | None) -> tuple[list[tuple[list[str], str]], np.ndarray]:
    """Lines with a character that is no space, each behind the blank lines before
    it, and what is seen of each."""
    kept, seen, blank = [], [], []
    for line in (text or "").split("\n"):
        if not line.strip():
            blank.append(line)
            continue
        kind, rest = split_marker(line)
        n = len(rest.split())
        seen.append((KINDS.index(kind), int(bool(blank) or not kept), (n > 4) + (n > 12) + (n > 40),
                     int(rest.rstrip()[-1:] == "?")))
        kept.append((blank, line))
        blank = []
    return kept, np.array(seen, np.int64).reshape(-1, len(SEEN))


class Model:
    """Log probabilities of starts, moves and what is seen, by state."""

    def __init__(self, start: np.ndarray, move: np.ndarray, seen: list[np.ndarray]):
        def log(counts):
            counts = counts + 1.0
            return np.log(counts / counts.sum(axis=-1, keepdims=True))
        self.start, self.move, self.seen = log(start), log(move), [log(s) for s in seen]
        inside = [k for k, (_, begins) in enumerate(STATES) if not begins]
        self.start[inside] = -np.inf                                    # a transcript begins with a turn
        for k, (role, _) in enumerate(STATES):
            for j, (other, begins) in enumerate(STATES):
                if not begins and other != role:
                    self.move[k, j] = -np.inf                           # a later line keeps the role

    def emissions(self, seen: np.ndarray) -> np.ndarray:
        return sum(table[:, seen[:, k]] for k, table in enumerate(self.seen)).T

    def viterbi(self, seen: np.ndarray) -> list[int]:
        if not len(seen):
            return []
        emitted = self.emissions(seen)
        best, back = self.start + emitted[0], []
        for row in emitted[1:]:
            paths = best[:, None] + self.move
            back.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + row
        out = [int(best.argmax())]
        for pointers in reversed(back):
            out.append(int(pointers[out[-1]]))
        return out[::-1]


def turns(text: str | None, model: Model) -> list[tuple[str, str]]:
    """(role, text) of the turns of a transcript."""
    lines, seen = observations(text)
    out: list[tuple[str, list[str]]] = []
    for (blank, line), state in zip(lines, model.viterbi(seen)):
        role, begins = STATES[state]
        if begins or not out:
            kind, rest = split_marker(line)
            out.append((role, [rest if kind == role else line]))
        else:
            out[-1][1].extend([*blank, line])
    return [(role, "\n".join(own)) for role, own in out]


def render(parsed: list[tuple[str, str]]) -> str:
    return "".join(f"<|{role}|>\n{text}<|end|>\n" for role, text in parsed)


def within(lines: list[str]) -> list[str]:
    """``lines`` without the blank ones at both ends."""
    full = [k for k, line in enumerate(lines) if line.strip()]
    return lines[full[0]:full[-1] + 1] if full else []


def transcripts_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, transcript, states): conversations written as plain text
    in one of ``STYLES``, some markers lost; states are the true ones by line."""
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / PART_TURNS).cast("long").alias("part"),
        F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                 F.col("text").cast("string").alias("text")).alias("t")).distinct()
    grouped = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, states = [], []
            for conv, own in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                style, lines, truth = STYLES[zlib.crc32(str(conv).encode()) % len(STYLES)], [], []
                for k, t in enumerate(own):
                    role = t["role"] if t["role"] in ROLES else "user"
                    lost = k and zlib.crc32(f"{conv}/{t['turn']}".encode()) % 100 < MARKER_LOST_PERCENT
                    begins = True
                    for line in within((t["text"] or "").split("\n")):
                        lines.append((style[role] if begins and not lost else "") + line)
                        if line.strip():
                            truth.append(STATES.index((role, begins)))
                        begins = False
                    lines.append("")
                texts.append("\n".join(lines))
                states.append(truth)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(states, pa.list_(pa.int32()))],
                names=["conv_id", "part", "transcript", "states"])

    return grouped.mapInArrow(write, "conv_id long, part long, transcript string, states array<int>")


def learn(transcripts: DataFrame) -> Model:
    """Count the model's tables on transcripts with known states."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for batch in batches:
            for text, states in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _, seen = observations(text)
                if len(seen) != len(states or []):
                    continue
                for i, s in enumerate(states):
                    keys = [("start", s, 0)] if i == 0 else [("move", states[i - 1], s)]
                    for key in keys + [(f"seen{k}", s, int(v)) for k, v in enumerate(seen[i])]:
                        found[key] = found.get(key, 0) + 1
        if found:
            name, a, b = zip(*found)
            yield pa.RecordBatch.from_pydict({"name": list(name), "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()),
                                              "n": pa.array(list(found.values()), pa.int64())})

    counts = transcripts.select("transcript", "states").mapInArrow(count, "name string, a int, b int, n long")
    n = len(STATES)
    tables = {"start": np.zeros((n, 1)), "move": np.zeros((n, n)), **{f"seen{k}": np.zeros((n, m)) for k, m in enumerate(SEEN)}}
    for name, a, b, c in counts.groupBy("name", "a", "b").agg(F.sum("n")).collect():
        tables[name][a, b] = c
    return Model(tables["start"][:, 0], tables["move"], [tables[f"seen{k}"] for k in range(len(SEEN))])


def format_chats(transcripts: DataFrame, model: Model, text_col: str = "transcript") -> DataFrame:
    """``transcripts`` with n_turns (long), roles (comma-joined) and chat (the canonical text)."""
    names = ("n_turns", "roles", "chat")
    kept = transcripts.select(*[F.col(f"`{c}`") for c in transcripts.columns if c.lower() not in names])
    at = kept.columns.index(text_col)
    shared = transcripts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [turns(t, shared.value) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(p) for p in parsed], pa.int64()),
                 pa.array([",".join(r for r, _ in p) for p in parsed], pa.string()),
                 pa.array([render(p) for p in parsed], pa.string())], names=[*batch.schema.names, *names])

    return kept.mapInArrow(run, T.StructType(kept.schema.fields + [
        T.StructField("n_turns", T.LongType()), T.StructField("roles", T.StringType()), T.StructField("chat", T.StringType())]))
