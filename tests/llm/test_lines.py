"""Line dedup against a brute-force version."""

import hashlib
import random
from collections import defaultdict

from climark.llm import line_dedup
from climark.llm.line_dedup import deduplicate_lines
from climark.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SPACE = " \t\n\x0b\x0c\r"
LONG = "The same footer line, in every one of them"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_docs=3, min_chars=20):
    """(id, n_lines, n_dropped, kept text) by sets and dictionaries."""
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key_of(line)].add((doc is not None, doc or 0))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key_of(x)) < min_chars or len(holders[key_of(x)]) < min_docs
                or max(holders[key_of(x)]) == (doc is not None, doc or 0)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def same(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_text or "") for r in deduplicate_lines(df, **options).collect()]
    order = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(got, key=order) == sorted(brute(rows), key=order)
    return {r[0]: r for r in got}


def test_lines_of_odd_documents(spark):
    rows = [(None, None), (None, LONG), (1, ""), (2, None), (3, f"own words\n{LONG}\r\n\n"), (4, f"  {LONG.upper()}\x0b\nx"),
            (5, LONG), (5, LONG), (6, f"{LONG}\n{LONG}\n{LONG}"), (7, "é" * 20), (8, "é" * 20), (9, "\xa0" + "é" * 20),
            (10, "é" * 20 + "\n"), (11, "É" * 20), (12, "É" * 19), (13, "É" * 19), (14, "É" * 19), (15, "\n\n\n"),
            (16, "only in two documents, so it stays"), (17, "Only in two documents, so it stays"),
            (18, "twice in each document, two ids\n" * 2), (18, "twice in each document, two ids"),
            (19, "twice in each document, two ids")]
    got = same(spark, rows)
    assert got[5][2:] == (1, "") and got[4][2:] == (1, "x") and got[6][2] == 0 and got[10][2] == 0
    assert got[18][2] == 0 and got[12][2] == 0


def test_random_lines_by_both_joins(spark, monkeypatch):
    rng = random.Random(5)
    pool = [f"line number {k} of the common pool" for k in range(60)]
    rows = [(d, "\n".join(rng.choice(pool) if rng.random() < .4 else f"{rng.random()} is a line of its own"
                          for _ in range(rng.randrange(12)))) for d in range(300)]
    rows += [(d, "The hot line that a third of them hold\n" + str(d)) for d in range(300, 450)]
    same(spark, rows)
    same(spark, rows, broadcast_keys=5)


def test_very_long_text_and_blocks(spark, monkeypatch):
    text = "\n".join(f"line {k % 70_000} of a very long document" for k in range(140_000))
    rows = [(1, text), (2, text), (3, text), (4, "word " * 300_000)]
    got = same(spark, rows)
    assert got[1][2] == 140_000 and got[3][2] == 0 and got[4][2] == 0


def test_empty_table_and_clashing_columns(spark):
    assert deduplicate_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(k, LONG, 5, k * 2, "a") for k in range(3)],
                               "doc_id long, text string, N_LINES int, pos int, `row.x` string")
    rows = {r.doc_id: r for r in deduplicate_lines(df).collect()}
    assert [c.lower() for c in rows[0].asDict()] == ["doc_id", "text", "pos", "row.x", "n_lines", "n_dropped", "kept_text"]
    assert rows[2].kept_text == LONG and rows[1].kept_text == "" and rows[1].pos == 2 and rows[1]["row.x"] == "a"


def test_query_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = {(d, n, x, hashlib.sha256(t.encode()).hexdigest()) for d, n, x, t in brute(docs)}
    out = QUERIES["op13_line_dedup"](spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert {tuple(r) for r in out.collect()} == want
    assert line_dedup.MIN_DOCS == 3
