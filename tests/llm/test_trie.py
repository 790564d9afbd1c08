"""Prefix trie against a dictionary of all prefixes."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from climark.llm import prefix_trie as pt
from climark.llm.queries import QUERIES
from tests.conftest import SF_SMALL

WORDS = re.compile("[^\x20\x09-\x0D]+")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = {}
    for c, t, role, text in sorted((r for r in rows if r[0] is not None),
                                   key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(np.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def brute(convs):
    """Nodes of {conv: [(role, text), ...]} by dictionaries of prefixes."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        own = (len(members[p]) - 1) * len(WORDS.findall(p[-1][1])) if p else 0
        saved[p] = own + sum(saved[k] for k in below)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p],
                   saved[p], hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def built(spark, rows, heads=True, **options):
    turns = pt.numbered(pt.hashed_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    if heads:
        parts = pt.with_shared_heads(turns)
    else:
        parts = turns.withColumnRenamed("place", "depth"), turns.select("conv").distinct()
    out = pt.prefix_trie(*parts, **options)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


def test_random_conversations(spark):
    rng = random.Random(8)
    rows = []
    for c in [*rng.sample(range(-60, 400), 150), 1000, 1001, 2019]:
        for t in range(rng.choice((1, 1, 2, 3, 5, 9))):
            rows.append((c, t, rng.choice(("user", "assistant", None)), rng.choice(("yes", "no  no", "", None, "a b c"))))
    rows += [(None, 1, "user", "of nobody")]
    rng.shuffle(rows)
    assert built(spark, rows) == brute(rebuilt(rows))


@pytest.mark.parametrize("shard_nodes", [300, 100_000])
def test_many_shards_chains_and_hot_heads(spark, shard_nodes):
    """A third of the turns in one conversation, a hot first turn, many copies, growing prefixes."""
    rows = [(7, t, "user", f"turn {t % 50}") for t in range(900)]
    rows += [(c, t, "user", ("hello there", f"{c % 9} of nine", f"{c}")[t]) for c in range(100, 300) for t in range(3)]
    rows += [(c, t, "user", f"copy {t}") for c in range(300, 420) for t in range(4)]
    rows += [(500 + k, t, "user", f"step {t}") for k in range(30) for t in range(k + 1)]
    rows += [(700, t, "user", f"turn {t % 50}") for t in range(850)] + [(700, 900, "user", "another end")]
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((role, text))
    random.Random(1).shuffle(rows)
    assert built(spark, rows, heads=False, shard_nodes=shard_nodes) == brute(convs)


def test_turnless_conversations_and_absent_bases(spark):
    short = [c for c in range(1, 200) if zlib.crc32(str(c).encode()) % 4 == 3][:14]
    rows = [(c, None, "user", "gone") for c in short] + [(c, 5, "user", "gone too") for c in short[:2]]
    rows += [(short[-1] - short[-1] % 20, 1, "user", "base")]
    got = built(spark, rows)
    assert got == brute(rebuilt(rows))
    assert any(r[1] == 0 and r[7] != pt.EMPTY for r in got)


def test_null_turns_come_first_and_repeats_stay(spark):
    rows = [(40, None, "user", "first"), (40, 1, "user", "second"), (40, 1, "user", "second"), (40, -5, None, None)]
    want = {40: [("user", "first"), ("", ""), ("user", "second"), ("user", "second")]}
    assert built(spark, rows, heads=False) == brute(want)


def test_empty_table(spark):
    assert built(spark, []) == []


def test_long_text_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, 1, "user", "word " * 400_000, 3, "x"), (2, 1, "user", "word " * 400_000, 4, "y")],
                               "conv_id long, turn long, role string, text string, depth int, `a` string")
    turns = pt.numbered(pt.hashed_turns(df)).withColumnRenamed("place", "depth")
    rows = {r.depth: r for r in pt.prefix_trie(turns, turns.select("conv").distinct()).collect()}
    assert rows[1].saved_tokens == 400_000 and rows[0].saved_tokens == 400_000 and rows[1].n_convs == 2


def test_slot_table_is_minimal_and_verified():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 50_000):
        x, y = rng.integers(0, 2 ** 63, (2, n)).astype(np.uint64)
        table = pt.SlotTable(x, y)
        assert sorted(table.slots(x, y).tolist()) == list(range(n))
        assert (table.slots(x + np.uint64(1), y) == -1).all()
    with pytest.raises(ValueError):
        pt.SlotTable(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


def test_equal_digests_of_different_prefixes_are_noticed(spark, monkeypatch):
    """With the hash of a turn cut to one value, seed 0 clashes; a further seed is taken."""
    turns = pt.hashed_turns(spark.createDataFrame([(1, 1, "user", "a"), (2, 1, "user", "b")],
                                                  "conv_id long, turn long, role string, text string"))
    turns = pt.numbered(turns).withColumnRenamed("place", "depth")
    clash = pt.prefixes(turns.withColumn("a", pt.F.lit(1).cast("long")).withColumn("b", pt.F.lit(1).cast("long")))
    assert not pt._verified(pt.nodes_of(clash)) and pt._verified(pt.nodes_of(pt.prefixes(turns)))
    assert clash.columns == ["conv", "depth", "x", "y", "px", "py", "check", "words", "ends"]


def test_query_on_the_table(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    out = QUERIES["op12_prefix_trie"](spark, SF_SMALL)
    assert out.columns == COLUMNS and sorted(tuple(r) for r in out.collect()) == brute(rebuilt(rows))
