"""Token encoder, range coder, token files, packing and token counts."""

import functools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from climark.llm import bin_completion, range_coder, token_counts
from climark.llm.pack_sequences import pack_documents
from climark.llm.token_files import read_token_files, write_token_files
from climark.llm.vocab_encode import encoder
from climark.session import scratch_path
from tests.conftest import SF_SMALL
from tests.llm import brute

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [(None, None), (None, "a b"), (3, ""), (3, ""), (1, "x y " * 4000), (7, "<|endoftext|> 中🙂 Ⅷ's\x85\xa0é"),
       (8, "a <|endoftext|> b<|endoftext|>"), (9, "<|EndOfText|> <|startoftext|>x <|endoftext")]


@functools.cache
def tokenizer(path):
    return Tokenizer.from_file(path)


def whole(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False)


def rows(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    return table + ODD


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_by_memo_equal_whole_texts(path):
    rnd, enc = random.Random(1), encoder(path)
    letters = "aZ é'sStTrevml0²9 \n\t\r.,!'\"–€Œßµª½ \xa0 Ǆ中🙂½<|>\x1c\x85"
    marks = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]
    assert marks
    for k in range(1500):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40)))
        if k % 5 == 0:
            mark = rnd.choice(marks)
            text = text[:9] + rnd.choice((mark, mark.upper(), mark[:-1], mark + " " + mark)) + text[9:]
        got = whole(path, text)
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == got.ids, repr(text)
        assert enc.spans(text).tolist() == [list(o) for o in got.offsets], repr(text)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_columns_of_texts_equal_whole_texts(path, monkeypatch):
    import pyarrow as pa
    from climark.llm import vocab_encode
    rnd, enc = random.Random(4), vocab_encode.Encoder(path)
    monkeypatch.setattr(vocab_encode, "SLICE_BYTES", 500)
    letters = "ab é's1.,  \n\r\t "
    texts = [None, "", " ", "  ", "a ", " a", "a \n", "\n a", "a\n ", "a  b", "a   b", " \n b", "a\u0085 b", "中 a", "a\x1c b",
             "x <|endoftext|> y", "it's 's", "z" * 2000]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    for column in (pa.array(texts), pa.array(["cut", *texts]).slice(1), pa.array(texts[:1], pa.string()), pa.array([], pa.string())):
        got = enc.encode_all(column)
        assert len(got) == len(column)
        for text, ids in zip(column.to_pylist(), got):
            assert np.frombuffer(ids, "<u4").tolist() == whole(path, text).ids, repr(text)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_texts_are_encoded_slice_by_slice_and_words_let_go_after_a_task(path, monkeypatch):
    import pyarrow as pa
    from climark.llm import vocab_encode
    monkeypatch.setattr(vocab_encode, "_ENCODERS", {})
    monkeypatch.setattr(vocab_encode, "SLICE_BYTES", 400)
    enc = vocab_encode.encoder(path)
    texts = pa.array([f"word{chr(97 + k % 26)}{chr(97 + k // 26)} of text {k}" for k in range(600)])
    each = enc.encode_each(texts)
    first, met = next(each), len(enc.memo)
    assert met < 100                                 # only the first slice's words yet
    assert [first, *each] == enc.encode_all(texts) and len(enc.memo) > 600
    held = []

    def run(own, batches):
        for batch in batches:
            yield own.encode_all(batch) + [own.spans("a b")]
            held.append(len(own.memo))

    assert vocab_encode.with_encoder(path, run)([texts]) is not None and held == []
    assert len(list(vocab_encode.with_encoder(path, run)([texts]))) == 1
    assert held[0] > 600 and not enc.memo and not enc.memo._old and not enc.span_memo


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 65535)), max_size=2500))
def test_range_coder_round_trip(ids):
    assert range_coder.decode_blocks(range_coder.encode_blocks(np.array(ids, np.int64))).tolist() == ids


def test_quotients_in_doubles_are_exact():
    rng = np.random.default_rng(5)
    b = rng.integers(1, 1 << rng.integers(1, 40, 20000))
    q = rng.integers(0, (1 << 48) // b)
    for rest in (0, 1, -1):
        a = np.maximum(q * b + rest, 0)
        assert (range_coder._over(a, b) == a // b).all()


def test_streams_with_carries_and_rare_ids():
    """Ids of wide ranges take two words each and low registers overflow into words before."""
    rng = np.random.default_rng(6)
    for ids in (rng.integers(0, 65536, 40_000), np.tile([0, 65535, 0, 65535, 65535], 3000),
                np.where(rng.random(30_000) < .9, 7, rng.integers(0, 65536, 30_000))):
        assert (range_coder.decode_blocks(range_coder.encode_blocks(ids)) == ids).all()


def test_blocks_are_independent_and_checked():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.zipf(1.3, 5000), 65535)
    blocks = range_coder.encode_blocks(ids)
    assert len(blocks) == 5 and sum(map(len, blocks)) < 2 * len(ids)
    assert range_coder.decode_blocks([blocks[3], blocks[0]]).tolist() == [*ids[3072:4096], *ids[:1024]]
    for at in (2, 9, range_coder.HEAD.size + 3, len(blocks[1]) - 1):
        bad = bytearray(blocks[1])
        bad[at] ^= 0x55
        with pytest.raises(ValueError):
            range_coder.decode_blocks([bytes(bad), blocks[0]])
            if at == len(blocks[1]) - 1:
                raise ValueError("the last bits may be unused")
    with pytest.raises(ValueError):
        range_coder.encode_blocks(np.array([65536]))


def test_token_files_round_trip(spark):
    table = rows(spark)
    path = scratch_path(spark, "token-files-test")
    write_token_files(spark.createDataFrame(table, "doc_id long, text string").repartition(3), path, BYTES)
    got = sorted(map(tuple, read_token_files(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((d for d, _ in table), key=lambda d: (d is not None, d or 0))
    start, want = 0, Counter()
    for _, at, n, _ in got:
        assert at == start
        start += n
    for doc, text in table:
        ids = whole(BYTES, text).ids + [0]
        want[doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((d, n, c) for d, _, n, c in got) == want
    path = scratch_path(spark, "token-files-test")
    write_token_files(spark.createDataFrame([], "doc_id long, text string"), path, BYTES)
    assert read_token_files(spark, path).count() == 0


def test_bin_completion_against_all_packings():
    rnd = random.Random(3)

    def fewest(items, space):
        best = [len(items)]

        def go(i, bins):
            if len(bins) >= best[0]:
                return
            if i == len(items):
                best[0] = len(bins)
                return
            for free in sorted(set(bins)):
                if free >= items[i]:
                    rest = list(bins)
                    rest.remove(free)
                    go(i + 1, rest + [free - items[i]])
            go(i + 1, bins + [space - items[i]])
        go(0, [])
        return best[0]

    for _ in range(150):
        space = rnd.choice([10, 20, 50, 100])
        items = sorted((rnd.randint(1, space) if rnd.random() < .3 else rnd.randint(space // 5, space // 2)
                        for _ in range(rnd.randint(0, 9))), reverse=True)
        packed = bin_completion.pack(Counter(items), space)
        assert all(sum(p) <= space for p, _ in packed)
        assert Counter(n for p, b in packed for n in p for _ in range(b)) == Counter(items)
        assert sum(b for _, b in packed) <= fewest(items, space) + 1
        assert sum(b for _, b in packed) <= sum(b for _, b in bin_completion.best_fit(Counter(items), space))
    with pytest.raises(ValueError):
        bin_completion.pack({11: 1}, 10)


def test_packing_places_every_piece(spark):
    table = rows(spark)
    got = pack_documents(spark.createDataFrame(table, "doc_id long, text string").repartition(4), WORDS).collect()
    want = []
    for doc, text in table:
        ids = whole(WORDS, text).ids + [0]
        want += [(doc, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(np.array(ids[k:k + 2048], "<u4").tobytes()))
                 for k in range(0, len(ids), 2048)]
    assert sorted((tuple(r)[:5] for r in got), key=brute.key) == sorted(want, key=brute.key)
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= 1.02 * sum(w[3] for w in want) / 2048 + 1
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), WORDS).count() == 0


def plain(spans, ends, rule):
    tokens, crossing, begins = [0.0] * len(ends), [0] * len(ends), [0, *ends[:-1]]
    for a, z in spans:
        share = [max(0, min(z, e) - max(a, b)) for b, e in zip(begins, ends)]
        k = [i for i, v in enumerate(share) if v]
        for i in k if len(k) > 1 else []:
            crossing[i] += 1
        if rule == "split":
            for i in k:
                tokens[i] += share[i] / sum(share)
        elif k:
            tokens[{"first": k[0], "last": k[-1], "most": max(k, key=lambda i: (share[i], -i))}[rule]] += 1
    return tokens, crossing


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_attribution_matches_brute_force(rule):
    rnd = random.Random(2)
    for _ in range(200):
        cuts = sorted({0, 30, *(rnd.randint(0, 30) for _ in range(9))})
        spans = np.array(list(zip(cuts, cuts[1:])))
        ends = np.array(sorted([30, *(rnd.randint(0, 30) for _ in range(4))]))
        got, crossing = token_counts.attribute(spans, ends, rule)
        want, over = plain(spans.tolist(), ends.tolist(), rule)
        assert np.allclose(got, want) and crossing.tolist() == over


def test_section_counts_add_up(spark):
    table = rows(spark)
    df = spark.createDataFrame(table, "doc_id long, text string")
    got = token_counts.section_counts(df, BYTES).groupBy("doc_id").sum("n_tokens").collect()
    want: dict = {}
    for doc, text in table:
        want[doc] = want.get(doc, 0) + len(whole(BYTES, text).ids)
    assert {r[0]: r[1] for r in got} == want
    fields = spark.createDataFrame([(1, "web", None, "a\nb"), (2, "", "en", "")], "doc_id long, source string, lang string, text string")
    got = sorted(map(tuple, token_counts.section_counts(fields, BYTES, ["source", "lang", "text"]).collect()))
    assert [r[:2] for r in got] == [(d, k) for d in (1, 2) for k in range(3)]
    assert sum(r[4] for r in got if r[0] == 1) == len(whole(BYTES, "web\n\na\nb\n").ids)
    with pytest.raises(ValueError):
        token_counts.section_counts(fields, BYTES, rule="none")
