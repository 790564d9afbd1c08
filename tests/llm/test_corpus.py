"""Decontamination, Jaccard join, language ID, quality model, chats, pipeline."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from climark.llm import chat_format, common, decontaminate, language_id, ngram_jaccard, quality_model, queries
from climark.llm.common import held_out
from climark.llm.components import components
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import brute

DOC = "doc_id long, text string"


def table(spark, name, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@pytest.mark.parametrize("windows", [500_000, 60])
def test_decontamination_matches_brute_force(spark, windows):
    docs = table(spark, "documents").select("doc_id", "text").union(spark.createDataFrame(
        [(5000, None), (5001, ""), (5002, "The cat SAT Éa the cat sat"), (5002, "The cat SAT Éa the cat sat"),
         (None, "zz top 9")], DOC))
    items = table(spark, "benchmark").select("item_id", "text").union(spark.createDataFrame(
        [(900, "cat sat"), (901, None), (902, "..."), (903, "Cat Sat!"), (1000, "top")], "item_id long, text string"))
    got = decontaminate.find_hits(docs, items, slice_windows=windows).drop("spans").collect()
    want = brute.hits([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert sorted(map(tuple, got), key=brute.key) == sorted(want, key=brute.key)


def test_decontamination_modes_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a the cat, sat on", "x"), (2, None, "y"), (3, "clean", "z")], DOC + ", n_hit string")
    items = spark.createDataFrame([(1, "The Cat Sat")], "item_id long, text string")
    assert sorted(decontaminate.clean(docs, items).collect()) == [(2, None, "y"), (3, "clean", "z")]
    assert [r.text for r in decontaminate.clean(docs, items, "spans").orderBy("doc_id").collect()] == ["a  on", None, "clean"]
    assert decontaminate.clean(docs.limit(0), items).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == 3
    assert decontaminate.find_hits(docs, items.limit(0)).where("contaminated").count() == 0


def test_decontamination_by_slices_equals_one_slice(spark):
    rnd = random.Random(5)
    texts = [" ".join(f"w{rnd.randrange(40)}" for _ in range(60)) for _ in range(12)]
    items = spark.createDataFrame([(k, " ".join(t.split()[5:22])) for k, t in enumerate(texts)] + [(None, "w1 w2")],
                                  "item_id long, text string")
    cut = " ".join(texts[0].split()[:10] + texts[1].split()[5:18] + texts[0].split()[10:20])   # cutting makes new neighbours
    docs = spark.createDataFrame([(k, t, k) for k, t in enumerate([*texts, cut, cut, "w1 w2", None, "", "zz"])],
                                 DOC + ", _found long")
    for mode in ("documents", "spans"):
        whole = sorted(decontaminate.clean(docs, items, mode).collect(), key=str)
        assert sorted(decontaminate.clean(docs, items, mode, slice_windows=7).collect(), key=str) == whole
    hits = {r.doc_id: r for r in decontaminate.find_hits(docs, items, slice_windows=7).collect()}
    assert hits[14].contaminated and hits[14].n_items == 0       # found through the item without an id
    assert sorted(hits.values(), key=str) == sorted(decontaminate.find_hits(docs, items).collect(), key=str)
    assert [len(s) > 0 for s in decontaminate.item_slices(items.limit(0), 10, "item_id", "text")] == [False]


def near_copies(seed):
    rnd, words = random.Random(seed), [f"w{k}" for k in range(60)]
    rows = [(None, None), (None, "a b"), (7, ""), (7, "a b"), (8, "A  B"), (9, " . ")]
    for _ in range(30):
        base = [rnd.choice(words) for _ in range(rnd.choice([6, 9, 12, 20, 30, 60, 150]))]
        for _ in range(rnd.choice([1, 2, 6, 14])):
            own = list(base)
            for _ in range(rnd.randint(0, max(1, len(own) // 25))):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            rows.append((100 + len(rows), " ".join(own + [rnd.choice(words) for _ in range(rnd.randint(0, 3))])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [ngram_jaccard.HOT, 3])
def test_jaccard_components_match_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(ngram_jaccard, "HOT", hot)
    rows = near_copies(5)
    got = ngram_jaccard.jaccard_components(spark.createDataFrame(rows, DOC).repartition(3)).select(
        "doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=brute.key) == sorted(brute.components(rows), key=brute.key)


def test_jaccard_on_the_tables(spark):
    rows = [tuple(r) for r in table(spark, "documents").select("doc_id", "text").collect()]
    got = queries.op3_ngram_jaccard_join(spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(brute.components(rows))


def test_one_of_each_group_stays(spark):
    same = "a b c d e f g"
    docs = spark.createDataFrame(
        [(7, same, "x"), (7, same, "x"), (7, "other text here", "z"), (3, "other text here", "q"), (None, same, "n"),
         (None, "lone null one", "n"), (None, "lone null one", "n"), (9, None, "e"), (9, "", "e")], DOC + ", _gone_id string")
    got = ngram_jaccard.first_of_groups(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=brute.key) == sorted(
        [(3, "other text here", "q"), (7, same, "x"), (None, "lone null one", "n"), (9, None, "e"), (9, "", "e")], key=brute.key)
    assert ngram_jaccard.first_of_groups(docs.limit(0)).count() == 0


def test_places_never_rule_out_a_link():
    rnd = random.Random(9)
    linked = dropped = 0
    for _ in range(3000):
        base = rnd.sample(range(400), rnd.randint(3, 60))
        other = rnd.sample(base, rnd.randint(max(1, len(base) - 12), len(base))) + rnd.sample(range(400, 500), rnd.randint(0, 6))
        a, b = sorted(base), sorted(set(other))
        if len(b) < 3:
            continue
        n, m, both = len(a), len(b), len(set(a) & set(b))
        x, y = (len(s) - ngram_jaccard._keep(len(s)) + 2 for s in (a, b))      # prefixes by the common order
        common = sorted(set(a[:x]) & set(b[:y]))
        need = -(-75 * (n + m) // 175)
        ways = [(a.index(k), b.index(k)) for k in common[:1] if a.index(k) < x - 1 and b.index(k) < y - 1]
        ways += [(a.index(k) - 1, b.index(k) - 1) for k in common[1:2]]
        fit = [i <= n - need and j <= m - need for i, j in ways]
        alive = [ngram_jaccard._partners(np.zeros(2, np.int64), *np.array(sorted([(n, i), (m, j)])).T).any() for i, j in ways]
        if 100 * both >= 75 * (n + m - both):
            linked += 1
            assert len(ways) == 2 and all(fit) and all(alive)
        dropped += len(fit) - sum(fit)
    assert linked > 300 and dropped > 300


def test_signatures_never_rule_out_a_link():
    rng = np.random.default_rng(1)
    for n in (3, 8, 64, 65, 500):
        for _ in range(30):
            base = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            drop = rng.integers(0, len(base) // 7 + 1)
            other = np.unique(np.concatenate([base[drop:], rng.integers(0, 1 << 63, rng.integers(0, n // 7 + 1)).astype(np.uint64)]))
            both = len(np.intersect1d(base, other))
            links = 100 * both >= 75 * (len(base) + len(other) - both)
            say = ngram_jaccard.may_link(len(base), ngram_jaccard.signature(base), len(other), ngram_jaccard.signature(other))
            assert say or not links


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(40)] + [(300, 300), (401, 400), (400, 401)]
    rnd = random.Random(2)
    rnd.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 140), 100), 400: 400, 401: 400}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_language_id_on_the_held_out_fold(spark):
    docs = table(spark, "documents", SF_MID)
    got = queries.op4_language_id(spark, SF_MID).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_id_of_odd_texts_and_tables(spark):
    docs = table(spark, "documents")
    known = language_id.learn(docs)
    odd = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (2, "12 !", "c"), (3, "Thing the of", "d"), (3, "漢字", "e")],
                                DOC + ", Score string")
    got = language_id.identify(odd, known).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got][:3] == ["und"] * 3 and got[0].score == 0
    assert language_id.keep_identified(odd, known).columns == odd.columns
    assert {r.lang_pred for r in language_id.identify(odd, language_id.learn(docs.limit(0))).collect()} == {"und"}
    assert language_id.identify(odd.limit(0), known).count() == 0
    vectors = [language_id.trigram_vector((a * 65536 + b) * 65536 + c) for a, b, c in ((97, 98, 99), (98, 97, 99), (97, 98, 100))]
    assert max(abs(np.dot(x.astype(int), y)) for x, y in itertools.combinations(vectors, 2)) < 0.2 * language_id.DIM


def test_language_stage_rejects_noise_and_unlearnt_languages(spark):
    docs = table(spark, "documents", SF_MID)
    learnt = docs.where("lang <> 'fr'")
    known = language_id.calibrate(language_id.learn(learnt), learnt)
    rnd = random.Random(4)
    noise = [(k, "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)))
             for k, n in enumerate([100, 300, 2000] * 20)]
    finnish = (100, "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu "
                    "järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.")
    assert language_id.keep_identified(spark.createDataFrame([*noise, finnish], "doc_id long, text string"), known).count() <= 2
    unlearnt = docs.where("lang = 'fr'")
    assert language_id.keep_identified(unlearnt, known).count() < 0.05 * unlearnt.count()
    assert language_id.keep_identified(learnt, known).count() >= 0.995 * learnt.count()


def test_language_id_of_letters_above_the_basic_plane():
    cjk, deseret = "\U00020000\U00020001", "\U00010400\U00010428"
    assert len(language_id.letters(cjk + "\U0001F600" + cjk)) == 7 and len(set(language_id.letters(cjk))) == 3
    low = language_id.letters(deseret)
    assert low[1] == low[2] != 0 and not language_id.letters("\U0001F600").any()


def test_language_vectors_of_varied_texts_come_in_slices(monkeypatch):
    rng = np.random.default_rng(4)
    text = "".join(map(chr, rng.integers(0x4E00, 0x9000, 20_000)))       # nearly as many trigrams as letters
    keys, counts = language_id.trigrams(text)
    assert len(keys) > 4 * language_id.SLICE
    asked, of = [], language_id._VECTORS.of
    monkeypatch.setattr(language_id._VECTORS, "of", lambda k: asked.append(len(k)) or of(k))
    got = language_id.text_vector(text)
    assert max(asked) <= language_id.SLICE and len(asked) > 4
    want = sum(c * language_id.trigram_vector(k).astype(np.int64) for k, c in zip(keys.tolist(), counts.tolist()))
    assert np.allclose(got, want / np.sqrt((want ** 2).sum()), atol=1e-6)


def test_language_vectors_are_kept_as_bits_within_their_bound(monkeypatch):
    monkeypatch.setattr(language_id, "_KEPT", 40)
    rng, vectors = np.random.default_rng(5), language_id._Vectors()
    for n in (1, 30, 5, 39, 100, 3):
        keys = np.unique(rng.integers(97, 117, n) * language_id._CODES + rng.integers(97, 117, n))
        want = np.array([language_id.trigram_vector(k) for k in keys.tolist()])
        assert (vectors.of(keys) == want).all() and (vectors.of(keys[::2]) == want[::2]).all()
        assert vectors.bits.nbytes <= max(40, len(keys), len(vectors.keys)) * language_id.DIM // 8


def test_language_stage_holds_few_texts_at_once(spark):
    docs = table(spark, "documents", SF_MID).limit(2000).localCheckpoint()
    known = language_id.calibrate(language_id.learn(docs), docs)
    plan = language_id.keep_identified(docs, known)._jdf.queryExecution().executedPlan().toString()
    assert "named_struct" not in plan and "struct(" not in plan       # a text goes to Python once
    odd = spark.createDataFrame([(-1, None, "fr"), (-2, "", "en"), (None, "12 \n", None)], "doc_id long, text string, lang string")
    rows = docs.select("doc_id", "text", "lang").union(odd).union(docs.select("doc_id", "text", "lang").limit(300))
    want = language_id.identify(rows, known, reject=True).where("lang_pred <> 'und'").select(*rows.columns)
    got = language_id.keep_identified(rows, known)
    assert got.schema == rows.schema and sorted(got.collect()) == sorted(want.collect())
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"k": list(range(1000))})
    parts = list(common.in_parts([batch, batch.slice(0, 0)]))
    assert max(x.num_rows for x in parts) <= common.PART_ROWS and pa.Table.from_batches(parts).to_batches() \
        and sum((x.column(0).to_pylist() for x in parts), []) == list(range(1000))


def test_quality_learns_beside_a_bag_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(quality_model, "TRAIN_PASSAGES", 40)
    own = [i for i in range(1, 400) if in_training(i)][:20]
    rows = [(i, ("fine words of a text. " if k % 2 else "### 000 $$$ ") * 10) for k, i in enumerate(own)]
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(own)], "doc_id long, quality int")
    for long in own[:3]:
        docs = spark.createDataFrame([(i, t * 800 if i == long else t) for i, t in rows], DOC)
        scores = {r.doc_id: r.score for r in quality_model.score(docs, quality_model.learn(docs, labels)).collect()}
        good = [scores[i] for k, i in enumerate(own) if k % 2 and i != long]
        bad = [scores[i] for k, i in enumerate(own) if not k % 2 and i != long]
        assert min(good) > max(bad)


def in_training(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 != 0


def test_quality_on_the_held_out_fold(spark):
    labels = table(spark, "labels", SF_MID)
    got = queries.op5_quality_classifier(spark, SF_MID).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9
    assert all(0 <= r.score <= 1 for r in got)


def test_quality_gradient_and_odd_input(spark):
    rng = np.random.default_rng(0)
    bags, y = [rng.normal(size=(k, quality_model.FEATURES)) for k in (1, 3, 2)], np.array([1.0, 0, 1])
    w, begin, rows = quality_model.fit(bags, y).weights, np.array([0, 1, 4]), np.concatenate(bags)

    def loss(v):
        p = quality_model._forward(v, rows, begin)[0]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    for name, g in quality_model._gradient(w, rows, begin, y).items():
        moved = {**w, name: w[name] + 1e-6 * np.eye(1, w[name].size).reshape(w[name].shape)}
        assert abs((loss(moved) - loss(w)) / 1e-6 - np.ravel(g)[0]) < 1e-4
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "x"), (2, "w " * 20000)], DOC)
    none = quality_model.learn(docs, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int"))
    assert [r.score for r in quality_model.score(docs, none).collect()] == [0.5] * 4
    assert quality_model.score(docs.limit(0), none).count() == 0
    assert len(quality_model.passages("w " * 20000)) <= quality_model.MAX_PASSAGES


def test_quality_passages_have_one_length_at_every_size(spark):
    rnd = random.Random(8)
    text = " ".join("".join(rnd.choices("abcdeXYZ.,12", k=rnd.randint(1, 9))) for _ in range(20000))
    own = list(quality_model.chunks(text))
    assert [len(c) for c in own] == [64] * 4 + [57]
    rows = np.concatenate(own)
    assert np.allclose(rows[:-1, -2], np.log1p(64) / 5)
    short = [np.concatenate(list(quality_model.chunks("word " * n))) for n in (1, 64, 65, 4096, 4097)]
    assert [len(b) for b in short] == [1, 1, 2, 64, 65]
    model = quality_model.fit([rows, *short], np.array([1.0, 0, 0, 1, 0, 1]))
    whole = quality_model._forward(model.weights, (np.concatenate([rows, *short]) - model.mean) / model.scale,
                                   np.cumsum([0, len(rows), *map(len, short[:-1])]))[0]
    assert np.allclose(model.score([own, *([b[:40], b[40:]] if len(b) > 40 else [b] for b in short)]), whole)
    docs, labels = table(spark, "documents").select("doc_id", "text"), table(spark, "labels")
    once = quality_model.learn(docs, labels)
    often = quality_model.learn(docs.union(docs).union(docs).union(docs.select("doc_id", F.lit("\U0010ffff").alias("text"))), labels)
    assert np.array_equal(once.mean, often.mean) and np.array_equal(once.weights["We"], often.weights["We"])


def test_chats_recover_roles(spark):
    written = chat_format.transcripts_of(table(spark, "conversations", SF_MID)).cache()
    model = chat_format.learn(written.filter(~held_out(F.col("conv_id"))))
    right = lines = 0
    for r in written.filter(held_out(F.col("conv_id"))).collect():
        states = model.viterbi(chat_format.observations(r.transcript)[1])
        assert len(states) == len(r.states)
        right += sum(a == b for a, b in zip(states, r.states))
        lines += len(states)
    assert right / lines > 0.95
    rng = np.random.default_rng(1)
    for _ in range(10):
        seen = np.stack([rng.integers(0, k, 4) for k in chat_format.SEEN], 1)
        e = model.emissions(seen)

        def total(p):
            return model.start[p[0]] + e[0, p[0]] + sum(model.move[p[i - 1], p[i]] + e[i, p[i]] for i in range(1, 4))
        assert abs(total(model.viterbi(seen)) - max(map(total, itertools.product(range(6), repeat=4)))) < 1e-9
    odd = spark.createDataFrame([("User: hi\nAI: hello there\nhow\n\nme: ok?", 1), (None, 2), ("  \n", 3)], "transcript string, Chat int")
    got = [(r.n_turns, r.roles) for r in chat_format.format_chats(odd, model).collect()]
    assert got == [(3, "user,assistant,user"), (0, ""), (0, "")]
    empty = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat_format.format_chats(chat_format.transcripts_of(empty), model).count() == 0
    written.unpersist()


def test_chats_keep_every_line_of_the_source_turns(spark):
    later = ["Note: use it", "a > b", "A: not a turn", "Question: which one?", "https://x.y", "  def f: pass", "me - I think", "",
             "Context: none", "Answer: 42"]
    first = ["hello there, can you help me", "  indented words come first here", "well - I think so", "of course I can"]
    rows = [(c, t, ("user", "assistant")[t % 2], "\n".join([first[(c + t) % 4], *([later[(c + t) % 10], "the last line of it"]
             if (c + t) % 3 else [])])) for c in range(200) for t in range(6)]
    source: dict = {}
    for c, t, role, text in rows:
        source.setdefault(c, []).append((role, text))
    written = chat_format.transcripts_of(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    model = chat_format.learn(written)
    right = 0
    for r in chat_format.format_chats(written, model).collect():
        if model.viterbi(chat_format.observations(r.transcript)[1]) == list(r.states):
            right += 1
            assert r.chat == chat_format.render(source[r.conv_id])
    assert right > 150
    table_rows = [r for r in table(spark, "conversations", SF_MID).orderBy("conv_id", "turn").collect()]
    words = {}
    for r in table_rows:
        words.setdefault(r.conv_id, []).append(r.text)
    written = chat_format.transcripts_of(table(spark, "conversations", SF_MID))
    for r in chat_format.format_chats(written, model).where("part = 0").collect():
        assert all(line in r.chat for text in words[r.conv_id] for line in (text or "").split("\n"))


def test_pipeline_against_brute_force_stages(spark):
    docs = table(spark, "documents")
    extra = docs.limit(1).withColumn("doc_id", F.lit(9001).cast("long")).withColumn("text", F.lit("12 34"))
    docs = docs.unionByName(extra)
    kept = docs
    cached = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, kept, SF_SMALL).cache()
        cached.append(kept)
        assert kept.columns == docs.columns, name
        if name == "language_id":
            assert kept.count() == docs.count() - 1 and not kept.where("doc_id = 9001").count()
            rows = {r.doc_id: r.text for r in kept.collect()}
        elif name == "near_duplicates":
            want = {d for d, n, c in brute.components(sorted(rows.items())) if d == c}
            assert {r.doc_id for r in kept.collect()} == want
            rows = {d: rows[d] for d in want}
        elif name == "decontamination":
            items = [tuple(r) for r in table(spark, "benchmark").select("item_id", "text").collect()]
            rows = {h[0]: rows[h[0]] for h in brute.hits(list(rows.items()), items) if not h[5]}
            assert {r.doc_id for r in kept.collect()} == set(rows)
        else:
            for r in kept.collect():
                assert not brute.secrets(r.text) and r.n_chars == len(r.text) if brute.secrets(rows[r.doc_id]) else True
                assert brute.secrets(rows[r.doc_id]) or r.text == rows[r.doc_id] or "[SECRET]" in r.text
    packed = corpus_pipeline.STAGES[4][1](spark, kept, SF_SMALL)
    assert {r.doc_id for r in packed.collect()} == set(rows)
    for frame in cached:
        frame.unpersist()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "secrets", "packing"]


def test_pipeline_runs_on_the_tables(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
    assert public_tokenizers.path("word_bpe_49k.json")


def test_every_query_gives_its_contract_columns(spark):
    first = {1: ["doc_id", "start", "n_tokens", "ids_crc32"],
             2: ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
             3: ["doc_id", "n_shingles", "component_id"], 4: ["doc_id", "held_out", "lang_pred", "score"],
             5: ["doc_id", "held_out", "score", "predicted"],
             7: ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
             8: ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
             10: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]}
    for name, fn in queries.QUERIES.items():
        number = int(name[2:].split("_")[0])
        out = fn(spark, SF_SMALL)
        if number in first:
            assert out.columns[:len(first[number])] == first[number], name
        assert out.count() >= 20
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
