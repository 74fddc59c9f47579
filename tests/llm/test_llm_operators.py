"""The operators against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import functools
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from compare import assert_same, connect
from pyspark.sql import functions as F

import corpus_pipeline
from gristmill.llm import blocks, common, components, context_tree, decontaminate, embedding_dedup, html_text
from gristmill.llm import language, line_dedup, lm_scoring, packing, perplexity, queries, simhash, substring_dedup

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, h1 string, id string, turn int"


def frame(spark, texts, langs=None):
    """Documents with columns named like the operators' own ones."""
    rows = [(i, t, (langs or {}).get(i, "en"), None, None, 7, "x", "y", 3) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = make(70), "  Shared LINE " + make(12) + "\t"
    out = [(i, make(rng.randint(1, 120))) for i in range(40)]
    out += [(100 + i, f"{make(30)} {passage} {make(rng.randint(0, 30))}") for i in range(4)]
    out += [(200 + i, f"{make(9)}\n{line}\n{make(5)}\n{line.lower()}") for i in range(7)]
    near = make(300)
    out += [(300 + i, near + " " + words[i]) for i in range(4)]
    out += [(400, None), (401, ""), (402, " \n\t "), (403, "x"), (403, "x"), (403, "other"), (404, make(5000)), (405, "\n\n"), (406, "12 34 !!")]
    return out


def words_of(text):
    return (text or "").encode().split()


def linked(n, edges):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def test_context_tree_is_a_distribution_and_matches_direct_mixing():
    data = b"abracadabra abracadabra\n"
    grams, counts = np.unique(lm_scoring.grams_of([data[:-1]], 4), return_counts=True)
    levels = context_tree.grow(grams, counts.astype(float), 4, 0)
    by_depth = {4 - i: (x.keys, x.share, x.estimate) for i, x in enumerate(levels)}
    context = np.uint64(int.from_bytes(b"arba"[::1], "big")) << np.uint64(8)
    p = 2 ** context_tree.log2_probability(context | np.arange(256, dtype=np.uint64), 4, by_depth)
    assert abs(p.sum() - 1) < 1e-6
    assert abs(context_tree.log_kt(np.array([2.0]), np.array([1.0]))[0] - math.log(0.5 * 0.75 * 0.5 / 3)) < 1e-9
    # The root's mixture, by the definition: half its own estimate, half the product of its children's.
    leaf, parent = levels[0], levels[1]
    keys, below = context_tree.parents(leaf.keys, leaf.log_weighted)
    own = context_tree.log_kt(parent.zeros, parent.ones)
    assert np.allclose(parent.log_weighted, np.log(0.5 * np.exp(own) + 0.5 * np.exp(below)))


def test_lm_scoring(spark, texts):
    docs = frame(spark, [*texts, (None, "null id")])
    got = lm_scoring.score(docs, F.crc32(F.col("doc_id").cast("string")) % 5 != 1, block_bytes=3000, shard_bytes=2000).collect()
    whole = lm_scoring.score(docs, F.crc32(F.col("doc_id").cast("string")) % 5 != 1).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["base_score"], r["n_bytes"])
    assert len(got) == len(texts) + 1
    for a, b in zip(sorted(got, key=key), sorted(whole, key=key)):
        assert a["n_known"] == b["n_known"] and abs(a["score"] - b["score"]) < 1e-4 * max(1, -a["score"])
    train = Counter()
    tokens = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    for i, t in [*texts, (None, "null id")]:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    want = sorted(sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)) for _, t in [*texts, (None, "null id")])
    assert np.allclose(sorted(r["base_score"] for r in got), want) and {r["train_tokens"] for r in got} == {n}
    nothing = lm_scoring.score(docs.limit(3), F.lit(False)).collect()
    assert all(abs(r["score"] + 8 * r["n_bytes"] * math.log10(2)) < 1e-6 for r in nothing)


def mixed_by_definition(training, depth):
    """log10 probability of a text: every node's mixture by recursion over dictionaries, no arrays and no shards."""
    counts, children = {}, {}
    bits = lambda byte: f"{byte:08b}"
    around = lambda text: b"\n" * depth + text + b"\n"
    for text in map(around, training):
        for i in range(depth, len(text)):
            for d in range(depth + 1):
                for k, bit in enumerate(bits(text[i])):
                    node = text[i - d : i], bits(text[i])[:k]
                    counts.setdefault(node, [0, 0])[int(bit)] += 1
                    if d < depth:
                        children.setdefault(node, set()).add((text[i - d - 1 : i], node[1]))

    def estimated(node):
        zeros, ones = counts[node]
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    @functools.cache
    def weighted(node):
        own = estimated(node)
        if len(node[0]) == depth:
            return own
        below = sum(map(weighted, children[node]))
        return np.logaddexp(own, below) - math.log(2)

    @functools.cache
    def one(context, prefix, d, above):
        node = context[depth - d :], prefix
        if node not in counts:
            return above
        own = (counts[node][1] + 0.5) / (sum(counts[node]) + 1)
        if d == depth:
            return own
        share = math.exp(estimated(node) - math.log(2) - weighted(node))
        return share * own + (1 - share) * one(context, prefix, d + 1, own)

    def score(text):
        text, total = around(text), 0.0
        for i in range(depth, len(text)):
            for k, bit in enumerate(bits(text[i])):
                p = one(text[i - depth : i], bits(text[i])[:k], 0, 0.5)
                total += math.log10(p if bit == "1" else 1 - p)
        return total

    return score


@pytest.mark.parametrize("depth", [3, 5])
def test_scores_of_a_whole_table_by_definition(spark, texts, depth):
    rows = [(i, t) for i, t in texts if len(t or "") < 4000]
    plain = lambda t: b" ".join((t or "").encode().lower().split())
    learned = [(i, t) for i, t in rows if i % 3]
    want = mixed_by_definition([plain(t) for _, t in learned], depth)
    known = {w for _, t in learned for w in plain(t).split()}
    got = lm_scoring.score(frame(spark, rows), F.col("doc_id") % 3 != 0, depth=depth, block_bytes=3000, shard_bytes=2000).collect()
    pairs = sorted((r["doc_id"], r["score"], r["n_known"], r["n_bytes"]) for r in got)
    expected = sorted((i, want(plain(t)), 1 + sum(w in known for w in plain(t).split()), len(plain(t)) + 1) for i, t in rows)
    assert [(p[0], *p[2:]) for p in pairs] == [(e[0], *e[2:]) for e in expected]
    assert np.allclose([p[1] for p in pairs], [e[1] for e in expected], rtol=1e-4)


def test_line_dedup(spark, texts):
    docs = frame(spark, [*texts, (None, texts[-5][1]), (999, "y" * 50)])
    keys = Counter()
    for i, t in {(i, t) for i, t in texts}:
        keys.update({k for k in (x.strip(" \t\n\x0b\x0c\r").lower() for x in (t or "").split("\n")) if len(k) >= 40})
    largest = {}
    for i, t in texts:
        for x in (t or "").split("\n"):
            largest[x.strip(" \t\n\x0b\x0c\r").lower()] = max(i, largest.get(x.strip(" \t\n\x0b\x0c\r").lower(), 0))
    for fanout, batches in ((2, 5), (4, 4)):
        got = {(r["doc_id"], r["text"]): r for r in line_dedup.deduplicate(docs, batches=batches, fanout=fanout).collect()}
        for i, t in texts:
            lines = (t or "").split("\n")
            kept = [x for x in lines if not (keys[k := x.strip(" \t\n\x0b\x0c\r").lower()] >= 5 and i < largest[k])]
            row = got[i, "\n".join(kept)]
            assert (row["n_lines"], row["n_dropped"]) == (len(lines), len(lines) - len(kept)) and row["h1"] == "x"
    assert sum(r["n_dropped"] for r in got.values()) == 12


def test_line_runs_unseen(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    rows = lambda hs: spark.createDataFrame([(h, h, 0, h, h) for h in hs], "row long, doc long, pos int, h1 long, h2 long")
    for some in ([1, 2], [2, 3], [4]):
        runs.add(rows(some))
    assert [len(x) for x in runs.levels] == [1, 1]
    assert sorted(r["h1"] for r in runs.unseen(rows([2, 4, 5])).collect()) == [5]
    assert {r["h1"]: r["documents"] for r in runs.merged().collect()} == {1: 1, 2: 2, 3: 1, 4: 1}


def test_embedding_dedup(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 24))
    vectors = np.concatenate([base, base[:20] + rng.normal(scale=0.04, size=(20, 24)), base[:5], base[:5] * 2]).astype(np.float32)
    label = [i % 2 for i in range(60)] + [i % 2 for i in range(20)] + [0, 1, 0, 1, 0] * 2
    rows = [(i, v.tolist(), lab, "z", 1) for i, (v, lab) in enumerate(zip(vectors, label))]
    bad = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] * 24, [None] * 24, vectors[0].tolist(), vectors[0].tolist()[:5]]
    rows += [(200 + i, v, None if i == 6 else 0, "z", 1) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, node string, tile int")
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    near = (unit @ unit.T >= 0.98) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(near, False)
    root = linked(len(vectors), np.argwhere(near).tolist())
    for tile in (7, 1024):
        got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df, tile=tile).collect()}
        assert near.sum() > 20 and len(got) == len(rows)
        for i in range(len(vectors)):
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (near[i].sum(), root[i], root[i] == i)
        assert all(got[200 + i]["n_links"] == 0 and got[200 + i]["kept"] for i in range(len(bad)))
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    other = df.withColumn("label", F.when(F.col("label").isNotNull(), F.lit(float("nan")))).withColumn("embedding", F.col("embedding").cast("array<double>"))
    near = unit @ unit.T >= 0.98
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(other, tile=16).collect()}
    assert [got[i] for i in range(len(vectors))] == (near.sum(axis=1) - 1).tolist()


def test_quantised_bound_never_loses_a_pair():
    rng = np.random.default_rng(1)
    vectors = [rng.normal(size=(n, 2000)).astype(kind) for n, kind in ((80, np.float64), (70, np.float32))]
    a, b = (embedding_dedup.Codes.of(v) for v in vectors)
    units = [v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None] for v in vectors]
    for codes, unit in zip((a, b), units):
        off = np.linalg.norm(unit - codes.scale[:, None] * codes.codes, axis=1)
        assert codes.codes.dtype == np.int8 and (off <= codes.error).all() and (codes.error < 0.02).all()
        again = embedding_dedup.Codes.read(codes.written() | {"dim": 2000})
        assert all((getattr(again, k) == getattr(codes, k)).all() for k in ("codes", "scale", "error"))
    cosine = units[0] @ units[1].T
    for t in (-0.01, 0.0, 0.02):
        assert not ((cosine >= t) & ~embedding_dedup.candidates(a, b, t)).any()


def test_only_vectors_with_possible_partners_are_fetched():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(50, 32))
    other = rng.normal(size=(40, 32))
    other[7], other[9] = base[3] * 3, base[3] + 0.01
    rows = [embedding_dedup.Codes.of(v).written() | {"home": {"tile": t}, "dim": 32} for t, v in ((5, other), (2, base))]
    got = {r["home"]["tile"]: np.frombuffer(r["wanted"], np.int32).tolist() for r in embedding_dedup._wanted({}, rows, 0.98)}
    assert got == {2: [3], 5: [7, 9]}
    alone = {r["home"]["tile"]: [x["home"]["tile"] for x in embedding_dedup._wanted({}, [r], 0.98)] for r in rows}
    assert alone == {2: [], 5: [5]}


@pytest.mark.parametrize("codes", [1, 2])
def test_anchors_meet_all_near_prints(codes):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**64, 300, dtype=np.uint64)
    y = x.copy()
    for i in range(300):
        for bit in rng.choice(64, i % 4, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(bit)
    which, anchor, home = simhash.anchors(x, codes)
    homes = dict(zip(which[home].tolist(), anchor[home].tolist()))
    assert len(homes) == home.sum() == 300
    which, anchor, _ = simhash.anchors(y, codes)
    reached = set(zip(which.tolist(), anchor.tolist()))
    assert all((i, homes[i]) in reached for i in range(300))


def test_simhash(spark, texts):
    def brute(text):
        w = (text or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    got = simhash.near_duplicates(frame(spark, texts)).collect()
    prints = [brute(t) for _, t in texts]
    ids = [i for i, _ in texts]
    order = sorted(range(len(ids)), key=lambda k: ids[k])
    edges = [(a, b) for a in range(len(order)) for b in range(a) if (prints[order[a]] ^ prints[order[b]]).bit_count() <= 3]
    root = linked(len(order), edges)
    want = sorted((ids[order[k]], prints[order[k]], ids[order[root[k]]]) for k in range(len(order)))
    assert sorted((r["doc_id"], r["print"] % 2**64, r["component_id"]) for r in got) == want
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(5, 5)]
    root = linked(200, edges)
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {n: root[n] for e in edges if e[0] != e[1] for n in e}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_substring_dedup(spark, texts):
    extra = [*texts, (500, f"{texts[41][1]} {texts[41][1]}"), (501, texts[46][1]), (502, " ".join("ab" for _ in range(130)))]
    first = {}
    for i, t in sorted(extra, key=lambda x: x[0]):
        w = words_of(t)
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    want = []
    for i, t in extra:
        w = words_of(t)
        gone = {j for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for j in range(k, k + 50)}
        want.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    assert sum(x[2] for x in want) > 200
    for size in (2000, blocks.BLOCK_BYTES):
        got = substring_dedup.deduplicate(frame(spark, extra), block_bytes=size, shard_words=500).collect()
        assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got) == sorted(want)
    assert substring_dedup.levels_of(50) == [25, 50] and substring_dedup.levels_of(200) == [25, 50, 100, 200]


def test_quality_model_is_a_distribution(spark):
    texts = spark.createDataFrame([("a b a c a b",), ("b a c",), ("a a a b",)], "text string")
    one = [("".join(x),) for x in ("a", "b", "c", "zzz")]
    ask = spark.createDataFrame([(i, f"a b {t}") for i, (t,) in enumerate(one)] + [(9, "a b")], "id long, text string")
    got = {r["id"]: r["log10"] for r in perplexity.score(ask, texts, "id", "text").collect()}
    assert all(x < 0 for x in got.values())
    # Discounted estimates by hand for the bigram context of a start: p(a|start,start) from counts a:2 b:1.
    entries, constants = perplexity.train(texts, 4)
    words, _ = constants["words"]
    assert len(words) == 3 and entries.count() > 0


def test_quality_classes(spark, texts):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(50)]
    good = [(1000 + i, " ".join(rng.choice(words) for _ in range(40))) for i in range(60)]
    junk = [(2000 + i, " ".join(f"{rng.random():.9f}%" for _ in range(40))) for i in range(5)]
    docs = frame(spark, [*good, *junk, (3000, None), (3001, "")])
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good[:40]] + [(2000, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in perplexity.classify(docs, labels).collect()}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in junk) and not kept[3000] and not kept[3001]
    assert perplexity.classify(docs.limit(0), labels).count() == 0


def test_packing(spark, texts):
    got = packing.pack(frame(spark, texts), capacity=128, keep_ids=True).collect()
    tokenizer = packing.WordIds(packing.tokenizer_path())._tokenizer
    want = Counter()
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for p, at in enumerate(range(0, len(ids), 128)):
            part = np.array(ids[at : at + 128], "<u4")
            want[i, p, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    rows = {}
    for r in got:
        rows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in rows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 128
    assert len(rows) <= -(-sum(r["length"] for r in got) // 128) * 1.03 + 1
    assert packing.pack(frame(spark, [])).count() == 0


def test_plan_uses_every_piece_once_and_packs_tightly():
    rng = random.Random(2)
    for n in (0, 1, 50, 5000):
        counts = Counter(min(100, int(rng.paretovariate(0.8) * 3)) for _ in range(n))
        used = Counter()
        patterns = packing.plan(counts, 100)
        for times, content in patterns:
            assert sum(x * k for x, k in content) <= 100
            for x, k in content:
                used[x] += k * times
        assert used == counts
        assert sum(t for t, _ in patterns) <= -(-sum(x * k for x, k in counts.items()) // 100) * 1.02 + 1


def test_word_ids_equal_the_tokenizer():
    texts = ["It's. don't, x.. é. É, ß. \x1cab. A B, 12.5, 3. '. , <", "a<|endoftext|>B <|ENDOFTEXT|>", "", " ", "Ünï.Code,"]
    ids = packing.WordIds(packing.tokenizer_path())
    assert ids.encode(texts) == ids._encoded(texts)


def test_word_ids_of_marks_that_compose_in_one_case():
    marks = [chr(c) for c in range(0x300, 0x370)]
    pairs = [a + m for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for m in marks]
    texts = [f"{p}ab {p}" for p in pairs] + [f"J{m}\u030cab T\u0308{m} H{m}\u0331 Y\u030a{m}, W{m}\u030a." for m in marks] + ["Jab Th wY"]
    ids = packing.WordIds(packing.tokenizer_path())
    assert ids.encode(texts) == ids._encoded(texts)


def test_packing_forgets_only_words_that_are_not_at_hand():
    """Where memory ends, words that come again are not encoded again."""
    ids = packing.WordIds(packing.tokenizer_path(), remembered=40)
    learned, learn = [], ids._learn
    ids._learn = lambda words: (learned.extend(words), learn(words))
    usual = "the usual words, often met."
    for n in range(6):
        texts = [usual + "".join(f" once{n}x{i}" for i in range(20)), "The USUAL it\u00e9ms"]
        assert ids.encode(texts) == ids._encoded(texts)
        assert len(ids._known) <= 60
    assert learned.count(b"usual") == 1


def test_word_ids_hold_equal_words_once():
    """Memory of a batch's words follows the distinct words, not the text."""
    ids = packing.WordIds(packing.tokenizer_path())
    texts = ["often met words " * 4000] * 20
    ids.encode(texts[:1])
    tracemalloc.start()
    found = ids.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Eight bytes for each word's place and as many for its ids; a word as an object of its own would take 40 more.
    assert peak - sum(map(len, found)) < 16 * 20 * 12_000


def test_a_task_gives_its_memory_back_when_it_ends(spark, monkeypatch):
    """Idle workers of earlier stages share an executor with the tasks of the next."""

    class Frame:
        def mapInArrow(self, run, schema):
            return run

    rows = common.map_rows(Frame(), lambda rows: rows, "a bigint")(iter([pa.RecordBatch.from_pylist([{"a": 1}])]))
    given = []
    monkeypatch.setattr(common, "_give_back", lambda: given.append(1))
    assert next(rows).to_pylist() == [{"a": 1}]
    before = len(given)
    assert list(rows) == [] and len(given) == before + 1


def test_language(spark):
    rng = random.Random(7)
    vocab = {"en": ["the", "thing", "shower"], "de": ["über", "schön", "nicht"], "fr": ["être", "où", "leçon"]}
    rows = [(i, " ".join(rng.choice(vocab[k]) for _ in range(20)), k) for i, k in enumerate(list(vocab) * 20)]
    docs = frame(spark, [(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (902, "12 !!")], {i: k for i, _, k in rows})
    got = {r["doc_id"]: r for r in language.identify(docs, learn=F.col("doc_id") < 30).collect()}
    assert all(got[i]["lang_pred"] == k and 0 <= got[i]["score"] <= 1 for i, _, k in rows)
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0) for i in (900, 901, 902)) and got[0]["h1"] == "x"
    assert {r["lang_pred"] for r in language.identify(docs, learn=F.lit(False)).collect()} == {"und"}
    assert language.identify(docs.limit(0)).count() == 0


def test_language_with_long_texts_only(spark):
    rng = random.Random(8)
    text = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(["the", "thing", "shower"], 20), "en") for i in range(20)]
    rows += [(100 + i, "12 " * language.SAMPLE_CHARS + text(["über", "schön", "nicht"], 9000 + i), "de") for i in range(3)]
    rows += [(200, text(["the", "thing", "shower"], 9000), "en"), (300, "schön über nicht über", None)]
    docs = frame(spark, [r[:2] for r in rows], {i: k for i, _, k in rows})
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs.where("doc_id < 300"), docs.where("doc_id < 300")).collect()}
    assert got == {i: k for i, _, k in rows if k}
    filled = corpus_pipeline.identify_language(spark, docs.withColumn("lang", F.when(F.col("doc_id") < 300, F.col("lang"))), "").collect()
    assert {r["doc_id"]: r["lang"] for r in filled}[300] == "de"
    taken = language.sample(docs, F.lit(True), "text", "lang").collect()
    assert all(len(r["text"]) <= language.SAMPLE_CHARS for r in taken) and Counter(r["lang"] for r in taken)["de"] >= 3


def test_language_held_out_accuracy(spark, sf_dir):
    done = queries.queries()["op9_language"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n = done.where("held_out").agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.97


def test_decontamination(spark, texts):
    rng = random.Random(9)
    item = lambda n: " ".join(f"w{rng.randrange(1000)}" for _ in range(n))
    items = [(i, item(n)) for i, n in enumerate((5, 9, 17, 40, 64))] + [(90, None), (91, ""), (92, "two words"), (93, items_dup := item(30)), (94, items_dup)]
    docs = [*texts, *[(600 + i, f"before {t.upper()}\nafter " + item(50)) for i, t in items if t], (700, "two  words"), (701, items[3][1][:150])]
    shingles = lambda t: (lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())((t or "").lower().split())
    want = set()
    for i, t in docs:
        for k, b in items:
            s = shingles(b)
            if s and (n := len(s & shingles(t))) >= math.ceil(0.8 * len(s) - 1e-9):
                want.add((i, k, len(s), n))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit("clash"))
    got = decontaminate.contaminated(frame(spark, docs), bench).collect()
    assert len(want) > 8 and {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in got} == want
    assert decontaminate.contaminated(frame(spark, docs), bench.limit(0)).count() == 0


def test_html_blocks_and_differencing(spark):
    page = "<html><head><title>t</title><script>var x='</p>'</script></head><body><nav>menu</nav><div class='ad'>buy</div>{}<footer>f</footer>"
    shell = page.format("<div>Site &amp; slogan</div><div>{}</div><div>All rights</div>")
    rows = [
        (1, "http://a.b/x/1", shell.format("Own text one")), (2, "http://a.b/x/2", shell.format("Own <b>text</b>\n two<br>end")),
        (3, "http://c.d/1", page.format("<article><h1>Head</h1><p>One<p>Two &lt;3<div class=comments>no</div></article>")),
        (3, "http://c.d/1", page.format("<article><h1>Head</h1><p>One<p>Two &lt;3<div class=comments>no</div></article>")),
        (4, None, None), (5, "::bad", ""), (None, "http://c.d/2", "<p>plain"), (6, "http://c.d/3", "<article><p>Cut"),
    ]
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "page_id long, url string, html string, row int, host string")
    got = sorted((r["page_id"] or 0, r["text"]) for r in html_text.extract(df).collect())
    assert got == [(0, "plain"), (1, "Own text one"), (2, "Own text two end"), (3, "Head\n\nOne\n\nTwo <3"), (3, "Head\n\nOne\n\nTwo <3"), (4, ""), (5, ""), (6, "Cut")]
    assert html_text.extract(df.limit(0)).count() == 0


def test_html_copies_keep_their_text(spark):
    page = "<div class='ad'>buy {}</div><div>Site</div><div>{}</div><div>All rights</div>{}"
    rows = [(1, "http://a.b/x/1", page.format(0, "One", ""), "One")] * 3  # repeated rows
    rows += [(i, f"http://a.b/x/1/print{i}", page.format(i, "One", ""), "One") for i in range(2, 5)]  # one page, several URLs
    rows += [(5, "http://a.b/z", page.format(0, "Two", ""), "Two")]
    rows += [(i, f"http://c.d/{i}", page.format(0, "Same", f"<article>{i}</article>"), f"{i}") for i in (6, 7)]  # not copies
    rows += [(i, f"http://e.f/{i}", "<div>Only page</div>", "Only page") for i in (8, 9)] + [(10, "http://e.g/10", "<div>Only page</div>", "Only page")]
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    for parts in (1, 5):
        got = sorted((r["page_id"], r["text"]) for r in html_text.extract(df.repartition(parts)).collect())
        assert got == sorted((i, text) for i, _, _, text in rows)


def test_common_subsequence():
    rng = random.Random(3)
    for _ in range(500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        picked, rest = html_text.common_subsequence(a, b), iter(b)
        assert len(picked) == best[-1][-1] and all(a[i] in rest for i in picked)


def test_packed_arrays_round_trip():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 1000).astype(np.uint64))
    assert (common.unpack_sorted(common.pack_sorted(keys)) == keys).all()
    assert len(common.unpack(common.pack(np.zeros(0, np.float32)), np.float32)) == 0
    table = common.Lookup(keys, np.arange(len(keys)))
    assert (table.get(keys, -1) == np.arange(len(keys))).all() and (table.get(keys + np.uint64(1), -1) == -1).mean() > 0.99


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(name, spark, sf_dir):
    assert assert_same(queries.queries()[name](spark, sf_dir), connect(sf_dir), queries.oracle_sql()[name]) > 0


@pytest.mark.parametrize(
    "operator",
    [
        lambda docs: lm_scoring.score(docs, F.lit(True)),
        lambda docs: simhash.near_duplicates(docs),
        lambda docs: substring_dedup.deduplicate(docs),
        lambda docs: packing.pack(docs),
        lambda docs: decontaminate.contaminated(docs, docs.sparkSession.createDataFrame([(1, "a few words of an item")], "item_id long, text string")),
    ],
    ids=["lm_scoring", "simhash", "substring_dedup", "packing", "decontamination"],
)
def test_empty_tables_give_empty_results(spark, operator):
    assert operator(frame(spark, [(1, "x")]).limit(0)).count() == 0


def test_pipeline_keeps_documents_without_a_language_to_learn(spark, tmp_path):
    texts = ["Some words", "été", "12 !!", "", None, "²", "_", "\u4e00", "x" * 30_000]
    docs = frame(spark, list(enumerate(texts))).withColumn("lang", F.lit(None).cast("string"))
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify_language(spark, docs, str(tmp_path)).collect()}
    assert got == {i: "und" for i, t in enumerate(texts) if t and language.LETTER.search(t)}
    some = docs.withColumn("lang", F.when(F.col("doc_id") == 0, "en"))
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify_language(spark, some, str(tmp_path)).collect()}
    assert got == {i: "en" for i, t in enumerate(texts) if t and language.LETTER.search(t)}


def test_pipeline_keeps_texts_that_share_an_id(spark, texts, tmp_path):
    twin, docs = texts[3][1], [t for t in texts if t[0] == 403] + [(5, texts[3][1]), (7, texts[3][1]), (7, texts[4][1]), (7, texts[5][1])]
    for parts in (1, 4):
        done = corpus_pipeline.drop_near_duplicates(spark, frame(spark, docs).repartition(parts), str(tmp_path))
        got = sorted((r["doc_id"], r["text"]) for r in done.collect())
        assert got == sorted([(403, "x"), (403, "other"), (5, twin), (7, texts[4][1]), (7, texts[5][1])])


def test_pipeline(spark, texts, tmp_path):
    docs = frame(spark, [*texts, (800, texts[3][1])]).drop("row", "h1", "id", "turn")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, texts[5][1])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stage, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, step in corpus_pipeline.STAGES:
        stage = common.materialize(step(spark, stage, str(tmp_path)), f"test-{name}")
        seen[name] = stage.collect()
        if name != "packing":
            assert stage.columns == corpus_pipeline.COLUMNS
    ids = {name: {r["doc_id"] for r in rows} for name, rows in seen.items()}
    assert {400, 401, 402, 405}.isdisjoint(ids["language"]) and 0 in ids["language"]
    assert 800 not in ids["near_duplicates"] and texts[3][0] in ids["near_duplicates"]
    assert texts[5][0] not in ids["decontamination"] and ids["packing"] == ids["decontamination"]
    assert all(r["n_chars"] == len(r["text"]) for r in seen["decontamination"])
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == ids["packing"]


def test_pipeline_of_an_empty_table(spark, tmp_path):
    frame(spark, [(1, "x")]).limit(0).drop("row", "h1", "id", "turn").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "a few words of an item")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_groups_dealt_by_place_are_whole_and_balanced(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('word ', 40) as text").repartition(7)
    cut = blocks.cut(docs, "doc_id", "text", lower=False, block_bytes=20_000)
    rows = cut.select("block", "n_words").unionByName(cut.select("block", "n_words"))

    def count(block, group):
        yield {"block": block, "rows": sum(1 for _ in group)}

    done = common.map_groups(rows, "block", 5, count, "block long, rows int", place=blocks.place(cut)).withColumn("task", F.spark_partition_id())
    found = done.collect()
    assert {r["rows"] for r in found} == {2} and len(found) == cut.count() > 25
    tasks = Counter(r["task"] for r in found)
    assert len(tasks) == 5 and max(tasks.values()) <= 2 * min(tasks.values())
    assert common.map_groups(rows.limit(0), "block", 5, count, "block long, rows int", place=blocks.place(cut.limit(0))).count() == 0
