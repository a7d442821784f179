"""Near dedup, packing, line labels, vectors, languages, repeats, toxicity: brute force and edge cases."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendstar.llm import balltree, langid, linecrf, minhash, packing, queries, suffixes, toxicity
from spendstar.llm.components import components

from .conftest import texts

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(t):
    w = WORD.findall(ascii_lower(t))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            same = len(sets[i] & sets[j])
            if same and 100 * same >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies():
    """Groups of copies with a few changed words, copies, short texts, shared passages."""
    rng = random.Random(3)
    base = texts(12, seed=1, words=120)
    passage = texts(1, seed=9, words=40)[0]
    rows, n = [], 0
    for t in base:
        for _ in range(6):
            w = t.split()
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n + k, passage + " " + t) for k, t in enumerate(texts(30, seed=4, words=12))]
    n += 30
    rows += [(n + k, t) for k, t in enumerate([None, "", " \n", "a b", "A B", "a b c d", "a b c d e", "A  b\tc d E", "é É"])]
    return rows


@pytest.mark.parametrize("group_docs", [2000, 3])
def test_near_duplicates(spark, make_docs, group_docs):
    rows = near_copies()
    want = brute_components(rows)
    docs = make_docs(rows + [(None, "a b"), (0, rows[0][1])]).withColumn("kept", F.lit("clash")).withColumn("id", F.lit(1))
    got = minhash.near_duplicates(docs, group_docs=group_docs).collect()
    assert len(got) == len(rows) + 2 and "id" in got[0].asDict()
    for r in got:
        if r["doc_id"] is None:
            assert r["kept"] and r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["component_id"] == r["doc_id"])
    assert len({c for _, c in want.values()}) < len(want) - 8


def test_near_duplicates_of_nothing(spark, make_docs):
    assert minhash.near_duplicates(make_docs([])).count() == 0
    assert [r["kept"] for r in minhash.near_duplicates(make_docs([(1, None), (2, "")])).collect()] == [True, True]


def test_registers_estimate():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2))
    for share in (0.0, 0.5, 0.9):
        n = int(len(a) * share)
        b = np.unique(np.concatenate([a[:n], rng.integers(0, 2**63, len(a) - n, dtype=np.uint64) * np.uint64(2)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        reg = minhash.registers([a, b])
        j, err = minhash.estimate(reg[:1], reg[1:], np.array([len(a)]), np.array([len(b)]))
        assert abs(j[0] - true) < 5 * max(err[0], 0.03)
    assert (minhash.registers([np.zeros(0, np.uint64)]) == minhash.EMPTY).all()
    # register matches by chance, against a simulation with few mantissa values seen as equal
    assert 0 < minhash.accidental(20, 20) < 2e-3


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {k: 100 for k in range(100, 160)} | {200: 200, 201: 200}
    assert got == want


TRICKY = ["", "foo <|endoftext|> bar", "a<|startoftext|>b<|endoftext|>, <|ENDOFTEXT|> <|endoftext|>%",
          "it's   é éa, x\ty\x1cz <|endoftext|> İstanbul ΑΣ. 12ab%%% ½x ﬁn  \n\n don't!!", " ", "éa é, ((a))",
          "THE the The, the. 'tis we'll", "日本 語, 한국", None]


def test_packing_round_trip(spark, make_docs):
    path = queries.tokenizer_path()
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)      # as the contract names it, without other settings
    rows = [(i, t) for i, t in enumerate(TRICKY + texts(150, seed=5, words=300) + [" ".join(texts(60, seed=6))])]
    docs = make_docs(rows + [(9, rows[9][1])]).withColumn("start", F.lit("clash"))
    got = packing.pack(docs, path, window=256, shard_bytes=40_000).collect()
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in got:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces[r["doc_id"], r["copy"]].append((r["start"], r["length"]))
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == {(i, 0) for i, _ in rows} | {(9, 1)}
    for (i, _), p in pieces.items():
        assert [s for s, _ in sorted(p)] == list(np.cumsum([0] + [n for _, n in sorted(p)])[:-1])
        assert sum(n for _, n in p) == len(ids[i])
    full = 0
    for w in windows.values():
        assert [o for o, _ in sorted(w)] == list(np.cumsum([0] + [n for _, n in sorted(w)])[:-1])
        full += sum(n for _, n in w) == 256
        assert sum(n for _, n in w) <= 256
    assert len(windows) - full <= len({s >> 32 for s in windows})
    again = packing.pack(docs, path, window=256, shard_bytes=40_000).collect()
    assert sorted(got) == sorted(again)
    assert packing.pack(make_docs([]), path).count() == 0


def test_packing_keeps_places_only(spark, make_docs):
    """Before the texts are shuffled, what was counted and read to find the places is gone."""
    import glob
    from spendstar.session import ensure_checkpoint_dir
    folder = f"{ensure_checkpoint_dir(spark)}/packing-*/*".removeprefix("file:")
    before = set(glob.glob(folder))
    out = packing.pack(make_docs(list(enumerate(texts(40)))), queries.tokenizer_path(), window=256)
    assert {p.rsplit("/", 1)[1] for p in set(glob.glob(folder)) - before} == {"places"}
    assert out.select("doc_id").distinct().count() == 40


def test_packing_puts_neighbours_together():
    tok = packing.WordTokenizer(queries.tokenizer_path())
    topics = [[f"{a}{c}" for c in "abcdefgh"] for a in ("zug", "mond", "brot", "fisch")]
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(topics[k % 4]) for _ in range(60))) for k in range(80)]
    table = packing.pack_shard([i for i, _ in rows], [t for _, t in rows], tok, 0, 1024, 1).to_pylist()
    mixed = defaultdict(Counter)
    for r in table:
        mixed[r["sequence_id"]][r["doc_id"] % 4] += r["length"]
    assert np.mean([max(c.values()) / sum(c.values()) for c in mixed.values()]) > 0.8


@pytest.mark.parametrize("head", [packing.HEAD_WORDS, 50, 0])
def test_packing_finds_neighbours_of_the_whole_table(spark, make_docs, head):
    """40 small topics whose documents are far apart by id land in one shard each; also if the rare words are joined."""
    rng = random.Random(4)
    common = texts(1, seed=8, words=60)[0].split()
    rows = []
    for k in range(400):
        own = [f"topic{k % 40}word{c}" for c in rng.sample(range(12), 8)]
        rows.append((k, " ".join(own + [rng.choice(common) for _ in range(40)])))
    docs = make_docs(rows + [(None, "no id"), (None, None)])
    got = packing.pack(docs, queries.tokenizer_path(), window=512, shard_bytes=10_000, head_words=head).collect()
    shards = defaultdict(set)
    for r in got:
        if r["doc_id"] is not None:
            shards[r["doc_id"]].add(r["sequence_id"] >> 32)
    assert len(shards) == 400 and len({x for s in shards.values() for x in s}) > 5
    assert sum(r["doc_id"] is None and r["start"] == 0 for r in got) == 2
    together = [shards[i] == shards[j] for i in range(400) for j in range(i) if i % 40 == j % 40]
    assert np.mean(together) > 0.5


def test_packing_statistics_are_those_of_the_table(spark, make_docs):
    rows = [(i, t) for i, t in enumerate(texts(300, seed=2))]
    have = {r["word"]: (r["df"], r["n_words"]) for r in packing.count_words(make_docs(rows).select("text").repartition(7)).collect()}
    df = Counter(w for _, t in rows for w in set(t.split()))
    assert have.pop(None)[1] == sum(len(t.split()) for _, t in rows)
    assert sorted(d for d, _ in have.values()) == sorted(c for c in df.values() if c > 1)


def test_packing_tasks_find_the_words_of_their_worker():
    """What a task refers to by name in the module stays in the worker; a table comes along with each task, empty."""
    import types

    def names(code):
        inner = [c for c in code.co_consts if isinstance(c, types.CodeType)]
        return set().union(*(set(c.co_names) | names(c) for c in inner))

    tables = {k for k, v in vars(packing).items() if isinstance(v, (dict, list, set))}
    assert not names(packing.pack.__code__) & tables
    path = queries.tokenizer_path()
    assert packing.word_tokenizer(path) is packing.word_tokenizer(path)


@pytest.mark.parametrize("ranges", [1, 7])
def test_packing_counts_words_by_ranges(spark, make_docs, ranges):
    rows = [(i, t) for i, t in enumerate(texts(200, seed=3))]
    out = packing.count_words(make_docs(rows).select("text").repartition(5), ranges)
    have = [(r["df"], r["n_words"]) for r in out.collect()]
    df = Counter(w for _, t in rows for w in set(t.split()))
    assert sorted(have) == sorted([(0, sum(len(t.split()) for _, t in rows))] + [(c, 0) for c in df.values() if c > 1])
    assert "FlatMapGroupsInArrow" in out._jdf.queryExecution().executedPlan().toString()     # no row per word is shuffled


@pytest.mark.parametrize("low", [2, 4])
def test_packing_chooses_the_commonest_of_the_heaviest_words(spark, make_docs, tmp_path, low):
    """Lead and next of every document by plain Python, from the operator's hashes; the choice sorts no arrays in Spark."""
    long = texts(120, seed=9, words=60)
    rows = [*enumerate(long), *((200 + i, " ".join(t.split()[:15])) for i, t in enumerate(long)), (500, ""), (501, None)]
    docs = make_docs(rows).select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    table = packing.count_words(docs.select("text"), 3).filter(F.col("word").isNotNull()).localCheckpoint()
    df = {r["word"] % 2**64: r["df"] for r in table.collect()}
    n, mean = len(rows), np.mean([len((t or "").split()) for _, t in rows])
    known = sorted(w for w, d in df.items() if d >= low)
    of = packing.Statistics(n, mean, np.array(known, np.uint64), np.array([df[w] for w in known], np.int64))
    out = packing.places(docs, table, spark.sparkContext.broadcast(of), low, 40, str(tmp_path / "read"))
    assert "sort_array" not in "".join(str(out._jdf.queryExecution().optimizedPlan()).split("MapInArrow")[0])
    got = {r["id"]: r for r in out.collect()}
    assert set(got) == {i for i, _ in rows}
    checked = 0
    for i, t in rows:
        words = (t or "").split()
        data = np.frombuffer(" ".join(words).encode(), np.uint8)
        start, stop, _ = packing.words(data, np.array([0, len(data)]))
        heavy = []
        for w, tf in Counter(packing.span_hashes(data, start, stop).tolist()).items():
            if w in df:
                d = np.int64(df[w])
                part = tf * (packing.K1 + 1) / (tf + of.norm(np.array([len(words)]))[0])
                signed = w - 2**64 if w >= 2**63 else w
                heavy.append((-np.float32(of.idf(d) * part) if d >= low else np.float32(-of.idf(d) * np.float32(part)), signed, int(d)))
        ranks = sorted((-d if d <= 40 else d, w) for _, w, d in sorted(heavy)[:packing.PLACE_WORDS])
        if ranks and len(heavy) <= packing.PLACE_WORDS:          # at the cut floats may round either way
            checked += 1
            assert got[i]["lead"] == ranks[0][1]
            assert got[i]["next"] == (ranks[1][1] if len(ranks) > 1 else 0)
        assert sorted(tuple(r) for r in got[i]["rare"] or ()) == sorted((w, d) for _, w, d in heavy if d < low)
    assert checked >= 100


def test_packing_order_is_stable():
    rng = np.random.default_rng(1)
    for value in (rng.integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2), rng.integers(0, 2**64, 300, dtype=np.uint64).repeat(9),
                  np.arange(3000, dtype=np.uint64)[::-1].copy(), np.zeros(0, np.uint64)):
        value = rng.permutation(value)
        by, ordered = packing.stable_order(value)
        assert (by == np.argsort(value, kind="stable")).all() and (ordered == np.sort(value)).all()


def test_packing_forgets_used_documents_only():
    """Documents come in the order that all postings give."""
    rng = random.Random(7)
    text = [" ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 9) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    value = [np.array([hash(w) % 2**64 for w in t.split()], np.uint64) for t in text]
    count = np.array([len(v) for v in value])
    word, doc, tf, new = packing.postings(np.concatenate(value), count)
    df = np.diff(new, append=len(word))
    size = count + 1

    def order(forget):
        index = packing.Index(np.repeat(np.arange(len(df)), df), doc, tf, df, count, packing.Statistics(300, count.mean(), word[new], df), df)
        if not forget:
            index.forget = lambda used: None
        return packing.reading_order(index, size, 64).tolist()
    assert order(True) == order(False) and sorted(order(True)) == list(range(300))


def brute_rules(t):
    t = t or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for x in t.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cov = {k for i in range(len(w) - 7) if win[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cov)


def test_line_rules_and_labels(spark, make_docs):
    rng = random.Random(8)
    good = [". ".join(texts(4, seed=k, words=12)).capitalize() + "." for k in range(60)]
    bad = ["%%% ".join(rng.choice("AB") * 6 for _ in range(30)) + " ||| ###" for _ in range(60)]
    rows = [(i, t, None, None) for i, t in enumerate([None, "", "\n \n", "a\n\na\na", "x " * 30, "é\x0bü\x1ck " * 12] + good + bad)]
    docs = make_docs(rows).withColumn("kept", F.lit(1)).withColumn("n", F.lit(2))
    labels = spark.createDataFrame([(i, 1 if i < 66 else 0) for i in range(6, 126, 2)], "doc_id long, quality int")
    model = linecrf.train(docs, labels)
    got = {r["doc_id"]: r for r in linecrf.judge(docs, model).collect()}
    for i, t, *_ in rows:
        r = got[i]
        assert tuple(r[c] for c in linecrf.RULE_COLUMNS) == brute_rules(t)
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    odd = [i for i in range(7, 126, 2) if not got[i]["base_failed"]]
    assert np.mean([got[i]["kept"] == (i < 66) for i in odd]) > 0.95
    assert linecrf.train(docs, labels.limit(0)) is linecrf.ALL_CONTENT
    assert linecrf.judge(docs, linecrf.ALL_CONTENT).filter("n_words > 0 and content_share < 1").count() == 0
    assert linecrf.judge(make_docs([]), model).count() == 0


def test_viterbi_and_gradient_against_all_paths():
    rng = np.random.default_rng(0)
    bounds = np.array([0, 4, 4, 5, 8])
    x, y = rng.normal(size=(8, linecrf.N_FEATURES)), rng.integers(0, 2, 8)
    m = linecrf.fit(x, bounds, y, rounds=30)
    import itertools
    got = linecrf.viterbi(m, x, bounds)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b > a:
            def score(path, a=a):
                s = m.first[path[0]] + sum((x[a + k] @ m.emit)[v] for k, v in enumerate(path))
                return s + sum(m.move[u, v] for u, v in itertools.pairwise(path))
            best = max(itertools.product((0, 1), repeat=int(b - a)), key=score)
            assert tuple(got[a:b]) == best


def test_ball_tree_is_exact(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(0, 1, (12, 8))
    rows = [(int(i), [float(v) for v in centre[i % 12] + rng.normal(0, 0.1, 8)]) for i in range(900)]
    rows += [(2000 + i, [0.25] * 8) for i in range(40)] + [(3000, None), (3001, [1.0] * 7 + [float("nan")]), (3002, []),
                                                           (3003, [1.0] * 7 + [None]), (3004, [1e30] * 7 + [float("inf")]),
                                                           (3100, [1.0, 2.0, 3.0]), (3200, [2.0, 2.0, 2.0])]
    rows += [rows[0], (None, [1.0] * 8)]
    items = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = defaultdict(list)
    for r in balltree.top_k(items, items.filter("vec_id % 20 = 0"), shard_rows=100, block=16).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got[r["query_id"]]) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    real = {i: np.floor(np.array(v, float) * 1024).astype(np.int64) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    for q in (i for i in real if i % 20 == 0):
        all_ = sorted(((-int(real[q] @ v), i) for i, v in real.items() if i != q and len(v) == len(real[q])))[:10]
        assert got[q] == [(i, -s) for s, i in all_]
    assert set(got) == {i for i in real if i % 20 == 0}
    assert balltree.top_k(items.limit(0), items.limit(0)).count() == 0


def test_tree_prunes_and_wide_products():
    rng = np.random.default_rng(1)
    centre = rng.normal(0, 1, (40, 16))
    v = np.floor((centre[np.arange(4000) % 40] + rng.normal(0, 0.02, (4000, 16))) * 1024).astype(np.int64)
    tree = balltree.build(np.arange(4000), v)
    seen = []
    real, balltree.products = balltree.products, lambda q, x, y: seen.append(len(q) * len(x)) or real(q, x, y)
    try:
        s, i = np.full((20, 5), balltree.NO_SCORE), np.full((20, 5), balltree.NO_ID)
        balltree.search(tree, np.arange(20), v[:20], s, i)
    finally:
        balltree.products = real
    want = np.sort(v[:20] @ v.T - np.where(np.eye(20, 4000, dtype=bool), 10**12, 0), axis=1)[:, ::-1][:, :5]
    assert (s == want).all() and sum(seen) < 0.6 * 20 * 4000
    big = np.array([[2**30, -(2**30)]])
    assert balltree.products(big, big)[0, 0] == 2 * 2**60


def test_large_components(spark):
    """Components and products beyond 31 and 53 bits are exact; beyond 62 bits the query stops."""
    assert balltree.build(np.arange(1), np.array([[3_000_000_000]]))["vectors"][0, 0] == 3_000_000_000
    with pytest.raises(OverflowError):
        balltree.products(np.array([[2**33]]), np.array([[2**31 - 1]]))
    q, v = np.array([[2**33, 2**33]]), np.array([[2**31 - 1, -(2**31 - 5)]])
    assert balltree.products(q, v)[0, 0] == 2**33 * 4
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(x) for x in rng.normal(0, s, 3)]) for i, s in enumerate(np.geomspace(1e-3, 4e5, 300))]
    rows += [(400, [2929687.5, 0.0, 1.0]), (401, [2**20 + 0.5, -3.0, 2.0])]
    items = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in balltree.top_k(items, items.filter("vec_id % 20 = 0"), shard_rows=60).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    real = {i: [math.floor(x * 1024) for x in v] for i, v in rows}
    for q in (i for i in real if i % 20 == 0):
        best = sorted((-sum(x * y for x, y in zip(real[q], v, strict=True)), i) for i, v in real.items() if i != q)[:10]
        assert got[q] == [(i, -s) for s, i in best]
    with pytest.raises(Exception, match="62 bits"):
        far = spark.createDataFrame([(0, [1e17]), (1, [1.0])], "vec_id long, embedding array<double>")
        balltree.top_k(far, far).count()


def test_every_language_is_learned(spark, make_docs):
    """More languages than any fixed number, most with one text."""
    names = [f"l{k:03d}" for k in range(130)]
    rows = [(k, f"{chr(0x4E00 + 40 * (k % 130))}{chr(0x4E01 + 40 * (k % 130))} " * 20, names[k % 130]) for k in range(180)]
    model = langid.train(make_docs(rows + [rows[3], (None, "x", "zz"), (5, "other", "l005")]), max_texts=260)
    assert model.langs == names and model.out.shape[0] == 130
    got = langid.predict(make_docs(rows), model).collect()
    assert len(got) == 180 and {r["lang_pred"] for r in got} <= set(names)


def test_language_scores_position_by_position():
    """A byte at a time in plain Python, from the model's tables."""
    rng = np.random.default_rng(3)
    m = langid._start(["a", "b", "c"], 4, rng)
    cases = ["", "x", "héllo wörld " * 3, "z" * 255, "ab" * 128, "long text, " * 120, "日本語 " * 50]

    def read(d, data):
        h, out = np.zeros(4), [None] * len(data)
        for t in range(len(data)) if d == 0 else range(len(data) - 1, -1, -1):
            rec, inp = m.cycle[d].astype(float) @ h, m.table[d][:, data[t]].astype(float)
            gate = [min(max(x, 0), 1) for x in inp[:8] + rec[:8]]
            for j in range(4):
                c = min(max(inp[8 + j] + gate[4 + j] * rec[8 + j], -1), 1)
                h[j] += gate[j] * (c - h[j])
            out[t] = h.copy()
        return out

    got = langid.probabilities(m, pa.array(cases))
    for text, p in zip(cases, got, strict=True):
        raw, total = text.encode(), np.zeros(3)
        for a in range(0, len(raw), langid.WINDOW):
            window = raw[a:a + langid.WINDOW]
            for f, b in zip(read(0, window), read(1, window), strict=True):
                z = np.exp(m.out.astype(float) @ np.concatenate([f, b]) + m.bias)
                total += z / z.sum()
        assert np.allclose(p, total / max(len(raw), 1), atol=1e-4)


def test_language_of_held_out_texts(spark, make_docs):
    kinds = {"en": "thing of the and other", "de": "schön und über ein ich", "fr": "été où de la même", None: "zzz"}
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(kinds[k].split()) for _ in range(rng.randint(8, 300))), k)
            for i, k in enumerate(rng.choice(["en", "de", "fr"]) for _ in range(240))]
    rows += [(900, None, "en"), (901, "", "de"), (902, "12 34 !!", "fr"), (903, "of the thing " * 3000, None)]
    docs = make_docs(rows).withColumn("score", F.lit("clash"))
    held = docs.withColumn("held", toxicity.fold(F.col("doc_id"), 5) == 0)
    model = langid.train(held.filter(~F.col("held")), max_per_lang=60)
    assert model.langs == ["de", "en", "fr"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs.drop("lang"), model).collect()}
    assert all(got[i] == ("und", 0.0) for i in (900, 901, 902)) and got[903][0] == "en"
    test = [(i, k) for i, _, k in rows[:240] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i][0] == k for i, k in test]) > 0.95
    assert all(0 <= s <= 1 for _, s in got.values())
    assert langid.train(docs.filter("lang is null")) is None
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.predict(make_docs([]), model).count() == 0


def test_gru_gradient_and_fast_path():
    rng = np.random.default_rng(2)
    m = langid._start(["a", "b", "c"], 3, rng)
    for p in ("table", "cycle", "out", "bias"):
        setattr(m, p, getattr(m, p).astype(np.float64))
    x = rng.integers(0, 256, (6, 5)).astype(np.uint8)
    mask = np.ones((6, 5))
    mask[4:, 1] = 0
    y = np.array([0, 1, 2, 0, 1])
    _, grads = langid.gradients(m, x, mask, y)
    for p, g in zip((m.cycle, m.out, m.bias), grads[1:], strict=True):
        at = tuple(rng.integers(0, s) for s in p.shape)
        p[at] += 1e-3
        up = langid.gradients(m, x, mask, y)[0]
        p[at] -= 2e-3
        down = langid.gradients(m, x, mask, y)[0]
        p[at] += 1e-3
        assert g[at] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-3)
    text = pa.array(["abc" * 200, "", "x", None])
    p = langid.probabilities(langid._start(["a", "b"], 4, rng), text)
    assert p.shape == (4, 2) and np.allclose(p[[0, 2]].sum(axis=1), 1, atol=1e-4) and not p[[1, 3]].any()


def brute_repeats(rows, length):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[k:k + length] for k in range(len(b) - length + 1))
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        cover = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            if count[b[k:k + length]] > 1:
                cover[k] += 1
                cover[k + length] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[i] = (len(b), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [suffixes.HOT, 2])
def test_repeats(spark, make_docs, hot):
    rng = random.Random(6)
    unit = texts(3, seed=7, words=30)
    rows = [(i, t) for i, t in enumerate(texts(25, seed=8, words=40))]
    rows += [(100 + i, texts(1, seed=50 + i, words=20)[0] + rng.choice(unit) + "é" * rng.randint(0, 3)) for i in range(20)]
    rows += [(200, "ab" * 60), (201, "x" * 50), (202, None), (203, ""), (204, unit[0]), (205, unit[0]), (206, "é" * 33),
             (207, texts(1, seed=99, words=20)[0][:40] * 2)]
    want = brute_repeats(rows, 40)
    docs = make_docs(rows).withColumn("n", F.lit(0)).withColumn("at", F.lit(0))
    got = suffixes.remove_repeats(docs, length=40, hot=hot).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want
    assert all(hashlib.sha256(bytes(r["text"])).hexdigest() == r["kept_sha256"] for r in got)


def test_repeats_with_null_and_shared_ids(spark, make_docs):
    """Every row has a result of its own text, whatever its id is."""
    a, b, c = texts(3, seed=21, words=90)
    block = " ".join(texts(2, seed=22, words=90))
    rows = [(None, a + block), (None, b), (7, c + block + a[:5]), (7, "short"), (None, None), (8, b), (9, "x " * 5)]
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"])
                  for r in suffixes.remove_repeats(make_docs(rows), length=40).collect())
    want = brute_repeats(list(enumerate(t for _, t in rows)), 40)
    assert got == Counter((i, want[k][0], want[k][1], want[k][3]) for k, (i, _) in enumerate(rows))


def test_repeats_of_nothing(spark, make_docs):
    assert suffixes.remove_repeats(make_docs([])).count() == 0
    got = suffixes.remove_repeats(make_docs([(1, "a" * 500), (1, "a" * 500), (2, "short")])).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(1, 500), (1, 500), (2, 0)]


def test_multikey_sort():
    rng = np.random.default_rng(0)
    rows = rng.integers(97, 99, (300, 24)).astype(np.uint8)
    order = suffixes.multikey_sort(rows)
    raw = [bytes(r) for r in rows]
    assert [raw[i] for i in order] == sorted(raw)


def test_toxicity_held_out(spark, make_docs):
    rng = random.Random(12)
    plain = texts(500, seed=20, words=200)
    rows = [(i, t + (" " + rng.choice(["zoxious", "zoxling", "Zoxen"]) + " " + plain[i - 1][:50] if i % 5 == 0 else ""))
            for i, t in enumerate(plain)]
    docs = make_docs(rows + [(900, None), (901, "")]).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(500)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels.filter(toxicity.fold(F.col("doc_id"), 4) != 2))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i] >= 0.3) == (i % 5 == 0) for i in held]) > 0.97
    assert got[900] == got[901] == pytest.approx(1 / (1 + np.exp(-model.intercept)))
    none = toxicity.train(docs, labels.limit(0))
    assert max(r["score"] for r in toxicity.score(docs, none).collect()) < 1e-6
    assert toxicity.score(make_docs([]), model).count() == 0


def test_toxicity_scores_from_the_table():
    """One n-gram at a time in plain Python, from the model's weights."""
    rng = np.random.default_rng(5)
    model = toxicity.Model(rng.normal(0, 0.05, 1 << toxicity.BITS).astype(np.float32), -0.7)
    model.weights[rng.random(1 << toxicity.BITS) < 0.5] = 0
    cases = ["", None, "a", "Toxic\tText", "toxic text", "éÉ ab " * 30, "x" * 2000] + texts(20, seed=3)

    def buckets(raw):
        low = [32 if c in b" \t\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in b" " + raw]
        found = set()
        for n in toxicity.ORDERS:
            for at in range(len(low) - n + 1):
                h = (low[at] * 0x01000193 + 1) % 2**32
                for k in range(2, n + 1):
                    h = (h * 0x9E3779B1 + low[at + k - 1] + k) % 2**32
                found.add((n, ((h ^ h >> 15) * 0x85EBCA77 % 2**32) >> (32 - toxicity.BITS)))
        return {b for _, b in found}

    got = toxicity.score_texts(pa.array(cases), model, model.weights != 0)
    for text, p in zip(cases, got, strict=True):
        z = model.intercept + sum(float(model.weights[b]) for b in buckets((text or "").encode()))
        assert p == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-6)


def test_registered_queries(spark):
    """Whole tables, the contracts' columns, one row per document."""
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    columns = {
        "op1_": ["doc_id", "n_shingles", "component_id", "kept"], "op6_": ["doc_id", *linecrf.RULE_COLUMNS, "base_failed", "kept"],
        "op8_": ["doc_id", "held_out", "lang_pred", "score"], "op9_": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op10_": ["doc_id", "held_out", "score", "predicted"]}
    for start, want in columns.items():
        name = next(q for q in queries.QUERIES if q.startswith(start))
        out = queries.QUERIES[name](spark, SF)
        assert set(want) <= set(out.columns)
        assert out.count() == out.select("doc_id").distinct().count() == n
