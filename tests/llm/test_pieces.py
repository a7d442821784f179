"""Piece encoding and decoding against the library and the merge law."""
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from spendstar.llm import pieces, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    path = queries.piece_model_path()
    return path, pieces.Vocabulary(path), sentencepiece.SentencePieceProcessor(model_file=path)


HARD = ["", " ", "   ", "\n", "\n\n x", "a", " a", "a ", "a  b   c", "▁", "▁x ▁", "x\x00y", "\x00", "�", "ﬁ Ａ", "é" * 50,
        "日本語テキスト", "🙂🙃 🙂", "<s> </s> <unk> <0x41>", "\t\t\tx", " " * 100, "a" + " " * 37 + "b", "\r\n\x85 ", "ab" * 300,
        "hello  world", "=" * 90, "0123456789" * 9, " x​", "é", "▁▁a b"]


def check(of, sp, texts):
    flat, n = of.encode(texts)
    cuts = np.concatenate([[0], np.cumsum(n)])
    for t, a, b in zip(texts, cuts[:-1], cuts[1:], strict=True):
        want = sp.encode(t, add_eos=True)
        assert flat[a:b].tolist() == want, t[:60]
        assert of.decode(flat[a:b]) == sp.decode(want), t[:60]


def test_encoding_equals_the_library(model):
    _, of, sp = model
    check(of, sp, HARD)
    rng = random.Random(5)
    plain = [p for p in of.text if p and not p.startswith("<")]
    some = ["".join(rng.choice(plain) for _ in range(rng.randint(1, 40))).replace("▁", " ") for _ in range(1500)]
    letters = ["".join(rng.choice("abcdehinorstu  ") for _ in range(rng.randint(1, 200))) for _ in range(500)]
    odd = ["".join(chr(rng.choice([32, 97, 10, 0x2581, 0xE9, 0x4E2D, 0x1F642, 0x301, 9, 0x10FFFF, 0])) for _ in range(30)) for _ in range(300)]
    check(of, sp, some + letters + odd)
    of.clear()
    check(of, sp, ["".join(rng.choice("abcdefgh▁") for _ in range(60_000)), "x" * 30_000, HARD[3]])


def test_backtracking_equals_the_merge_law(model):
    """The merge law over whole stretches, without backtracking."""
    _, of, _ = model
    rng = random.Random(6)
    for _ in range(400):
        t = "▁" * rng.randint(0, 3) + "".join(rng.choice("tionsaermgh") for _ in range(rng.randint(1, 40)))
        assert of.backtrack(t) == of.merged(t)
    assert of.backtrack("▁" * 40) == of.merged("▁" * 40) and of.backtrack("") == []


def test_decode_of_any_ids(model):
    _, of, sp = model
    rng = random.Random(7)
    byte = [i for i in range(sp.vocab_size()) if sp.is_byte(i)]
    all_ = [[rng.choice(byte) if rng.random() < 0.6 else rng.randrange(sp.vocab_size()) for _ in range(rng.randint(0, 20))]
            for _ in range(800)]
    all_ += [[2, 1, sp.piece_to_id("▁a")], [1], [2, 2], [0, sp.piece_to_id("▁")], [sp.piece_to_id("▁▁"), sp.piece_to_id("▁")]]
    for ids in all_:
        assert of.decode(np.array(ids, np.int64)) == sp.decode(ids), ids
    assert of.decode_all(np.concatenate([np.array(x, np.int64) for x in all_]), np.array([len(x) for x in all_])) == [
        sp.decode(x) for x in all_]


def test_small_tables_stay_bounded(model, monkeypatch):
    _, _, sp = model
    monkeypatch.setattr(pieces, "CACHE_BYTES", 3000)
    monkeypatch.setattr(pieces, "PAIRS", 50)
    of = pieces.Vocabulary(queries.piece_model_path())
    for seed in range(30):
        rng = random.Random(seed)
        check(of, sp, ["".join(rng.choice("abcdefg \n") for _ in range(300)) for _ in range(4)])
        assert of.n_pairs == sum(map(len, of.pairs.values())) and of.held < 3000 + pieces.ENTRY_BYTES * 2400 + 4 * 4 * 300


def test_frames(spark, model, make_docs):
    path, _, sp = model
    rows = [(k, t) for k, t in enumerate(HARD)] + [(None, None), (3, None), (3, "same"), (3, "same"), (None, "z " * 300_000)]
    docs = make_docs(rows).withColumns({"ids": F.lit("clash"), "decoded": F.lit(1), "more": F.lit(2)})
    got = pieces.encode(docs, path, decoded_col="decoded")
    assert got.columns == ["doc_id", "text", "lang", "source", "more", "ids", "decoded"]
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in got.collect()) == sorted(
        (str(i), sp.encode(t or "", add_eos=True), sp.decode(sp.encode(t or ""))) for i, t in rows)
    assert all(r["ids"] == sp.encode(r["text"] or "") for r in pieces.encode(docs, path, end=False).collect())
    back = pieces.decode(got.select("doc_id", "ids", F.lit("clash").alias("text")), path)
    assert sorted(r["text"] for r in back.collect()) == sorted(sp.decode(sp.encode(t or "")) for _, t in rows)
    assert pieces.decode(got.select(F.lit(None).cast("array<int>").alias("ids")).limit(1), path).first()["text"] is None
    assert pieces.encode(make_docs([]), path).count() == 0


def test_query(spark, model):
    _, _, sp = model
    got = {r["doc_id"]: r for r in queries.op11_piece_encoding(spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in texts:
        ids = sp.encode(r["text"] or "", add_eos=True)
        g = got[r["doc_id"]]
        assert (g["n_tokens"], g["ids_sha256"], g["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids)))
