"""The pipeline's stages against their operators' brute-force versions, in order."""
import zlib
from collections import Counter

import corpus_pipeline as cp
import numpy as np
from pyspark.sql import functions as F

from spendstar.llm import mixing, queries

from .test_native import brute_lines
from .test_texts import brute_components

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "line dedup", "near dedup", "mixing", "packing"]
    tables = [docs]
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, tables[-1], SF).write.parquet(str(tmp_path / f"{k}"))
        tables.append(spark.read.parquet(str(tmp_path / f"{k}")))
        if k < 4:
            assert tables[-1].columns == docs.columns
    start, clean, lined, single, mixed, packed = ([r.asDict() for r in t.collect()] for t in tables)
    # toxicity: rows go whole or stay as they are
    predicted = {r["doc_id"]: r["predicted"] for r in queries.op10_nb_ngrams(spark, SF).collect()}
    assert sorted(r["doc_id"] for r in clean) == sorted(r["doc_id"] for r in start if not predicted[r["doc_id"]])
    want = brute_lines([(r["doc_id"], r["text"]) for r in clean], 10)
    import hashlib
    assert {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in lined} == {w[0]: w[3] for w in want}
    comps = brute_components([(r["doc_id"], r["text"]) for r in lined])
    assert sorted(r["doc_id"] for r in single) == sorted(i for i, (_, c) in comps.items() if i == c)
    copies = {r["doc_id"]: r["copies"] for r in mixing.with_copies(tables[3]).collect()}
    assert Counter(r["doc_id"] for r in mixed) == Counter({i: c for i, c in copies.items() if c})
    # packing: every token of every copy once
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.tokenizer_path())
    ids = {r["doc_id"]: tok.encode(r["text"] or "", add_special_tokens=False).ids + [1] for r in single}
    total = Counter()
    for r in packed:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        total[r["doc_id"]] += r["length"]
    assert total == Counter({i: copies[i] * len(ids[i]) for i in copies if copies[i]})


def test_stages_with_odd_rows(spark, tmp_path):
    """Nulls in every column, repeated rows, an extra column with a clashing name, and no rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, None, "en", None, 0), (10**6 + 1, "", None, "s", 0),
                                 (10**6 + 2, "a b\n" * 30, "en", "s", 1), (10**6 + 2, "a b\n" * 30, "en", "s", 1)], docs.schema)
    for k, rows in enumerate((docs.unionByName(odd), docs.limit(0))):
        now = rows.withColumn("size", F.lit("clash")).withColumn("kept", F.lit(0)).withColumn("score", F.lit(0.5))
        for j, (_, stage) in enumerate(cp.STAGES):
            out = stage(spark, now, SF)
            path = str(tmp_path / f"{k}-{j}")
            out.write.parquet(path)
            before, now = now, spark.read.parquet(path)
            if j < 4:
                assert set(docs.columns) <= set(now.columns)
            assert (now.count() == 0) == (before.count() == 0)
