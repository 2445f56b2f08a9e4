"""The corpus pipeline on small tables: every stage's decisions take effect."""

import hashlib
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from helixspan.llm import bpe, mixing, neardup, pii, quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(3)
    docs, labels = [], []
    for i in range(500):
        words = [f"w{int(draw.paretovariate(0.5)) % 3000}" for _ in range(draw.randrange(40, 150))]
        if i % 5 == 0:
            words = [w + "$$$" for w in words]
        if i % 7 == 1:
            words[3:3] = f"some.{i}@mail.example.com +1 (017) 555-{i:04d}".split()
        docs.append((i, " ".join(words), "en", f"s{i % 3}", 0))
        labels.append((i, int(i % 5 != 0), 0))
    docs += [(1000 + i, docs[11][1], "en", "s1", 0) for i in range(80)]
    docs += [(2000 + i, docs[12][1] + f" end{i}", "en", "s2", 0) for i in range(80)]
    docs += [(3000, None, "en", None, 0)]
    path = tmp_path_factory.mktemp("corpus")
    for name, rows, ddl in (("documents", docs, DOCS), ("labels", labels[::2], "doc_id long, quality int, toxic int")):
        spark.createDataFrame(rows, ddl).repartition(6).write.parquet(f"{path}/{name}.parquet")
    return str(path), docs


def test_stages_in_turn(spark, folder, tmp_path):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    before = {r[0]: r[1] for r in rows}
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs
    good = {r["doc_id"] for r in seen["quality"].collect()}
    bad = {i for i, t in before.items() if t and "$$$" in t}
    assert not good & bad and len(good) >= 0.95 * (len(before) - len(bad)) - 1
    unique = [r["doc_id"] for r in seen["near_copies"].collect()]
    assert len(unique) == len(set(unique)) and set(unique) <= good
    # One document of every group stays, and nothing else goes.
    assert len([i for i in unique if before[i] == before[11]]) == 1
    assert len([i for i in unique if i >= 2000 and i < 3000 or i == 12]) == 1
    alone = [i for i in good if i < 500 and i not in (11, 12)]
    assert set(alone) <= set(unique)
    clean = {r["doc_id"]: r["text"] for r in seen["personal_data"].collect()}
    assert set(clean) == set(unique)
    assert not any(t and re.search(r"@mail|555-", t) for t in clean.values())
    assert all(clean[i] == before[i] for i in clean if before[i] is None or "@" not in before[i])
    summary = mixing.mix_summary(seen["personal_data"]).collect()
    mixed = Counter(r["doc_id"] for r in seen["mixing"].collect())
    words = {i: len((t or "").split()) for i, t in clean.items()}
    assert {r["doc_id"]: r["taken"] for r in summary} == {i: mixed[i] * n for i, n in words.items()}
    tokens = seen["encoding"].collect()
    assert Counter(r["doc_id"] for r in tokens) == mixed
    for r in tokens:
        assert r["decoded_sha256"] == hashlib.sha256((clean[r["doc_id"]] or "").encode()).hexdigest()
        assert len(r["token_ids"]) == r["n_tokens"]


def test_run_is_the_stages(spark, folder):
    path, _ = folder
    got = corpus_pipeline.run(spark, path)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids"} == set(got.columns)
    assert got.count() > 300


def test_stages_call_their_operators(monkeypatch):
    called = []
    for module, name in ((quality, "keep_good"), (neardup, "deduplicate"), (pii, "mask"), (mixing, "mix"), (bpe, "token_table")):
        monkeypatch.setattr(module, name, lambda *a, n=name: called.append(n))
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: None)
    for _, stage in corpus_pipeline.STAGES:
        stage(None, None, "")
    assert called == ["keep_good", "deduplicate", "mask", "mix", "token_table"]


def test_empty_documents(spark, folder, tmp_path):
    path, _ = folder
    docs = spark.createDataFrame([], DOCS)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, path).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() == 0
