"""The pipeline, stage by stage, against plain versions."""

import random
import re

import corpus_pipeline
import numpy as np
import pytest
from chunkscan.llm import toxicity
from chunkscan.llm.queries import ORACLES, QUERIES

from . import helpers as H


@pytest.fixture(autouse=True)
def small_model(monkeypatch):
    monkeypatch.setattr(toxicity, "LANDMARKS", 200)
    monkeypatch.setattr(toxicity, "POSITIVES", 400)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, rows = random.Random(5), H.documents(3)
    item = H.text(rng, 30)
    rows += [(len(rows) + k, f"{H.text(rng, 30)} {item} {H.text(rng, 10)}", "en", "s", 0, "k", 0) for k in range(2)]
    labels = []
    for k in range(120):
        words = H.text(rng, 30).split()
        if k % 3 == 0:
            words[4], words[20] = "nitwit", "dunce"
        rows.append((len(rows), " ".join(words), "en", "s", 0, "k", 0))
        labels.append((rows[-1][0], int(k % 3 == 0), 1))
    out = tmp_path_factory.mktemp("tables")
    H.frame(spark, rows).drop("key", "h").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out), rows, labels, item


def test_stages(spark, folder):
    path, rows, labels, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, texts = docs.columns, {r[0]: r[1] for r in rows}
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path).cache()
        assert docs.columns == columns
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    toxic, exact, near, clean = seen
    learn = [(i, y) for i, y, _ in labels if H.fold(i, 5) != 0]
    model = toxicity.train([texts[i] for i, _ in learn], np.array([y > 0 for _, y in learn]))
    assert toxic == {i for i, t in texts.items() if model.score(toxicity.tops(model, [toxicity.units(t or "")]))[0] < 0.5}
    assert not toxic & {i for i, y, _ in labels if y}
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    first: dict = {}
    for i in sorted(toxic):
        first.setdefault(norm(texts[i]), i)
    assert exact == set(first.values())
    assert near == {i for i, (_, c) in H.near([(i, texts[i]) for i in exact]).items() if i == c}
    hit = H.windows_hit([(i, texts[i]) for i in near], [(1, item)])
    assert clean == {i for i, (_, n, _) in hit.items() if not n} and clean != near


def test_run(spark, folder):
    path, *_ = folder
    out = corpus_pipeline.run(spark, path)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0


def test_rows_of_null_and_repeated_ids(spark, tmp_path):
    rng = random.Random(7)
    item, clean, other, copied = H.text(rng, 20), H.text(rng, 40), H.text(rng, 40), H.text(rng, 60)
    rows = [(None, "x"), (None, "x"), (None, "y"), (5, item), (5, clean), (6, other), (6, "z"), (-3, copied), (2, copied), (None, copied), (None, copied + " end"), (10, copied + " end")]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    told = lambda df: sorted(((r[0], r[1]) for r in df.collect()), key=str)
    want = [(None, "x"), (None, "y"), (5, item), (5, clean), (6, other), (6, "z"), (-3, copied), (10, copied + " end")]
    docs = corpus_pipeline.exact(spark, docs, str(tmp_path))
    assert told(docs) == sorted(want, key=str)
    docs = corpus_pipeline.near(spark, docs, str(tmp_path))
    assert told(docs) == sorted(want[:-1], key=str)
    docs = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert docs.columns == ["doc_id", "text"] and told(docs) == sorted((r for r in want[:-1] if r[1] != item), key=str)


def test_registry():
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == []
    assert set(ORACLES) <= set(QUERIES)
