import importlib

import numpy as np

import corpus_pipeline as C
from corpusloom.llm import near_text, packing


def test_stages_in_turn(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = docs.columns, {}
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, sf).cache()
        assert out.columns == columns, name
        counts[name] = (docs.count(), out.count())
        if name == "simhash_dedup":
            sets = [set(near_text.shingle_set(r.text).tolist()) for r in out.collect()]
            assert all(len(a & b) < 0.8 * len(a | b) for n, a in enumerate(sets) for b in sets[:n])
        docs = out
    assert counts["toxicity"][1] <= counts["toxicity"][0]
    assert counts["line_dedup"][0] == counts["line_dedup"][1]
    assert counts["simhash_dedup"][1] < counts["simhash_dedup"][0]
    packed = C.STAGES[-1][1](spark, docs, sf).collect()
    fill, kept = {}, {}
    for r in packed:
        assert len(r.ids) == 4 * r.length
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
        kept.setdefault((r.row_no, r.doc_id), {})[r.piece] = np.frombuffer(r.ids, "<u4").tolist()
    assert max(fill.values()) <= 2048
    # every mixed document, copies and parts included, can be put together again
    ids_of = packing.loaded(packing.tokenizer_path()).text
    whole = sorted((d, sum((p[k] for k in sorted(p)), [])) for (_, d), p in kept.items())
    assert whole == sorted((r.doc_id, [*np.frombuffer(ids_of(r.text or ""), "<u4").tolist(), 0]) for r in docs.collect())


def test_run(spark, sf):
    rows = C.run(spark, sf)
    assert rows.count() > 0 and len(C.STAGES) == 5


def test_edges(spark, weird, nothing, tmp_path):
    spark.createDataFrame([(3, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs, n in ((weird, 11), (nothing, 0)):
        for name, stage in C.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert (out.count() > 0) == (n > 0), name
            docs = out


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    names = [k for k in entry.queries() if k.startswith("op") and k[2].isdigit()]
    assert len(names) == 13 and entry.queries()["pipeline"] is C.run
