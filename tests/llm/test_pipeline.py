import numpy as np

import corpus_pipeline as cp
from tillroll.llm import sentencepiece_unigram as sp

from . import test_decontamination as dc
from . import test_jaccard_join as jj
from . import test_quality_rules as qr
from . import test_secret_scan as ss
from .cases import PROSE, docs, empty, table


def brute(spark, sf_dir):
    """The pipeline on plain Python rows (few labels: no cutoff is certified, so the base rules alone decide)."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = [(i, t) for i, t in rows if not qr.brute(t)[-1]]
    first = {(i, c) for i, _, c in jj.brute(rows)}
    rows = sorted({(i, t) for i, t in rows if i is not None and (i, i) in first}) + [r for r in rows if r[0] is None]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {i for i, _ in dc.brute(rows, items)}
    rows = [(i, t) for i, t in rows if i not in leaks]
    out = {}
    for i, t in rows:
        done, at = "", 0
        for a, _, b in ss.brute(t):
            done, at = (done + t[at:a] + "[SECRET]" if a >= at else done), max(at, b)
        out[i] = done + t[at:]
    return out


def test_run_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    want = brute(spark, sf)
    got = cp.run(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    p = sp.Pieces.load()
    for r in got:
        data, at = sp.decode_slice(p, np.array(r.ids, np.int64), np.array([0, len(r.ids)]))
        assert data.tobytes().decode() == want[r.doc_id] and r.lossless and len(at) == 2


def test_stages_take_awkward_rows(spark, tmp_path):
    sf = str(tmp_path)
    long = " ".join(f"term{i}" for i in range(60))
    rows = [(1, long, "en"), (1, long, "en"), (2, long + " more", "en"), (None, long, "fr"), (None, None, None), (3, PROSE * 3, "en"), (4, "token=abcdefghij " + long[::-1], "de"), (5, "", "en")]
    df = docs(spark, rows)
    spark.createDataFrame([(1, 1, 0), (None, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, PROSE), (2, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, df, sf)
        assert out.columns == df.columns, name
        assert stage(spark, empty(spark), sf).collect() == []
    kept = cp.near_copies(spark, df, sf).collect()
    assert sorted(str(r.doc_id) for r in kept if r.doc_id != 5) == ["1", "3", "4", "None", "None"]
    assert cp.decontaminate(spark, df, sf).where("doc_id = 3").count() == 0
    assert "[SECRET]" in cp.secrets(spark, df, sf).where("doc_id = 4").first().text
    assert cp.pieces(spark, df, sf).count() == len(rows)


def test_stage_names_and_tables(spark):
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "ngram_jaccard_join", "decontamination", "secret_scan", "sentencepiece"]
    assert table(spark, "documents").count() > 0
