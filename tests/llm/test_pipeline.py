import os
import subprocess
import sys

import corpus_pipeline
from tests.conftest import ROOT, SF_SMALL
from tests.llm.data import TEXTS, components, edge_docs, empty_docs

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, docs, folder):
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_SMALL).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        yield name, docs


def test_edges(spark, scratch):
    docs = edge_docs(spark)
    seen = dict(stages(spark, docs, scratch))
    assert all(df.columns == docs.columns for name, df in seen.items() if name != "piece_sampling")
    one = {r["doc_id"] for r in seen["language_id"].collect()}
    assert {3, 4, 5, 10}.isdisjoint(one) and {1, 2, 6, 7, 8, 9} <= one
    texts = [(r["doc_id"], r["text"]) for r in seen["exact_dedup"].collect()]
    squeezed = ["".join(t.split()) for _, t in texts]
    assert len(set(squeezed)) == len(squeezed)
    left = [(r["doc_id"], r["text"]) for r in seen["jaccard_join"].collect()]
    want = components([(k, t) for k, (_, t) in enumerate(left)])
    assert len({c for _, c in want.values()}) == len(left) and 6 in dict(left) and 7 not in dict(left)
    mixed = seen["mix_sources"].collect()
    assert {(r["doc_id"], r["text"]) for r in mixed} <= set(left)
    assert all(r["lossless"] for r in seen["piece_sampling"].collect()) and seen["piece_sampling"].count() == len(mixed)


def test_empty(spark, scratch):
    assert all(df.count() == 0 for _, df in stages(spark, empty_docs(spark), scratch))


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "copy", "n_pieces", "piece_ids", "lossless"] and out.count() > 100
    # only the folder that the result is read from is left
    folder = os.path.dirname(os.path.dirname(out.inputFiles()[0].removeprefix("file:")))
    assert os.listdir(folder) == ["3-mix_sources"]


def test_copies_draw_their_own_pieces(spark):
    text = "a document that the mix takes more than once, with words enough to be cut in many ways " * 5
    docs = spark.createDataFrame([(1, text)] * 3 + [(2, text), (None, text), (None, text), (3, None)], "doc_id long, text string")
    rows = [corpus_pipeline.pieces(spark, docs.repartition(n), SF_SMALL).collect() for n in (1, 4)]
    assert sorted(map(str, rows[0])) == sorted(map(str, rows[1]))
    assert sorted((r["doc_id"] or 0, r["copy"]) for r in rows[0]) == [(0, 1), (0, 2), (1, 1), (1, 2), (1, 3), (2, 1), (3, 1)]
    drawn = {tuple(r["piece_ids"]) for r in rows[0] if r["doc_id"] != 3}
    assert len(drawn) == 6 and all(r["lossless"] for r in rows[0])


def test_entry_without_the_subpackage():
    code = ("import sys; sys.modules[{!r}] = None; import __spark_entry__ as e; q = e.queries(); "
            "assert 'calls_by_hour' in q and 'pipeline' not in q, q; assert 'op1_exact_dedup' not in e.oracle_sql() or {!r} != 'blotter.llm'")
    for name in ("blotter.llm", "corpus_pipeline"):
        subprocess.run([sys.executable, "-c", code.format(name, name)], cwd=ROOT, check=True, timeout=120)


def test_registered():
    import __spark_entry__ as e

    names = list(e.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert len(TEXTS) == 16
