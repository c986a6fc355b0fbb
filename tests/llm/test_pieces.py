import math
from collections import Counter

import numpy as np
import sentencepiece

from blotter.llm.common import mix64
from blotter.llm.piece_sampling import MODEL, Lattices, Vocabulary, decode_pieces, encode_pieces
from tests.llm.data import TEXTS, edge_docs, empty_docs, multiset


def test_round_trip_and_edges(spark):
    got = encode_pieces(edge_docs(spark).select("doc_id", "text"))
    rows = got.collect()
    assert len(rows) == len(TEXTS) and all(r["lossless"] for r in rows)
    assert all((r["piece_ids"] is None and r["n_pieces"] == 0) or r["n_pieces"] == len(r["piece_ids"]) for r in rows)
    back = decode_pieces(got).select("doc_id", "text").collect()
    assert multiset(back) == multiset((i, t) for i, t, *_ in TEXTS)
    assert encode_pieces(empty_docs(spark).select("doc_id", "text")).count() == 0


def test_same_pieces_in_any_partitioning(spark):
    docs = edge_docs(spark).select("doc_id", "text")
    a = multiset(encode_pieces(docs.repartition(1)).collect())
    assert a == multiset(encode_pieces(docs.repartition(6)).collect())
    assert a != multiset(encode_pieces(docs, seed=5).collect())


def test_draws_follow_the_lattice():
    """Shares of all segmentations of a word against their exact weights."""
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = {model.id_to_piece(i).replace("▁", " "): i for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}

    def ways(s):
        if not s:
            yield (), 1.0
        for k in range(1, len(s) + 1):
            if s[:k] in pieces:
                for rest, w in ways(s[k:]):
                    yield (pieces[s[:k]], *rest), w / (pieces[s[:k]] + 2)

    n, word = 100_000, " theres"
    ids, counts = Lattices(Vocabulary(MODEL, 1.0)).sample([word] * n, mix64(np.arange(n).astype(np.uint64)))
    ends = np.concatenate([[0], np.cumsum(counts)])
    seen = Counter(tuple(ids[a:z].tolist()) for a, z in zip(ends, ends[1:]))
    want = dict(ways(word))
    total = sum(want.values())
    assert set(seen) <= set(want)
    for way, w in want.items():
        p = w / total
        assert abs(seen[way] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 2 / n
