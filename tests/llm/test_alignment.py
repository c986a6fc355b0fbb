import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from blotter.llm import token_alignment as ta
from tests.conftest import SF_SMALL
from tests.llm.data import TEXTS, edge_docs, empty_docs, multiset

ODD = ["tail ", " lead", "  ", " ", "a  b\n\n c \t d", "héllo 🤷x  日本語 𓀀𓀁 \t a", "a▁b", "x <|endoftext|> y </s> <0x41>", "é 日 𓀀 ̈ x",
       "\x00 a\x00 b", "a b\x1c d\x85 e", "_ _a __ ", "ﬁ Ａ ½ ²..", "日本語" * 40, "𓀀" * 50, "don't  we'll 've", "\n", "tab\tend\n next\n", "§ ° “q” –"]


@pytest.fixture(scope="module")
def both():
    return ta.Tokenizers(*ta._files(ta.BYTE_BPE, ta.PIECES))


def brute(texts):
    """Whole texts by both libraries, groups from the lengths of decoded bytes, all links one by one."""
    a_tok = Tokenizer.from_file(ta.BYTE_BPE)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=ta.PIECES)
    chars = ta.byte_level()
    docs = []
    for t in texts:
        groups, raw = [], (" " + (t or "")).encode()
        e = a_tok.encode(" " + t, add_special_tokens=False) if t else None
        a = [(i, bytes(chars[c] for c in a_tok.id_to_token(i))) for i in e.ids] if t else []
        b = [(i, bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode())
             for i in (b_tok.encode(t) if t else [])]
        if t and b"".join(x for _, x in a) == raw == b"".join(x for _, x in b):
            left, right, n, m = [], [], 0, 0
            a, b = a[::-1], b[::-1]
            while a or b:
                if n <= m:
                    i, x = a.pop()
                    left.append(i)
                    n += len(x)
                else:
                    i, x = b.pop()
                    right.append(i)
                    m += len(x)
                if n == m:
                    groups.append((left, right))
                    left, right = [], []
        docs.append(groups)
    held = Counter()
    for groups in docs:
        held.update({(x, y) for left, right in groups for x in left for y in right})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    for groups in docs:
        links = [(x, y) for left, right in groups for x in left for y in right]
        said = ";".join(f"{','.join(map(str, left))}|{','.join(map(str, right))}" for left, right in groups)
        yield (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
               sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if groups else "")


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def held_against_brute(rows, df):
    got = df.select(*COLUMNS).collect()
    assert multiset(got) == multiset((i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows])))


def test_query_against_whole_texts(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    held_against_brute([tuple(r) for r in rows], ta.op13_token_alignment(spark, SF_SMALL))


def test_edges(spark):
    held_against_brute([(i, t) for i, t, *_ in TEXTS], ta.align_tokens(edge_docs(spark)))
    assert ta.align_tokens(empty_docs(spark)).count() == 0


def test_odd_texts_in_small_chunks(spark, monkeypatch):
    rows = [(str(k), t) for k, t in enumerate(ODD + ODD[3:9])]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    held_against_brute(rows, ta.align_tokens(docs))
    monkeypatch.setattr(ta, "CHUNK_PAIRS", 5)
    monkeypatch.setattr(ta, "CACHE_CHARS", 20)
    monkeypatch.setattr(ta, "SLICE_BYTES", 16)
    monkeypatch.setattr(ta, "JOIN_CHARS", 30)
    monkeypatch.setattr(ta, "WIDE", 1)
    held_against_brute(rows, ta.align_tokens(docs.repartition(2)))


def test_units_give_what_whole_texts_give(both):
    for text in ODD:
        units = ta.units_of(text)
        assert " ".join(units) == text
        whole, parts = next(both.encode([text])), list(both.encode(units))
        assert (whole is None) == any(p is None for p in parts)
        if whole:
            assert [i for p in parts for i in p[0].tolist()] == whole[0].tolist()
            assert [i for p in parts for i in p[2].tolist()] == whole[2].tolist()


def test_spans_give_the_texts_bytes(spark, both):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(100, None), (101, "")]
    got = ta.token_spans(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    digests = {r["doc_id"]: r for r in ta.align_tokens(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for (k, t), r in zip(rows, got):
        raw = (" " + (t or "")).encode()
        for g in r["groups"]:
            assert b"".join(both.a_bytes[i] for i in g["a"]) == raw[g["start"]:g["stop"]] == b"".join(both.b_bytes[i] for i in g["b"])
        if r["groups"]:
            assert [g["start"] for g in r["groups"]] == [0] + [g["stop"] for g in r["groups"]][:-1] and r["groups"][-1]["stop"] == len(raw)
        assert len(r["groups"]) == digests[k]["n_groups"]


def test_hot_pair_and_long_text(spark):
    rows = [(i, "the same words") for i in range(300)] + [(300, "word " * 60_000), (301, "x" * 100_000)]
    got = {r["doc_id"]: r for r in ta.align_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got[0]["count_sum"] == got[299]["count_sum"] == 900
    assert got[300]["n_groups"] >= 60_000 and got[301]["n_a"] > 0 and len(got) == 302


def test_batches_are_cut_into_distinct_units():
    texts = pa.array(["skipped", None, "", "a b a", "x” b  c ", " ", "é, x” b", "tail "]).slice(1)
    units, place, counts = ta.units_in(texts)
    assert len(set(units)) == len(units) and counts.tolist() == [0, 0, 3, 2, 1, 2, 1]
    assert [units[k] for k in place.tolist()] == ["a", "b", "a", "x” b", " c ", " ", "é,", "x” b", "tail "]
    assert ta.units_in(pa.array([None, ""], pa.string()))[2].tolist() == [0, 0]


def test_often_met_units_stay_known_when_room_is_made(both, monkeypatch):
    monkeypatch.setattr(ta, "CACHE_CHARS", 60)
    known, fresh = ta.Aligner(both), ta.Aligner(both)
    words = ["often,", "once", "a▁b", "日本語", "twice\nword"]
    known.seen.flat[known.look_up(words)] += [4, 1, 2, 2, 3]
    known.trim()
    assert list(known.number) == ["often,", "a▁b", "日本語", "twice\nword"] and known.held == 7 + 4 + 4 + 11
    learned = []
    monkeypatch.setattr(ta.Aligner, "_learn", lambda self, units, plain=ta.Aligner._learn: (learned.append(list(units)), plain(self, units)))
    for one in (known, fresh):
        one.found = one.look_up(words)
    assert learned == [["once"], words]
    for x, y in zip(known.found, fresh.found):
        rows = [one.rows_of(np.array([k])) for one, k in ((known, x), (fresh, y))]
        pairs = [{list(one.pair_number)[p]: n for p, n in zip(one.pairs.flat[i[0]:i[0] + n[0]].tolist(), one.times.flat[i[0]:i[0] + n[0]].tolist())}
                 for one, (i, n) in zip((known, fresh), rows)]
        assert known.texts[x] == fresh.texts[y] and known.sums.flat[x].tolist() == fresh.sums.flat[y].tolist() and pairs[0] == pairs[1]
