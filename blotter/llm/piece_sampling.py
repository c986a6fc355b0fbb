"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

The segmentations of a text form a lattice of pieces. Forward filtering sums the
weight of all segmentations up to each position; backward sampling draws the
last piece in proportion to its share of that sum, then the one before, and so
on: an exact draw from all segmentations. A piece of rank r in the model has
weight (r + 2) ** -alpha. Each draw takes its random number from the row's key,
the seed and the position, so a row's pieces are the same in every run, batch
and partitioning.

Pieces never reach from a non-space into a space, so the lattice splits into
units (spaces and the word after them); each task filters a distinct unit once and
draws for all its occurrences with numpy, a chunk of texts at a time.

A space is the model's U+2581. Characters without a piece of their own, a
literal U+2581 among them, are byte pieces. No space is added or merged, so
decoding gives back the very text. NULL gives NULL pieces, empty gives none.
Repeated rows with equal keys get equal pieces. One narrow pass, no shuffle; the
model's file is read once by the driver, its vocabulary is of fixed size.
"""

from __future__ import annotations

import math
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from blotter.llm.common import mix64, pick, slices, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SEED = 17
CHUNK_BYTES = 1 << 20
UNIT = re.compile(r" *[^ \n]+| +|\n")
KEY_BITS = 21
LATTICE_NODES = 2_000_000  # a task forgets its units beyond this many positions


_BASE = 0x9E3779B97F4A7C15
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _codes(points: np.ndarray) -> np.ndarray:
    return mix64(points.astype(np.uint64) + np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Vocabulary:
    """A SentencePiece model's pieces: hash of the text to id and log weight, id to bytes."""

    def __init__(self, path: str, alpha: float) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.bytes: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        pieces: dict[str, int] = {}
        for i in range(self.size):
            p = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.bytes.append(bytes([int(p[3:5], 16)]))
                continue
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes.append(b"")
                continue
            text = p.replace("▁", " ")
            self.bytes.append(text.encode())
            if re.search(r"[^ ] |\n.|.\n", text) is None:  # stays within a unit
                pieces[text] = i
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.longest = max(map(len, pieces))
        for text in list(pieces):  # beginnings, so that a search knows when to stop
            for k in range(1, len(text)):
                pieces.setdefault(text[:k], -1)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, _BASE, np.uint64)]))
            keys = np.array([(_codes(_points(t)) * powers[:len(t)]).sum() for t in pieces], np.uint64)
        by = np.argsort(keys)
        self.keys, self.ids = keys[by], np.array(list(pieces.values()), np.int32)[by]
        # where the keys with each beginning start: most beginnings have one key or none
        self.begin = np.searchsorted(self.keys, np.arange(1 << KEY_BITS, dtype=np.uint64) << np.uint64(64 - KEY_BITS)).astype(np.int32)
        self.deepest = int(np.bincount((self.keys >> np.uint64(64 - KEY_BITS)).astype(np.int64)).max())
        self.weights = -alpha * np.log(np.maximum(self.ids, 0) + 2.0)
        self.byte_weight = -alpha * math.log(self.size + 2)

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash among the keys, and whether it is there."""
        at = self.begin[(h >> np.uint64(64 - KEY_BITS)).astype(np.int64)]
        at[at == len(self.keys)] = 0
        known = self.keys[at] == h
        for _ in range(1, self.deepest):
            other = np.flatnonzero(~known)
            further = np.minimum(at[other] + 1, len(self.keys) - 1)
            hit = self.keys[further] == h[other]
            at[other] = further
            known[other] = hit
        return at, known

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class Lattices:
    """Filtered lattices of units. A node stands behind each character; it has its
    incoming pieces with their cumulative shares of the node's weight."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.spelled: dict[int, int] = {}   # characters of several byte pieces: ids beyond the vocabulary
        self.spelling: list[list[int]] = []
        self.up = self.down = np.ones(1, np.uint64)
        self.forget()

    def forget(self) -> None:
        self.ends: dict[str, int] = {}
        self.first = np.zeros(0, np.int64)
        self.share, self.back, self.piece = np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, CHUNK_BYTES)
            with np.errstate(over="ignore"):
                up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
                up[0] = down[0] = 1
                self.up, self.down = np.cumprod(up), np.cumprod(down)

    def _spell(self, point: int) -> tuple[int, float]:
        """Piece and weight of a character without a piece of its own."""
        raw = chr(point).encode("utf-8", "surrogatepass")
        if len(raw) == 1:
            return self.vocab.byte_ids[raw[0]], self.vocab.byte_weight
        if point not in self.spelled:
            self.spelled[point] = self.vocab.size + len(self.spelling)
            self.spelling.append([self.vocab.byte_ids[b] for b in raw])
        return self.spelled[point], self.vocab.byte_weight * len(raw)

    def _edges(self, points: np.ndarray, stop: np.ndarray):
        """All pieces found: (first character, length, piece, log weight) arrays."""
        v, n = self.vocab, len(points)
        self._powers(n + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_codes(points) * self.up[:n])])
        alive, found = np.arange(n), []
        for size in range(1, v.longest + 1):
            alive = alive[alive + size <= stop[alive]]
            with np.errstate(over="ignore"):
                h = (sums[alive + size] - sums[alive]) * self.down[alive]
            at, known = v.look_up(h)
            ids = np.where(known, v.ids[at], -1)
            if size == 1:
                bare = alive[ids < 0]
                kinds, which = np.unique(points[bare], return_inverse=True)
                spelt = [self._spell(p) for p in kinds.tolist()]
                found.append((bare, np.ones(len(bare), np.int32), np.array([p for p, _ in spelt], np.int32)[which],
                              np.array([w for _, w in spelt], np.float64)[which]))
            real = ids >= 0
            found.append((alive[real], np.full(int(real.sum()), size, np.int32), ids[real], v.weights[at[real]]))
            alive = alive[known]
            if not len(alive):
                break
        return [np.concatenate(x) for x in zip(*found)]

    def learn(self, units: list[str]) -> None:
        """Forward filtering of new units, position by position over all of them."""
        lengths = np.array([len(u) for u in units], np.int64)
        points = _points("".join(units))
        n, stops = len(points), np.cumsum(lengths)
        stop = np.repeat(stops, lengths)
        pos = np.arange(n) - np.repeat(stops - lengths, lengths)
        start, size, piece, weight = self._edges(points, stop)
        node = start + size - 1
        by = np.argsort((pos[node] * n + node) * (self.vocab.longest + 1) + self.vocab.longest - size)  # level, node, start
        start, size, piece, weight, node = start[by], size[by], piece[by], weight[by], node[by]
        opens = pos[start] == 0
        head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))  # first edge of each node
        level = pos[node[head]]
        total = np.zeros(n)  # log weight of all segmentations up to a node
        cuts = np.searchsorted(level, np.arange(int(level[-1]) + 2))
        for a, z in zip(cuts.tolist(), cuts[1:].tolist()):
            e = slice(head[a], head[z] if z < len(head) else len(node))
            val = weight[e] + np.where(opens[e], 0.0, total[start[e] - 1])
            seg = head[a:z] - head[a]
            top = np.maximum.reduceat(val, seg)
            total[node[head[a:z]]] = top + np.log(np.add.reduceat(np.exp(val - np.repeat(top, np.diff(seg, append=len(val)))), seg))
        share = np.exp(weight + np.where(opens, 0.0, total[start - 1]) - total[node])
        by = np.argsort(node, kind="stable")
        share, size, piece, node = share[by], size[by], piece[by], node[by]
        head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        widths = np.diff(head, append=len(node))
        for k in range(1, int(widths.max())):  # running sums within a node
            at = head[widths > k] + k
            share[at] += share[at - 1]
        share[head + widths - 1] = 1.0
        base = len(self.first)
        self.first = np.concatenate([self.first, head + len(self.share)])
        self.share, self.back = np.concatenate([self.share, share]), np.concatenate([self.back, size])
        self.piece = np.concatenate([self.piece, piece])
        self.ends.update(zip(units, (stops - 1 + base).tolist()))

    def sample(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward sampling: (pieces of all texts in order, number of pieces of each text)."""
        units = [UNIT.findall(t) for t in texts]
        flat = list(chain.from_iterable(units))
        new = list(set(flat).difference(self.ends))
        if new:
            self.learn(new)
        node = np.fromiter(map(self.ends.__getitem__, flat), np.int64, len(flat))
        left = np.fromiter(map(len, flat), np.int32, len(flat))
        bounds = np.cumsum([0] + [len(t) for t in texts])
        at = np.cumsum(left, dtype=np.int64)  # units cover the texts without a gap
        row = np.repeat(np.arange(len(texts)), [len(us) for us in units])
        with np.errstate(over="ignore"):
            seed = keys[row] - bounds[row].astype(np.uint64) * _GOLD
        out = np.full(int(bounds[-1]), -1, np.int32)  # at each piece's last character
        while len(node):
            with np.errstate(over="ignore"):
                h = mix64(seed + at.astype(np.uint64) * _GOLD)
            u = ((h >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0 ** -53
            edge = self.first[node]
            todo = np.flatnonzero(self.share[edge] < u)
            while len(todo):
                edge[todo] += 1
                todo = todo[self.share[edge[todo]] < u[todo]]
            step = self.back[edge]
            out[at - 1] = self.piece[edge]
            left = left - step
            go = left > 0
            node, at, left, seed = (node - step)[go], (at - step)[go], left[go], seed[go]
        last = np.flatnonzero(out >= 0)
        ids = out[last]
        counts = np.diff(np.searchsorted(last, bounds))
        if len(self.spelling) and (spelt := np.flatnonzero(ids >= self.vocab.size)).size:
            words = [self.spelling[i - self.vocab.size] for i in ids[spelt].tolist()]
            times = np.ones(len(ids), np.int64)
            times[spelt] = [len(w) for w in words]
            starts = np.concatenate([[0], np.cumsum(times)])
            rows = np.concatenate([[0], np.cumsum(counts)])
            ids = np.repeat(ids, times)
            for s, w in zip(starts[spelt].tolist(), words):
                ids[s:s + len(w)] = w
            counts = np.diff(starts[rows])
        return ids, counts


def _encode(vocab: Vocabulary):
    def run(batches):
        lattices = Lattices(vocab)
        for b in batches:
            names = [c for c in b.schema.names if c not in ("raw", "key")]
            raws = b.column("raw").to_pylist()
            keys = mix64(b.column("key").to_numpy().view(np.uint64))
            for a, z in slices(np.array([len(r or b"") for r in raws], np.int64), CHUNK_BYTES):
                texts = [(r or b"").decode("utf-8", "surrogatepass") for r in raws[a:z]]
                if len(lattices.first) > LATTICE_NODES:
                    lattices.forget()
                ids, counts = lattices.sample(texts, keys[a:z])
                ends = np.concatenate([[0], np.cumsum(counts)])
                plain = ids.tolist()
                # one comparison for all; text by text only to find those that differ
                pieces, said = list(map(vocab.bytes.__getitem__, plain)), [r or b"" for r in raws[a:z]]
                sizes = np.cumsum([0, *map(len, said)])[1:]
                spelt = np.concatenate([[0], np.cumsum(vocab.lengths[ids])])[ends[1:]]
                if b"".join(pieces) == b"".join(said) and (spelt == sizes).all():
                    same = [True] * len(said)
                else:
                    same = [b"".join(pieces[s:e]) == r for s, e, r in zip(ends.tolist(), ends[1:].tolist(), said)]
                null = np.array([r is None for r in raws[a:z]])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids), mask=pa.array(null))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(a, z - a) for c in names), pa.array(counts.astype(np.int64)), lists, pa.array(same)],
                    names=[*names, "n_pieces", "piece_ids", "lossless"])
    return run


def encode_pieces(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", model: str = MODEL,
                  alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """All columns but the text's, and n_pieces, piece_ids and lossless (decoding gave the text)."""
    rest = [c for c in docs.columns if c != text_col]
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text_col}`").cast("binary").alias("raw"),
                       F.xxhash64(F.lit(seed), F.col(f"`{key_col}`")).alias("key"))
    schema = rows.drop("raw", "key").schema.add("n_pieces", "long").add("piece_ids", T.ArrayType(T.IntegerType())).add("lossless", "boolean")
    return rows.mapInArrow(_encode(Vocabulary(model, alpha)), schema)


def decode_pieces(encoded: DataFrame, ids_col: str = "piece_ids", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``encoded`` with its pieces' text in place of ``ids_col``; NULL pieces give NULL."""
    vocab = Vocabulary(model, ALPHA)

    def run(batches):
        for b in batches:
            texts = [None if ids is None else vocab.decode(ids) for ids in b.column(ids_col).to_pylist()]
            rest = [c for c in b.schema.names if c != ids_col]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(texts, pa.binary())], names=[*rest, text_col])

    rows = encoded.drop(text_col)
    schema = rows.drop(ids_col).schema.add(text_col, "binary")
    return rows.mapInArrow(run, schema).withColumn(text_col, F.col(text_col).cast("string"))


def op5_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text"))
