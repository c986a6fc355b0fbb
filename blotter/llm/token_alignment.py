"""Cross-tokenizer alignment of two subword tokenizers by their spans.

Tokenizer A is a byte-level BPE of ``tokenizers``, B a SentencePiece model. Both
read " " + text (B adds that space itself). Byte offsets at which a token of A and one
of B both end cut the text into groups; all A and B tokens of a group are linked.

Spans give the coarse cuts: A's character offsets turned into bytes, and the
piece spans of B's proto. A token of A that stops inside a multibyte character
(the next one starts before its end) and byte-fallback pieces of B, which have
no span of their own, are placed by the bytes they decode to.

No token of either kind reaches from a letter, digit or ASCII sign into the space behind
it, so texts are cut there into units, and each task aligns a distinct unit
once. A unit that does not decode to its own bytes in both tokenizers (a
literal U+2581, say) leaves its whole text without tokens. Units met more than once
stay known when a task makes room for new ones.

How often an id pair is linked is a count of documents over the whole corpus:

1. One pass over the texts leaves a narrow row per document, with its distinct
   pairs as compressed positions in the table of its chunk (``CHUNK_PAIRS`` pairs
   of documents at most, one long document may have more), and that table once per chunk.
   It is checkpointed, so a lost executor costs files that are still there.
2. Chunks send each of their pairs once, with the number of documents; the sums
   and the highest count of each A id (one row per vocabulary entry at most, so it is
   broadcast) go back to the chunks, which finish their documents.

A hot pair is one row per chunk, however many documents hold it. A NULL or empty text
has no tokens; repeated rows count each; an empty table gives an empty result. A
task holds one chunk and at most ``CACHE_CHARS`` characters of known units; a unit
(text without a space behind a letter) is held whole.
"""

from __future__ import annotations

import gc
import hashlib
import os
from itertools import pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from blotter.llm.common import pick, settle, slices, table

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
SLICE_BYTES = 1 << 20
CHUNK_PAIRS = 2_000_000
CACHE_CHARS = 6_000_000
JOIN_CHARS = 16_000
WIDE = 16  # tokens on both sides from which a group's links are counted by distinct ids


def byte_level() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: printable bytes stand for themselves, the
    others take the characters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, from the contents of their files, and what every id decodes to."""

    def __init__(self, a_json: str, b_model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        to_byte = byte_level()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(map(to_byte.get, token)) if all(c in to_byte for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        size = self.b.get_piece_size()
        self.b_is_byte = np.array([self.b.is_byte(i) for i in range(size)])
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if one else p.replace("▁", " ").encode() for p, one in zip(pieces, self.b_is_byte)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.numerals = np.array([str(i) for i in range(max(len(self.a_bytes), size))], object)

    def encode(self, texts: list[str]):
        """(A ids, A ends, B ids, B ends) in bytes of each " " + text; None where its bytes are not kept."""
        firsts = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        seconds = self.b.encode(texts, return_type="offset_mapping", return_bytes=True, num_threads=1)
        for text, x, y in zip(texts, firsts, seconds):
            raw = (" " + text).encode()
            a, b = x.ids, y["ids"]
            if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
                yield None
                continue
            place = _byte_places(" " + text, len(raw))
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            spans = x.offsets
            starts, stops = (np.fromiter(map(itemgetter(k), spans), np.int64, len(a)) for k in (0, 1))
            ends = np.fromiter(map(itemgetter(1), y["offsets"]), np.int64, len(b))
            following = np.append(starts[1:], len(text) + 1)
            yield (a, _refine(place[stops], following >= stops, self.a_sizes[a]),
                   b, _refine(ends + 1, ~self.b_is_byte[b], self.b_sizes[b]))  # behind the added space


def _byte_places(text: str, size: int) -> np.ndarray:
    """Byte at which each character begins, and the end."""
    if size == len(text):
        return np.arange(size + 1)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    widths = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    return np.concatenate([[0], np.cumsum(widths)])


def _refine(ends: np.ndarray, clean: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Coarse ends where they are clean; other tokens end their decoded bytes behind the last clean one."""
    if clean.all():
        return ends
    length = np.cumsum(sizes)
    base = np.maximum.accumulate(np.where(clean, np.arange(len(ends)), -1))
    known = base >= 0
    at = np.where(known, ends[base], 0) + length - np.where(known, length[base], 0)
    return np.where(clean, ends, at)


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes at which tokens of both end, and how many A and B tokens there are up to each."""
    cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return cuts, np.searchsorted(a_ends, cuts) + 1, np.searchsorted(b_ends, cuts) + 1


def _safe_end(unit: str) -> bool:
    """Does the unit end with what no token reaches from into a following space?"""
    last = unit[-1:]
    return "!" <= last <= "~" or last.isalnum()


def units_in(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct units of the texts (of " " + text, without the leading space), the place of each unit among
    them, text by text, and how many units each text has (NULL or empty: none)."""
    some = pc.greater(pc.binary_length(texts), 0).fill_null(False)
    parts = pc.split_pattern(texts.filter(some), " ")
    counts = np.zeros(len(texts), np.int64)
    counts[some.to_numpy(zero_copy_only=False)] = pc.list_value_length(parts).to_numpy()
    coded = parts.flatten().dictionary_encode()
    words, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
    if not words:
        return words, at, counts
    lasts = [w[-1:] for w in words]
    safe = {c: _safe_end(c) for c in set(lasts)}
    end = np.array(list(map(safe.get, lasts)))[at]  # is the part the end of a unit?
    final = np.cumsum(counts)[counts > 0] - 1
    blank = np.array([not words[k] for k in at[final].tolist()])
    end[final[blank] - 1] = False  # a space at the end stays with what is before it
    end[final] = True
    if end.all():
        return words, at, counts
    stop = np.flatnonzero(end) + 1
    begin = np.append(0, stop[:-1])
    up_to = np.append(0, np.cumsum(end))
    bounds = np.append(0, np.cumsum(counts))
    place, joined = at[begin], {}
    for k in np.flatnonzero(stop - begin > 1).tolist():
        unit = " ".join(map(words.__getitem__, at[begin[k]:stop[k]].tolist()))
        place[k] = joined.setdefault(unit, len(words) + len(joined))
    words += joined
    used = np.bincount(place, minlength=len(words)) > 0
    return [w for w, one in zip(words, used.tolist()) if one], (np.cumsum(used) - 1)[place], np.diff(up_to[bounds])


def units_of(text: str) -> list[str]:
    """The units of " " + text, without their leading space."""
    units, place, _ = units_in(pa.array([text], pa.string()))
    return list(map(units.__getitem__, place.tolist()))


class _Grown:
    """Numbers, one row behind the other."""

    def __init__(self, *width: int) -> None:
        self.flat, self.n = np.zeros((1 << 12, *width), np.int64), 0

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.flat):
            more = np.zeros((max(len(self.flat), len(values)), *self.flat.shape[1:]), np.int64)
            self.flat = np.concatenate([self.flat, more])
        self.flat[self.n:self.n + len(values)] = values
        self.n += len(values)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, one behind the other."""
    return np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)


class Aligner:
    """Aligned units by their text, with the id pairs of all of them numbered."""

    def __init__(self, tokenizers: Tokenizers) -> None:
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.held = 0
        self.texts: list[str] = []           # a1,a2|b1;... of each unit
        self.sums = _Grown(5)                # tokens of A, of B, groups, links, 1 if its bytes are kept
        self.pair_number: dict[int, int] = {}
        self.seen = _Grown()                 # how often each unit was met lately
        self.ends = _Grown()                 # up to which row the pairs of each unit go
        self.pairs = _Grown()                # numbers of the linked id pairs of each unit
        self.times = _Grown()                # and how often

    def trim(self) -> None:
        """Forget units met once; if the others have over half of ``CACHE_CHARS``, the rarer of them as well."""
        units = list(self.number)
        seen = self.seen.flat[:len(units)]
        sizes = np.fromiter(map(len, units), np.int64, len(units)) + 1
        least = 2
        while sizes[seen >= least].sum() > CACHE_CHARS // 2:
            least *= 2
        keep = np.flatnonzero(seen >= least)
        texts, sums, times, seen = self.texts, self.sums.flat[keep], self.times.flat, seen[keep] // 2
        begin, n = self.rows_of(keep)
        at = _ranges(begin, n)
        pairs = np.fromiter(self.pair_number, np.int64, len(self.pair_number))
        used, where = np.unique(self.pairs.flat[at], return_inverse=True)
        self.clear()
        keep = keep.tolist()
        self._number([units[k] for k in keep])
        self.texts = [texts[k] for k in keep]
        self.pair_number = dict(zip(pairs[used].tolist(), range(len(used))))
        for grown, values in ((self.sums, sums), (self.ends, np.cumsum(n)), (self.pairs, where), (self.times, times[at])):
            grown.add(values)
        self.seen.flat[:len(keep)] = seen

    def rows_of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row of the pairs of each unit, and how many there are."""
        begin = np.where(at > 0, self.ends.flat[at - 1], 0)
        return begin, self.ends.flat[at] - begin

    def look_up(self, units: list[str]) -> list[int]:
        """Numbers of distinct units; new ones are aligned first."""
        found = list(map(self.number.get, units))
        missing = [k for k, n in enumerate(found) if n is None]
        if missing:
            self._learn([units[k] for k in missing])
            for k in missing:
                found[k] = self.number[units[k]]
        return found

    def _learn(self, units: list[str]) -> None:
        """Units that may stand before others in a text are encoded together, ``JOIN_CHARS`` at a time."""
        lists = [[u] for u in units if not _safe_end(u)]
        joint = [u for u in units if _safe_end(u)] if lists else list(units)
        sizes = np.cumsum(np.fromiter(map(len, joint), np.int64, len(joint)) + 1)
        cuts = np.flatnonzero(np.diff(sizes // JOIN_CHARS, prepend=0)) + 1
        lists += [joint[i:j] for i, j in pairwise([0, *cuts.tolist(), len(joint)]) if i < j]
        for some, known in zip(lists, self.tokenizers.encode([" ".join(x) for x in lists])):
            if known is not None:
                self._keep(some, *known)
            elif len(some) > 1:  # find the unit that does not keep its bytes
                for u, known in zip(some, self.tokenizers.encode(some)):
                    self._keep([u], *known) if known is not None else self._lose(u)
            else:
                self._lose(some[0])

    def _lose(self, unit: str) -> None:
        self._number([unit])
        self.texts.append("")
        self.sums.add(np.zeros((1, 5), np.int64))
        self.ends.add(np.array([self.pairs.n]))

    def _number(self, units: list[str]) -> None:
        self.number.update(zip(units, range(len(self.number), len(self.number) + len(units))))
        self.held += sum(map(len, units)) + len(units)
        self.seen.add(np.zeros(len(units), np.int64))

    def _keep(self, units: list[str], a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> None:
        cuts, to_a, to_b = groups_of(a_ends, b_ends)
        n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        lengths = pc.binary_length(pa.array(units, pa.string())).to_numpy().astype(np.int64)
        last = np.searchsorted(cuts, np.cumsum(lengths + 1))  # each unit's last group
        self._number(units)
        links = n_a * n_b
        of_unit = [np.diff(x[last], prepend=0) for x in (to_a, to_b, np.arange(1, len(cuts) + 1), np.cumsum(links))]
        self.sums.add(np.stack([*of_unit, np.ones(len(units), np.int64)], axis=1))
        self.texts += self._said(a, b, n_a, n_b, last).split("\n")

        pairs, times, unit_of = self._linked(a, b, to_a - n_a, to_b - n_b, n_a, n_b)
        unit = np.searchsorted(last, unit_of)
        distinct, where = np.unique(pairs, return_inverse=True)
        numbers = [self.pair_number.setdefault(p, len(self.pair_number)) for p in distinct.tolist()]
        counts = np.bincount(unit, minlength=len(units))
        self.ends.add(self.pairs.n + np.cumsum(counts))
        self.pairs.add(np.array(numbers, np.int64)[where])
        self.times.add(times)

    def _linked(self, a, b, from_a, from_b, n_a, n_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Linked id pairs, how often each is linked, and its group; groups in order."""
        size = n_a * n_b
        size[(n_a > WIDE) & (n_b > WIDE)] = 0
        group = np.repeat(np.arange(len(size)), size)
        at = _ranges(np.zeros(len(size), np.int64), size)
        pairs = a[from_a[group] + at // n_b[group]] << 32 | b[from_b[group] + at % n_b[group]]
        times = np.ones(len(pairs), np.int64)
        wide = np.flatnonzero((n_a > WIDE) & (n_b > WIDE)).tolist()
        if not wide:
            return pairs, times, group
        for g in wide:  # distinct ids only
            x, n = np.unique(a[from_a[g]:from_a[g] + n_a[g]], return_counts=True)
            y, m = np.unique(b[from_b[g]:from_b[g] + n_b[g]], return_counts=True)
            pairs = np.concatenate([pairs, (x[:, None] << 32 | y).ravel()])
            times = np.concatenate([times, (n[:, None] * m).ravel()])
            group = np.concatenate([group, np.full(len(x) * len(y), g)])
        order = np.argsort(group, kind="stable")
        return pairs[order], times[order], group[order]

    def _said(self, a, b, n_a, n_b, last) -> str:
        """The groups in words: `,` in one side, `|` between sides, `;` between groups, a line break between units."""
        group_a, group_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
        to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
        out = np.empty(2 * (len(a) + len(b)), object)
        out[0::2] = ","
        at_a = np.arange(len(a)) + (to_b - n_b)[group_a]
        at_b = np.arange(len(b)) + to_a[group_b]
        out[2 * at_a + 1] = self.tokenizers.numerals[a]
        out[2 * at_b + 1] = self.tokenizers.numerals[b]
        begin = at_a[to_a - n_a]
        out[2 * begin] = ";"
        out[2 * begin[last[:-1] + 1]] = "\n"
        out[0] = ""
        out[2 * at_b[to_b - n_b]] = "|"
        return "".join(out.tolist())


def _pack(places: np.ndarray, times: np.ndarray) -> bytes:
    both = np.concatenate([np.diff(places, prepend=0), times]).astype("<u4")
    return pa.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True) if len(both) else b""


def _unpack(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = pa.decompress(blob, decompressed_size=8 * n, codec="zstd", asbytes=True)
    both = np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)
    return np.cumsum(both[:n]), both[n:]


NARROW = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()),
          ("groups_sha256", T.StringType()), ("n_pairs", T.IntegerType()), ("refs", T.BinaryType())]


class _Chunk:
    """Documents whose pairs are numbered together."""

    def __init__(self, aligner: Aligner, schema: pa.Schema, part: int) -> None:
        self.aligner, self.schema, self.src = aligner, schema, part << 32
        self.rows: list[dict] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.n = 0

    def add(self, ids: list, texts: pa.Array) -> None:
        known = self.aligner
        units, place, counts = units_in(texts)
        found = known.look_up(units)
        at = np.array(found, np.int64)
        known.seen.flat[at] += np.bincount(place, minlength=len(units))
        at = at[place]
        texts_of = np.array(list(map(known.texts.__getitem__, found)), object)
        ends = np.cumsum(counts)
        sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(known.sums.flat[at], axis=0)])
        sums = sums[ends] - sums[ends - counts]
        kept = (sums[:, 4] == counts) & (counts > 0)  # all units keep their bytes
        sums[~kept] = 0
        for doc_id, end, n, row, whole in zip(ids, ends.tolist(), counts.tolist(), sums.tolist(), kept.tolist()):
            said = ";".join(texts_of[place[end - n:end]].tolist()) if whole else None
            self.rows.append({"doc_id": doc_id, "n_a": row[0], "n_b": row[1], "n_groups": row[2], "n_links": row[3],
                              "groups_sha256": hashlib.sha256(said.encode()).hexdigest() if whole else ""})
        at = at[np.repeat(kept, counts)]
        counts = np.where(kept, counts, 0)
        # (document, pair) and how often, from the pairs of its units
        begin, n = known.rows_of(at)
        at = _ranges(begin, n)
        step = max(1, len(known.pair_number))
        key = np.repeat(np.repeat(np.arange(len(ids)), counts), n) * step + known.pairs.flat[at]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.add.reduceat(known.times.flat[at][order], first) if len(key) else key
        key = key[first]
        cuts = np.searchsorted(key, np.arange(1, len(ids)) * step)
        self.pairs += np.split(key % step, cuts)
        self.times += np.split(times, cuts)
        self.n += len(key)

    def full(self) -> bool:
        return self.n >= CHUNK_PAIRS or self.aligner.held >= CACHE_CHARS

    def flush(self):
        if not self.rows:
            return
        keys = np.fromiter(self.aligner.pair_number, np.int64, len(self.aligner.pair_number))
        used, where, docs = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        at = 0
        for row, times in zip(self.rows, self.times):
            row |= {"src": self.src, "n_pairs": len(times), "refs": _pack(where[at:at + len(times)], times)}
            at += len(times)
        yield pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
        if len(used):
            yield pa.RecordBatch.from_pylist([{"src": self.src, "table": keys[used], "docs": docs}], schema=self.schema)
        self.src, self.rows, self.pairs, self.times, self.n = self.src + 1, [], [], [], 0
        if self.aligner.held >= CACHE_CHARS:
            self.aligner.trim()


def _align(a_json: str, b_model: bytes, schema_of):
    def run(batches):
        from pyspark import TaskContext

        chunk = None
        gc.disable()  # millions of small tuples and no cycles among them
        try:
            for b in batches:
                if chunk is None:
                    chunk = _Chunk(Aligner(Tokenizers(a_json, b_model)), schema_of(b.schema.field("doc_id").type), TaskContext.get().partitionId())
                for start, end in slices(b.column("size").to_numpy(), SLICE_BYTES):
                    part = b.slice(start, end - start)
                    chunk.add(part.column("doc_id").to_pylist(), part.column("text"))
                    if chunk.full():
                        yield from chunk.flush()
            if chunk is not None:
                yield from chunk.flush()
        finally:
            gc.enable()
    return run


def _arrow_schema(id_type: pa.DataType) -> pa.Schema:
    kinds = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}
    return pa.schema([("src", pa.int64()), ("doc_id", id_type), *[(n, kinds[k]) for n, k in NARROW],
                      ("table", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])


def _finish(docs: pa.Table, replies: pa.Table) -> pa.Table:
    counts, best = np.zeros(replies.num_rows, np.int64), np.zeros(replies.num_rows, bool)
    at = replies.column("pos").to_numpy()
    counts[at], best[at] = replies.column("count").to_numpy(), replies.column("best").to_numpy(zero_copy_only=False)
    n_best, count_sum = [], []
    for blob, n in zip(docs.column("refs").to_pylist(), docs.column("n_pairs").to_pylist()):
        places, times = _unpack(blob, n)
        n_best.append(int(times[best[places]].sum()))
        count_sum.append(int((times * counts[places]).sum()))
    return (docs.drop_columns(["src", "n_pairs", "refs"])
            .append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64())))


def align_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 a_path: str = BYTE_BPE, b_path: str = PIECES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum of every document (see the module's text)."""
    texts = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    id_field = T.StructField("doc_id", texts.schema["doc_id"].dataType)
    narrow = [T.StructField(n, k) for n, k in NARROW]
    long_list = T.ArrayType(T.LongType())
    first = settle(texts.mapInArrow(
        _align(*_files(a_path, b_path), _arrow_schema),
        T.StructType([T.StructField("src", T.LongType()), id_field, *narrow, T.StructField("table", long_list), T.StructField("docs", long_list)])))

    sent = (first.filter(F.col("table").isNotNull())
            .select("src", F.posexplode(F.arrays_zip("table", "docs")).alias("pos", "x"))
            .select("src", "pos", F.col("x.table").alias("pair"), F.col("x.docs").alias("docs")))
    counts = sent.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("pair", 32))
    # one row per id of A, so its size is that of the vocabulary
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    known = counts.join(F.broadcast(highest), "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    replies = sent.join(known, "pair").select(F.col("src").alias("chunk"), "pos", "count", "best")
    out = T.StructType([id_field, *narrow[:5], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return (first.filter(F.col("table").isNull()).select("src", "doc_id", *[n for n, _ in NARROW])
            .groupBy("src").cogroup(replies.groupBy("chunk")).applyInArrow(_finish, out))


def _files(a_path: str, b_path: str) -> tuple[str, bytes]:
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return a.read(), b.read()


SPANS = "doc_id {id}, groups array<struct<start:long,stop:long,a:array<int>,b:array<int>>>"


def token_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                a_path: str = BYTE_BPE, b_path: str = PIECES) -> DataFrame:
    """doc_id and groups: byte range in " " + text, A ids and B ids of each group, in order; none for texts without tokens."""
    a_json, b_model = _files(a_path, b_path)
    texts = pick(docs, doc_id=id_col, text=text_col)

    def run(batches):
        tokenizers, groups = None, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()),
                                                       ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for batch in batches:
            tokenizers = tokenizers or Tokenizers(a_json, b_model)
            out = []
            for text in batch.column("text").to_pylist():
                found, begin = [], 0
                for unit, known in zip(units_of(text or ""), tokenizers.encode(units_of(text or "") if text else [])):
                    if known is None:
                        found = []
                        break
                    a, a_ends, b, b_ends = known
                    last = i = j = 0
                    for stop, to_i, to_j in zip(*(x.tolist() for x in groups_of(a_ends, b_ends))):
                        found.append({"start": begin + last, "stop": begin + stop, "a": a[i:to_i], "b": b[j:to_j]})
                        last, i, j = stop, to_i, to_j
                    begin += len(unit.encode()) + 1
                out.append(found)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, groups)], names=["doc_id", "groups"])
    return texts.mapInArrow(run, SPANS.format(id=texts.schema["doc_id"].dataType.simpleString()))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"))
