"""N-gram Jaccard join with a token-group matrix.

Documents link when the Jaccard similarity of their 5-word shingle sets is 0.8
or more; the result gives every document the smallest id that links reach.

1. Tokens (64-bit shingle hashes) are ordered: rare ones by hash, then the at
   most ``FREQUENT`` most frequent ones (``MIN_FREQUENT`` or more sets) by count.
   Counts come from all documents by a Golomb-coded exchange. The order decides
   speed only: two sets of similarity 0.8 share a token among the first
   ``n - ceil(0.8 n) + 1`` tokens (prefix) of both under any order.
2. Each sender partitions its own sets into groups of similar ones: a centre
   and members that it has verified to link with the centre. It sends the
   token-group matrix in columns: for every prefix token of a group's union, the
   group. A group of near copies that holds a third of all rows thereby sends
   one column per sender, exact copies one set.
3. Owners of token ranges match the columns. For a pair of groups the number of
   common prefix tokens bounds the overlap of any two of their sets; pairs under
   the bound go. In the first round the remaining pairs compare centres. Token
   columns with more than ``LONG`` groups compare all groups with the one that
   has the fewest rare tokens only.
4. In the second round, pairs whose groups are not yet in one component are
   opened: the query group's sets are held against the host group's token union
   (a set needs ``ceil(0.8 n)`` tokens there) and, if that qualifies, against
   the host's sets, in tiles of at most about ``BLOCK`` sets or ``BLOCK_TOKENS`` tokens
   of either group, so a group of any size is opened by many tasks. Long columns give all pairs of different components here, so
   no link between different texts is lost; a column is compared in tiles of ``TILE`` by ``TILE`` groups,
   each by a task of its own, and not at all if its groups are one component.

Owners are as many as the sum of all set sizes asks for, so long texts give more of them. Texts are hashed anew in each
pass: their tokens take more room than the texts (8 bytes for each word), so keeping them would cost more disk than hashing costs time.

Sets stand for all their copies; links and components stay in the cluster.
NULL and empty texts, and texts without words, have size 0 and link with
nothing, also not with each other. Texts with fewer than five words are one
shingle. A NULL id is never the smallest unless all are. Repeated rows link like
other copies. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from blotter.llm.common import among, distinct, parts_for, pick, salted_join, settle, table
from blotter.llm.components import components
from blotter.llm.exact_dedup import bloom_of, in_bloom
from blotter.llm.exchange import decode, encode, owner_cuts
from blotter.llm.shingles import WordHasher, set_id, shingle_sets

HELD_TOKENS = 1_000_000   # tokens a sender holds before it sends
OWNER_TOKENS = 16_000_000 # tokens of all sets per owner at scale
FREQUENT = 1_000_000      # size of the broadcast list of frequent tokens, at most
MIN_FREQUENT = 16
LONG = 64
TILE = 2048   # groups of a long column on either side of a tile
BLOCK = 1024  # sets of a host group, and queries, compared in one task
BLOCK_TOKENS = 4_000_000  # and their tokens


def prefix_length(n):
    """n - ceil(0.8 n) + 1"""
    return n - (4 * n + 4) // 5 + 1


def links(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 5 * len(small) < 4 * len(large):
        return False
    return 9 * int(among(small, large).sum()) >= 4 * (len(a) + len(b))


def _held(batches, hasher):
    """Lists of (set id, tokens), each set once, of about HELD_TOKENS tokens."""
    held, n = {}, 0
    for b in batches:
        for tokens in shingle_sets(b.column("raw").to_pylist(), hasher):
            if len(tokens):
                sid = set_id(tokens)
                if sid not in held:
                    held[sid] = tokens
                    n += len(tokens)
                    if n >= HELD_TOKENS:
                        yield held
                        held, n = {}, 0
    if held:
        yield held


def _sets(batches):
    hasher = WordHasher()
    for b in batches:
        n, sid = [], []
        for tokens in shingle_sets(b.column("raw").to_pylist(), hasher):
            n.append(len(tokens))
            sid.append(set_id(tokens) if len(tokens) else 0)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()),
                                          pa.array(np.array(sid, np.uint64).view(np.int64))],
                                         names=["doc_id", "n_shingles", "sid"])


def _send_counts(owners: int, bits: int):
    def run(batches):
        for held in _held(batches, WordHasher()):
            values, counts = distinct(np.concatenate(list(held.values())) >> np.uint64(64 - bits))
            cuts = owner_cuts(values << np.uint64(64 - bits), owners)
            rows = {"owner": [], "blob": [], "many": [], "counts": []}
            for o, (a, z) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
                if z > a:
                    many = np.flatnonzero(counts[a:z] > 1)
                    rows["owner"].append(o)
                    rows["blob"].append(encode(values[a:z]))
                    rows["many"].append(many.astype(np.uint32).tobytes())
                    rows["counts"].append(counts[a:z][many].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_pydict({"owner": pa.array(rows["owner"], pa.int32())} | {
                x: pa.array(rows[x], pa.binary()) for x in ("blob", "many", "counts")})
    return run


def _frequent(t: pa.Table) -> pa.Table:
    values, counts = [], []
    for blob, many, more in zip(*(t.column(x).to_pylist() for x in ("blob", "many", "counts"))):
        v = decode(blob)
        c = np.ones(len(v), np.int64)
        c[np.frombuffer(many, np.uint32)] = np.frombuffer(more, np.uint32)
        values.append(v)
        counts.append(c)
    values, counts = np.concatenate(values), np.concatenate(counts)
    order = np.argsort(values)
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    total = np.add.reduceat(counts, first)
    keep = total >= MIN_FREQUENT
    return pa.table({"token": pa.array(values[first][keep].view(np.int64)), "c": pa.array(total[keep])})


class Order:
    """The token order: rare tokens by hash, then frequent ones by count and hash."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, bits: int) -> None:
        by = np.argsort(tokens)
        self.tokens, self.counts, self.shift = tokens[by], counts[by], np.uint64(64 - bits)

    def prefix(self, tokens: np.ndarray) -> tuple[np.ndarray, int]:
        """(the prefix of a sorted set, its number of rare tokens)"""
        p = prefix_length(len(tokens))
        if not len(self.tokens):
            return tokens[:p], len(tokens)
        short = tokens >> self.shift
        at = np.searchsorted(self.tokens, short)
        at[at == len(self.tokens)] = 0
        count = np.where(self.tokens[at] == short, self.counts[at], 0)
        rare = int((count == 0).sum())
        if rare >= p:
            return tokens[count == 0][:p], rare
        return tokens[np.lexsort((tokens, count))[:p]], rare


def _local_groups(held: dict, order: Order):
    """Partition sets into groups: (members of each centre, prefix union of each centre, rare tokens of each centre)."""
    prefixes = {sid: order.prefix(tokens) for sid, tokens in held.items()}
    values, counts = distinct(np.concatenate([p for p, _ in prefixes.values()]))
    shared = values[counts > 1]
    members, unions, index = {}, {}, {}
    for sid in sorted(held, key=lambda s: (prefixes[s][1] / len(held[s]), s)):
        tokens, (prefix, rare) = held[sid], prefixes[sid]
        common = prefix[among(prefix, shared)].tolist()
        votes: dict = {}
        for t in common:
            for c in index.get(t, ()):
                votes[c] = votes.get(c, 0) + 1
        home = None
        for c in sorted(votes, key=lambda c: (-votes[c], c)):
            other = held[c]
            if 5 * len(tokens) < 4 * len(other) or 5 * len(other) < 4 * len(tokens):
                continue
            if 9 * (votes[c] + _rest(max(len(tokens), len(other)))) >= 4 * (len(tokens) + len(other)) and links(tokens, other):
                home = c
                break
        if home is None:
            members[sid], unions[sid] = [sid], [prefix]
            for t in common:
                index.setdefault(t, []).append(sid)
        else:
            members[home].append(sid)
            unions[home].append(prefix)
    return members, {c: distinct(np.concatenate(u))[0] for c, u in unions.items()}, {c: prefixes[c][1] for c in members}


def _send_groups(owners: int, order: Order):
    """kind 0: a group's member; kind 1: one owner's columns of the matrix."""
    schema = pa.schema([("kind", pa.int32()), ("grp", pa.int64()), ("sid", pa.int64()), ("n", pa.int64()),
                        ("owner", pa.int32()), ("blob", pa.binary())])

    def run(batches):
        for held in _held(batches, WordHasher()):
            members, unions, rare = _local_groups(held, order)
            rows = [(c, s, len(held[s])) for c, all_of in members.items() for s in all_of]
            grp, sid, n = (np.array(x, t) for x, t in zip(zip(*rows), (np.uint64, np.uint64, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(rows), np.int32)), pa.array(grp.view(np.int64)), pa.array(sid.view(np.int64)),
                 pa.array(n), pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())], schema=schema)
            tokens = np.concatenate(list(unions.values()))
            sizes = [len(u) for u in unions.values()]
            group = np.repeat(np.array(list(unions), np.uint64), sizes)
            weight = np.repeat(np.minimum([rare[c] for c in unions], 65535).astype(np.uint16), sizes)
            by = np.argsort(tokens, kind="stable")
            tokens, group, weight = tokens[by], group[by], weight[by]
            cuts = owner_cuts(tokens, owners)
            sent = [(o, tokens[a:z].tobytes() + group[a:z].tobytes() + weight[a:z].tobytes())
                    for o, (a, z) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())) if z > a]
            k = len(sent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(k, np.int32)), *(pa.nulls(k, pa.int64()) for _ in range(3)),
                 pa.array([o for o, _ in sent], pa.int32()), pa.array([x for _, x in sent], pa.binary())], schema=schema)
    return run


def _shared_columns(t: pa.Table) -> pa.Table:
    """The owner's (token, group, rare) entries of tokens in more than one group, as one blob."""
    tokens, groups, rare = [], [], []
    for x in t.column("blob").to_pylist():
        n = len(x) // 18
        tokens.append(np.frombuffer(x, np.uint64, n))
        groups.append(np.frombuffer(x, np.uint64, n, 8 * n))
        rare.append(np.frombuffer(x, np.uint16, n, 16 * n))
    tokens, groups, rare = np.concatenate(tokens), np.concatenate(groups), np.concatenate(rare)
    by = np.argsort(tokens, kind="stable")
    same = tokens[by][1:] == tokens[by][:-1]
    by = by[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    by = by[np.lexsort((groups[by], tokens[by]))]  # a group comes once from each of its senders
    tokens, groups, rare = tokens[by], groups[by], rare[by]
    first = np.ones(len(tokens), bool)
    first[1:] = (tokens[1:] != tokens[:-1]) | (groups[1:] != groups[:-1])
    tokens, groups, rare = tokens[first], groups[first], rare[first]
    same = tokens[1:] == tokens[:-1]
    keep = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(tokens) else first
    blob = tokens[keep].tobytes() + groups[keep].tobytes() + rare[keep].tobytes()
    return pa.table({"owner": t.column("owner")[:1], "blob": pa.array([blob], pa.binary())})


def _columns(blob: bytes):
    n = len(blob) // 18
    tokens, groups = np.frombuffer(blob, np.uint64, n), np.frombuffer(blob, np.uint64, n, 8 * n)
    rare = np.frombuffer(blob, np.uint16, n, 16 * n)
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if n else np.zeros(0, np.int64)
    return groups, rare, starts, np.diff(np.append(starts, n))


def _distinct_pairs(a: np.ndarray, b: np.ndarray):
    """Pairs of different values, smaller first, each once, and their counts."""
    a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
    by = np.lexsort((b, a))
    a, b = a[by], b[by]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(first)
    return a[at], b[at], np.diff(at, append=len(a))


def _pair_rows(a: list, b: list, near: int):
    if not a:
        return None
    a, b, c = _distinct_pairs(np.concatenate(a), np.concatenate(b))
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(c * near)], names=["a", "b", "c"])


def _first_pairs(batches):
    """All pairs of groups of a short column, each with its number of columns; the centre's pairs of a long one."""
    for batch in batches:
        for blob in batch.column("blob").to_pylist():
            groups, rare, starts, lengths = _columns(blob)
            near_a, near_b, far_a, far_b, held = [], [], [], [], 0
            for size in np.unique(lengths).tolist():
                at = starts[lengths == size]
                if size > LONG:
                    for s in at.tolist():
                        g = groups[s:s + size]
                        hub = np.lexsort((g, rare[s:s + size]))[0]
                        far_a.append(np.full(size, g[hub]))
                        far_b.append(g)
                    continue
                i, j = np.triu_indices(size, 1)
                step = max(1, 1_000_000 // len(i))
                for k in range(0, len(at), step):
                    part = at[k:k + step, None]
                    near_a.append(groups[part + i].ravel())
                    near_b.append(groups[part + j].ravel())
                    held += len(near_a[-1])
                    if held > 4_000_000:
                        yield _pair_rows(near_a, near_b, 1)
                        near_a, near_b, held = [], [], 0
            for rows in (_pair_rows(near_a, near_b, 1), _pair_rows(far_a, far_b, 0)):
                if rows is not None:
                    yield rows


def _long_groups(batches):
    """(owner, group, in how many long columns of the owner it is)"""
    for b in batches:
        for owner, blob in zip(b.column("owner").to_pylist(), b.column("blob").to_pylist()):
            groups, _, starts, lengths = _columns(blob)
            long = [groups[s:s + n] for s, n in zip(starts.tolist(), lengths.tolist()) if n > LONG]
            seen, times = distinct(np.concatenate(long)) if long else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), owner, np.int32)), pa.array(seen.view(np.int64)), pa.array(times)],
                                             names=["owner", "grp", "n_long"])


def _rest(n):
    """Tokens of a set of n behind its prefix."""
    return (4 * n + 4) // 5 - 1


def _long_rows(batches):
    """(owner, col, grp) of every group in a long column."""
    for b in batches:
        for owner, blob in zip(b.column("owner").to_pylist(), b.column("blob").to_pylist()):
            groups, _, starts, lengths = _columns(blob)
            long = lengths > LONG
            col = np.repeat(np.arange(int(long.sum()), dtype=np.int32), lengths[long])
            at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts[long].tolist(), lengths[long].tolist())]) if long.any() else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), owner, np.int32)), pa.array(col), pa.array(groups[at].view(np.int64))],
                                             names=["owner", "col", "grp"])


def _tile_pairs(t: pa.Table) -> pa.Table:
    """Pairs of groups of different components in a tile of a long column that their sizes and numbers of long columns let link."""
    names, labels, least, most, n_long, side = (t.column(x).to_numpy() for x in ("grp", "label", "least", "most", "n_long", "side"))
    x, y = np.flatnonzero(side != 1), np.flatnonzero(side != 0)  # a tile on the diagonal has its groups on both sides
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for k in range(0, len(x), 256):
        a = x[k:k + 256, None]
        fits = ((labels[a] != labels[y]) & (5 * most[a] >= 4 * least[y]) & (5 * most[y] >= 4 * least[a])
                & (9 * (np.minimum(n_long[a], n_long[y]) + _rest(np.maximum(most[a], most[y]))) >= 4 * (least[a] + least[y])))
        i, j = np.nonzero(fits)
        found.append((names[x[k + i]], names[y[j]]))
    a, b, _ = _distinct_pairs(*(np.concatenate(v).view(np.uint64) for v in zip(*found)))
    return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})


def _open_pairs(columns: DataFrame, info: DataFrame) -> DataFrame:
    """Pairs of groups (a, b) of different components in the long columns that may link, from info (grp, label, least, most, n_long)."""
    rows = settle(columns.mapInArrow(_long_rows, "owner int, col int, grp long").join(info, "grp"))
    mixed = (rows.groupBy("owner", "col").agg(F.min("label").alias("first"), F.max("label").alias("last"), F.count(F.lit(1)).alias("n"))
             .filter("first <> last").select("owner", "col", F.ceil(F.col("n") / TILE).cast("int").alias("blocks")))
    side = F.when(F.col("x") == F.col("block"), 2).when(F.col("x") > F.col("block"), 0).otherwise(1)
    return (salted_join(rows, mixed, ["owner", "col"], F.xxhash64("grp"))
            .withColumn("block", F.pmod(F.xxhash64("grp", F.lit(3)), F.col("blocks")).cast("int"))
            .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("owner", "col", F.least("block", "x").alias("i"), F.greatest("block", "x").alias("j"), side.cast("int").alias("side"),
                    "grp", "label", "least", "most", "n_long")
            .groupBy("owner", "col", "i", "j").applyInArrow(_tile_pairs, "a long, b long").distinct())


def _set_rows(words: np.ndarray):
    def run(batches):
        for held in _held(batches, WordHasher()):
            ids = np.array(list(held), np.uint64)
            hits = np.flatnonzero(in_bloom(words, ids)).tolist()
            sets = list(held.values())
            yield pa.RecordBatch.from_arrays([pa.array(ids[hits].view(np.int64)), pa.array([sets[i].tobytes() for i in hits], pa.binary())],
                                             names=["sid", "tokens"])
    return run


def _open(t: pa.Table) -> pa.Table:
    """Links between a part of a host group's sets and the query sets sent to it."""
    sid = t.column("sid").to_pylist()
    query = t.column("query").to_pylist()
    sets = [np.frombuffer(x, np.uint64) for x in t.column("tokens").to_pylist()]
    hosts = [i for i, q in enumerate(query) if not q]
    found = []
    if hosts:
        union = distinct(np.concatenate([sets[i] for i in hosts]))[0]
        for i, q in enumerate(query):
            if q and 5 * int(among(sets[i], union).sum()) >= 4 * len(sets[i]):
                # one link puts the query into the group's component
                hit = next((h for h in hosts if links(sets[i], sets[h])), None)
                if hit is not None:
                    found.append((sid[i], sid[hit]))
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})


def _parts(size: str, most: str):
    """Number of parts that a group of ``size`` sets of at most ``most`` tokens is cut into."""
    return F.expr(f"CAST(ceil({size} / greatest(1, least({BLOCK}, floor({BLOCK_TOKENS} / greatest(1, {most}))))) AS INT)")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` of groups (host, query, host_parts, query_parts, query_size, query_most);
    ``sets`` (grp, part, sid, tokens). Every part of a host meets every block of its queries' sets."""
    blocks = pairs.groupBy("host").agg(
        F.first("host_parts").alias("host_parts"),
        F.greatest(F.ceil(F.sum("query_size") / BLOCK),
                   F.ceil(F.sum(F.col("query_size") * F.col("query_most")) / BLOCK_TOKENS)).cast("int").alias("blocks"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = (pairs.select("host", F.col("query").alias("grp"), each("query_parts").alias("part")).join(blocks, "host")
             .join(sets, ["grp", "part"])
             .select("host", each("host_parts").alias("host_part"), F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int").alias("block"),
                     "sid", "tokens", F.lit(True).alias("query")))
    opened = (blocks.select(F.col("host").alias("grp"), "blocks", each("host_parts").alias("part")).join(sets, ["grp", "part"])
              .select(F.col("grp").alias("host"), F.col("part").alias("host_part"), each("blocks").alias("block"),
                      "sid", "tokens", F.lit(False).alias("query")))
    return opened.unionByName(asked).groupBy("host", "host_part", "block").applyInArrow(_open, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    spark = docs.sparkSession
    texts = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    raw = texts.select("raw")
    schema = T.StructType([texts.schema["doc_id"], T.StructField("n_shingles", T.LongType()), T.StructField("sid", T.LongType())])
    sized = settle(texts.mapInArrow(_sets, schema).withColumn("part", F.spark_partition_id()))
    size = sized.agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("tokens")).first()
    n_docs, n_tokens = size["docs"], size["tokens"] or 0

    # 1. token order
    owners = 4 * parts_for(spark, n_tokens, 4 * OWNER_TOKENS)  # several to a partition, so that their hashing evens out
    bits = min(64, 8 * -(-(max(1, n_docs).bit_length() + 22) // 8))
    frequent = (raw.mapInArrow(_send_counts(owners, bits), "owner int, blob binary, many binary, counts binary")
                .groupBy("owner").applyInArrow(_frequent, "token long, c long")
                .orderBy(F.desc("c"), "token").limit(FREQUENT).toArrow())
    order = Order(frequent.column("token").to_numpy().view(np.uint64), frequent.column("c").to_numpy(), bits)

    # 2. groups and the token-group matrix
    sent = raw.mapInArrow(_send_groups(owners, order), "kind int, grp long, sid long, n long, owner int, blob binary")
    sent = settle(sent)
    members = sent.filter("kind = 0").select("grp", "sid", "n").distinct()
    columns = settle(sent.filter("kind = 1").select("owner", "blob")
                     .groupBy("owner").applyInArrow(_shared_columns, "owner int, blob binary"))
    in_long = settle(columns.mapInArrow(_long_groups, "owner int, grp long, n_long long"))
    groups = settle(members.groupBy("grp").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count(F.lit(1)).alias("size"))
                    .join(in_long.groupBy("grp").agg(F.sum("n_long").alias("n_long")), "grp", "left").na.fill(0, ["n_long"]))
    home = members.filter("grp <> sid").select(F.col("grp").alias("a"), F.col("sid").alias("b"))

    # 3. pairs of groups, bounded, centres compared
    g1 = groups.select(*[F.col(c).alias(f"{c}_a") for c in groups.columns])
    g2 = groups.select(*[F.col(c).alias(f"{c}_b") for c in groups.columns])
    in_reach = F.expr("5 * most_a >= 4 * least_b AND 5 * most_b >= 4 * least_a")
    # c common tokens in short columns, and no more in long ones than the group with fewer of them has
    overlap = F.expr("9 * (c + least(n_long_a, n_long_b) + floor((4 * greatest(most_a, most_b) + 4) / 5) - 1) >= 4 * (least_a + least_b)")
    pairs = (columns.mapInArrow(_first_pairs, "a long, b long, c long").groupBy("a", "b").agg(F.sum("c").alias("c"))
             .join(g1, F.col("a") == F.col("grp_a")).join(g2, F.col("b") == F.col("grp_b")).filter(in_reach & overlap))
    pairs = settle(pairs.select("a", "b", "size_a", "size_b", "most_a", "most_b"))
    in_pairs = pairs.select(F.explode(F.array("a", "b")).alias("grp")).distinct()
    centre_sets = _sets_of(raw, in_pairs.select(F.col("grp").alias("sid")))
    as_centre = centre_sets.select(F.col("sid").alias("grp"), F.lit(0).alias("part"), "sid", "tokens")
    one = F.lit(1)
    first_links = _verify(pairs.select(F.col("a").alias("host"), F.col("b").alias("query"), one.alias("host_parts"), one.alias("query_parts"),
                                       one.alias("query_size"), F.col("most_b").alias("query_most")), as_centre)
    known = settle(home.unionByName(first_links))
    labels = components(known, "a", "b")

    # 4. open the pairs of groups that are still apart
    la = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    lb = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    info = (groups.filter("n_long > 0").join(labels, F.col("grp") == F.col("node"), "left")
            .select("grp", F.coalesce("label", "grp").alias("label"), "least", "most", "n_long"))
    late = (_open_pairs(columns, info).join(pairs.select("a", "b"), ["a", "b"], "left_anti")
            .join(groups.select(F.col("grp").alias("a"), F.col("size").alias("size_a"), F.col("most").alias("most_a")), "a")
            .join(groups.select(F.col("grp").alias("b"), F.col("size").alias("size_b"), F.col("most").alias("most_b")), "b")
            .select(*pairs.columns))
    apart = (pairs.filter("size_a > 1 OR size_b > 1").unionByName(late)
             .join(la, "a", "left").join(lb, "b", "left")
             .filter(F.coalesce("label_a", "a") != F.coalesce("label_b", "b"))
             .withColumn("a_hosts", F.col("size_a") >= F.col("size_b")))
    host, query = (lambda x: F.when(F.col("a_hosts"), F.col(f"{x}a")).otherwise(F.col(f"{x}b")),
                   lambda x: F.when(F.col("a_hosts"), F.col(f"{x}b")).otherwise(F.col(f"{x}a")))
    apart = (apart.select(host("").alias("host"), query("").alias("query"), host("size_").alias("host_size"), host("most_").alias("host_most"),
                          query("size_").alias("query_size"), query("most_").alias("query_most"))
             .withColumn("host_parts", _parts("host_size", "host_most")).withColumn("query_parts", _parts("query_size", "query_most")))
    apart = settle(apart)
    if not apart.isEmpty():
        opened = apart.select(F.explode(F.array("host", "query")).alias("grp")).distinct()
        cut = groups.select("grp", _parts("size", "most").alias("parts")).join(opened, "grp")
        wanted = settle(salted_join(members.select("grp", "sid"), cut, ["grp"], F.xxhash64("sid")))
        sets = (wanted.join(_sets_of(raw, wanted.select("sid").distinct()), "sid")
                .select("grp", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int").alias("part"), "sid", "tokens"))
        known = settle(known.unionByName(_verify(apart, sets)))
        labels = components(known, "a", "b")

    # components back to documents; a set's copies are spread over their partitions
    per_set = sized.filter("n_shingles > 0").groupBy("sid").agg(F.min("doc_id").alias("least"))
    labelled = per_set.join(labels, per_set["sid"] == labels["node"], "left").select("sid", "least", F.coalesce("label", "sid").alias("label"))
    labelled = settle(labelled)
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    answer = salted_join(labelled, smallest, ["label"], F.xxhash64("sid")).select("sid", "component_id")
    per_part = sized.filter("n_shingles > 0").select("part", "sid").distinct().join(answer, "sid")
    return (sized.join(per_part, ["part", "sid"], "left")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))


def _sets_of(raw: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sid, tokens) of the wanted set ids: a pass over the texts behind a Bloom
    filter of fixed size, then the exact join."""
    wanted = settle(wanted)
    found = (raw.mapInArrow(_set_rows(bloom_of(wanted.select(F.col("sid").alias("fp")))), "sid long, tokens binary")
             .groupBy("sid").agg(F.first("tokens").alias("tokens")))
    return settle(found.join(wanted, "sid", "left_semi"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT r, doc_id, CASE WHEN len(w) >= 5 THEN list_sort(list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]))
                         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM d
), kinds AS (
  SELECT s, min(r) AS k, min(doc_id) AS least FROM sets WHERE len(s) > 0 GROUP BY s
), tokens AS (
  SELECT k, len(s) AS n, unnest(s) AS t FROM kinds
), common AS (
  SELECT a.k AS a, b.k AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.k < b.k AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.k, b.k, a.n, b.n
), edges AS (
  SELECT a, b FROM common WHERE 100 * c >= 80 * (na + nb - c)
), both_ways AS (
  SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges
), reach AS (
  SELECT k, k AS other FROM kinds
  UNION
  SELECT reach.k, e.b FROM reach JOIN both_ways e ON reach.other = e.a
), least AS (
  SELECT reach.k, min(o.least) AS component_id FROM reach JOIN kinds o ON o.k = reach.other GROUP BY reach.k
)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(least.component_id, sets.doc_id) AS component_id
FROM sets LEFT JOIN kinds ON kinds.s = sets.s AND len(sets.s) > 0 LEFT JOIN least ON least.k = kinds.k
"""
