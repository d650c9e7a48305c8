"""Exact Jaccard self-join of shingle sets with signature trees, and the groups it links.

Method. Texts with equal shingle sets form one class, and only classes are
compared. Two sets that are similar enough share a shingle among the first few
of each in any fixed order (prefix filter); classes that share one form the
top node of a tree. In it, classes are packed by size into leaves and leaves
into inner nodes, which hold the OR of their token bitmaps and their range of
sizes. Two trees are descended together, and a pair of nodes is left as soon as
the largest overlap their bitmaps and sizes allow is too small for a link.
Pairs that remain are verified on the whole texts.

At scale. Shingles that many documents hold come last in the order, the most
frequent at the end, so a common passage opens no large node; how frequent they
are is only a hint for the order, never a filter. Top
nodes with the same members are descended once; larger ones are cut into
blocks, whose pairs are spread over tasks. There are three descents. The first
takes each class in its largest node only and tries the likeliest neighbour of
each; the second tries, for each class and each other group in its nodes, the
likeliest member; the last tries all that is left. Each leaves out pairs of
nodes that are already in one group, so a large group of near copies is not
compared pair by pair.

Little is shuffled for a member. A pair meets in its first common shingle, which
is early in the order of the smaller set, so a top node that is late for all of
its members is left out. Later descents take a member only where another group
has a set of like size in the same node, and leave out a pair that has met in
another node, as a member names the first nodes it belongs to. Bitmaps have one or
two bits per token; a second map, twice as wide, of their parities tells single
sets apart as well as a far wider one.
Shingles are counted before they are joined with their nodes, and only those that
two classes share carry more than their count.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.components import components
from quotemill.llm.store import Store, batches_of, runs
from quotemill.llm.words import mix, shingle_sets, slices

LEAF, FAN = 16, 8
# Classes of one block of a top node.
BLOCK = 4096
# Shingles put last in the order, at most; each occurs HOT_LEAST times or more.
HOT_LIMIT = 1 << 20
HOT_LEAST = 8
# Shingles that a task counts at once, and how often it must see one to report it.
_COUNTED = 1 << 22
# Top nodes that a member names, the first by token, and what stands for none.
HEADS = 4
_NO_HEAD = (1 << 63) - 1
# Bits of the narrowest bitmap.
_LEAST_WIDTH = 256
_REPORTED = 3
_PAIRS = 1 << 15


def hot_shingles(store: Store, docs: DataFrame, text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many documents share, sorted, at most HOT_LIMIT; and the binary logarithms of their counts.

    Tasks report what repeats among their own rows, with counts, and sums of
    those decide. A shingle that is missed only makes a top node larger.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(held: list[np.ndarray]) -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= _REPORTED
            return pa.RecordBatch.from_arrays(
                [pa.array(values[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["token", "n"]
            )

        held, rows = [], 0
        for batch in batches:
            for part in slices(batch.column(0)):
                for tokens in shingle_sets(part, size):
                    held.append(tokens)
                    rows += len(tokens)
                if rows >= _COUNTED:
                    yield summed(held)
                    held, rows = [], 0
        if held:
            yield summed(held)

    seen = docs.select(text).mapInArrow(counted, "token long, n long")
    sums = seen.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT_LEAST)
    sums = store.put(sums.select("token", F.floor(F.log2("n")).cast("int").alias("level")), "often")
    # The levels from the top of which no more than HOT_LIMIT shingles are.
    total, least = 0, 64
    for level, n in sorted(sums.groupBy("level").count().collect(), reverse=True):
        total += n
        if total > HOT_LIMIT:
            break
        least = level
    table = sums.where(F.col("level") >= least).toArrow()
    tokens = table["token"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], table["level"].to_numpy().astype(np.int8)[order]


def _bitmap(tokens: np.ndarray) -> bytes:
    """Token bitmap of one or two bits per token, then a map, twice as wide, of the parity of each bit's tokens."""
    width = _LEAST_WIDTH
    while width < len(tokens):
        width *= 2
    mixed = mix(tokens)
    wide = np.bincount((mixed & np.uint64(2 * width - 1)).astype(np.int64), minlength=2 * width)
    narrow = wide[:width] + wide[width:]
    return b"".join(np.packbits(bits, bitorder="little").tobytes() for bits in (narrow > 0, wide % 2 == 1))


def _cid(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _fold(bits: np.ndarray) -> np.ndarray:
    half = bits.shape[1] // 2
    return bits[:, :half] | bits[:, half:]


def _fold_parity(bits: np.ndarray) -> np.ndarray:
    half = bits.shape[1] // 2
    return bits[:, :half] ^ bits[:, half:]


def _features(size: int, percent: int, hot: np.ndarray, levels: np.ndarray):
    schema = pa.schema(
        [
            ("doc", pa.int64()),
            ("n", pa.int64()),
            ("digest", pa.binary()),
            ("cid", pa.int64()),
            ("prefix", pa.list_(pa.int64())),
            ("bits", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for part in slices(batch.column(1)):
                out: dict[str, list] = {name: [] for name in schema.names}
                for k, tokens in enumerate(shingle_sets(part, size)):
                    doc, n = ids[part.lo + k], len(tokens)
                    out["doc"].append(doc)
                    out["n"].append(n)
                    # A row without shingles is like no other, so its digest is its own.
                    content = tokens.tobytes() or b"empty %d" % (doc or 0)
                    digest = hashlib.md5(content, usedforsecurity=False).digest()
                    out["digest"].append(digest)
                    out["cid"].append(_cid(digest))
                    if len(hot):
                        at = np.searchsorted(hot, tokens)
                        at[at == len(hot)] = 0
                        level = np.where(hot[at] == tokens, levels[at], 0)
                        tokens = tokens[np.argsort(level, kind="stable")]
                    kept = n - -(-percent * n // 100) + 1 if n else 0
                    out["prefix"].append(tokens[:kept].view(np.int64))
                    out["bits"].append(_bitmap(tokens))
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


class _Level:
    """The nodes of one level: OR of bitmaps, ranges of sizes and groups, most tokens that share bits.

    Single sets have their parity maps, too.
    """

    def __init__(self, bits, low, high, slack, first, last, step, parity=None):
        self.bits, self.low, self.high, self.slack = bits, low, high, slack
        self.first, self.last, self.step, self.parity = first, last, step, parity

    def __len__(self):
        return len(self.low)

    def above(self, step: int) -> _Level:
        cuts = np.arange(0, len(self), step)
        return _Level(
            np.bitwise_or.reduceat(self.bits, cuts, axis=0),
            np.minimum.reduceat(self.low, cuts),
            np.maximum.reduceat(self.high, cuts),
            np.maximum.reduceat(self.slack, cuts),
            np.minimum.reduceat(self.first, cuts),
            np.maximum.reduceat(self.last, cuts),
            step,
        )


def _tree(bits, parity, sizes, group) -> list[_Level]:
    levels = [_Level(bits, sizes, sizes, _slack(bits, sizes), group, group, 1, parity)]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].above(LEAF if len(levels) == 1 else FAN))
    return levels


def _possible(a: _Level, b: _Level, i: np.ndarray, j: np.ndarray, percent: int):
    """Which node pairs can hold a link, and the largest overlap each allows."""
    overlap = np.bitwise_count(a.bits[i] & b.bits[j]).sum(axis=1, dtype=np.int64)
    overlap += np.minimum(a.slack[i], b.slack[j])
    overlap = np.minimum(overlap, np.minimum(a.high[i], b.high[j]))
    if a.step == b.step == 1:
        # Tokens that two sets share leave both parities alike, so each bit that differs is one they don't share.
        apart = np.bitwise_count(a.parity[i] ^ b.parity[j]).sum(axis=1, dtype=np.int64)
        overlap = np.minimum(overlap, (a.low[i] + b.low[j] - apart) // 2)
    keep = (100 + percent) * overlap >= percent * (a.low[i] + b.low[j])
    keep &= (100 * a.high[i] >= percent * b.low[j]) & (100 * b.high[j] >= percent * a.low[i])
    one = (a.first[i] == a.last[i]) & (b.first[j] == b.last[j]) & (a.first[i] == b.first[j])
    return keep & ~one, overlap


def _descend(a: list[_Level], b: list[_Level], same: bool, percent: int, near: bool):
    """Member pairs (i, j, overlap bound) that no node above them could exclude."""
    height = max(len(a), len(b))
    todo = [(height - 1, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while todo:
        level, i, j = todo.pop()
        if len(i) > _PAIRS:
            todo += [(level, i[_PAIRS:], j[_PAIRS:]), (level, i[:_PAIRS], j[:_PAIRS])]
            continue
        la, lb = a[min(level, len(a) - 1)], b[min(level, len(b) - 1)]
        if level == 0 and same:
            i, j = i[i < j], j[i < j]
        elif near and level == 1:
            i, j = i[np.abs(i - j) <= 1], j[np.abs(i - j) <= 1]
        keep, overlap = _possible(la, lb, i, j, percent)
        i, j, overlap = i[keep], j[keep], overlap[keep]
        if level == 0 or not len(i):
            yield i, j, overlap
            continue
        below_a, below_b = a[min(level - 1, len(a) - 1)], b[min(level - 1, len(b) - 1)]
        ka = la.step if level < len(a) else 1
        kb = lb.step if level < len(b) else 1
        x = (i[:, None] * ka + np.arange(ka))[:, :, None] + np.zeros(kb, dtype=np.int64)
        y = (j[:, None] * kb + np.arange(kb))[:, None, :] + np.zeros((ka, 1), dtype=np.int64)
        inside = (x < len(below_a)) & (y < len(below_b))
        if same:
            inside &= x <= y
        todo.append((level - 1, x[inside], y[inside]))


def _members(table: pa.Table) -> list[dict]:
    """Members by bitmap width, each list sorted by size."""
    sizes = table["n"].to_numpy()
    widths = np.array([len(x) for x in table["bits"].to_pylist()])
    out = []
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        at = at[np.argsort(sizes[at], kind="stable")]
        data = b"".join(table["bits"].take(pa.array(at)).to_pylist())
        both = np.frombuffer(data, dtype=np.uint64).reshape(len(at), -1)
        bits, parity = np.hsplit(both, [both.shape[1] // 3])
        out.append({"at": at, "width": int(width), "bits": bits, "parity": parity, "n": sizes[at]})
    return out


def _slack(bits, sizes):
    return sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)


def _likeliest(left, right, overlap, group):
    """Of each member, the likeliest link to each group of the others."""
    if not len(left):
        return left, right, overlap
    order = np.lexsort((-overlap, group[left], right))
    left, right, overlap = left[order], right[order], overlap[order]
    new = np.ones(len(left), dtype=bool)
    new[1:] = (right[1:] != right[:-1]) | (group[left[1:]] != group[left[:-1]])
    return left[new], right[new], overlap[new]


def _met_before(heads: np.ndarray, token: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs both name a node before this one. There they are a pair, too, whatever the descent."""
    found = np.zeros(len(left), dtype=bool)
    for x in range(HEADS):
        mine = heads[left, x]
        for y in range(HEADS):
            found |= (mine == heads[right, y]) & (mine < token)
    return found


def _bucket_pairs(table: pa.Table, percent: int, near: bool, likeliest: bool):
    """Positions of the member pairs of one block pair that may be links."""
    group = table["grp"].to_numpy()
    side = table["side"].to_numpy()
    heads = table["heads"].combine_chunks().flatten().to_numpy().reshape(-1, HEADS)
    token = table["token"][0].as_py()
    whole = not side.any()
    members = _members(table)
    for k, m in enumerate(members):
        wider = members[k + 1] if k + 1 < len(members) and members[k + 1]["width"] == 2 * m["width"] else None
        for other in (m, wider):
            if other is None:
                continue
            bits = other["bits"] if other is m else _fold(other["bits"])
            parity = other["parity"] if other is m else _fold_parity(other["parity"])
            if whole and near and other is not m:
                # Only the ends meet: the largest of one width and the smallest of the next.
                choices = [(np.arange(max(0, len(m["n"]) - LEAF), len(m["n"])), np.arange(min(LEAF, len(bits))))]
            elif whole:
                choices = [(slice(None), slice(None))]
            else:
                s, o = side[m["at"]], side[other["at"]]
                choices = [(np.flatnonzero(s == 0), np.flatnonzero(o == 1))]
                if other is not m:
                    choices.append((np.flatnonzero(s == 1), np.flatnonzero(o == 0)))
            for mine, theirs in choices:
                at_a, at_b = m["at"][mine], other["at"][theirs]
                if not len(at_a) or not len(at_b):
                    continue
                same = whole and other is m
                orders = [np.arange(len(at_a))]
                if near and same and len(at_a) > LEAF:
                    orders.append(np.lexsort(m["bits"][:, :3].T))
                for order in orders:
                    a_bits, a_n = m["bits"][mine][order], m["n"][mine][order]
                    a = _tree(a_bits, m["parity"][mine][order], a_n, group[at_a][order])
                    b = a
                    if not same:
                        b_bits, b_n = bits[theirs], other["n"][theirs]
                        b = _tree(b_bits, parity[theirs], b_n, group[at_b])
                    kept: list[tuple] = []
                    for i, j, overlap in _descend(a, b, same, percent, near and same):
                        left = at_a[order][i] if same else at_a[i]
                        right = at_b[order][j] if same else at_b[j]
                        new = ~_met_before(heads, token, left, right)
                        left, right, overlap = left[new], right[new], overlap[new]
                        if not likeliest:
                            yield left, right
                            continue
                        among = np.zeros(len(group), dtype=np.int64) if near else group
                        kept.append(_likeliest(left, right, overlap, among))
                        if sum(len(x[0]) for x in kept) > 8 * _PAIRS:
                            kept = [_likeliest(*map(np.concatenate, zip(*kept, strict=True)), among)]
                    if kept:
                        yield _likeliest(*map(np.concatenate, zip(*kept, strict=True)), among)[:2]


def _candidates(percent: int, near: bool, likeliest: bool):
    schema = pa.schema([(f"{c}_{s}", pa.int64()) for s in "ab" for c in ("doc", "cid")])

    def pairs(table: pa.Table) -> Iterator[dict[str, list]]:
        docs, cids = table["doc"].to_numpy(), table["cid"].to_numpy()
        for left, right in _bucket_pairs(table, percent, near, likeliest):
            swap = cids[right] < cids[left]
            left, right = np.where(swap, right, left), np.where(swap, left, right)
            apart = cids[left] != cids[right]
            left, right = left[apart], right[apart]
            out = {"doc_a": docs[left], "cid_a": cids[left], "doc_b": docs[right], "cid_b": cids[right]}
            yield {name: values.tolist() for name, values in out.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = (c for table in runs(batches, ["token", "x", "y"]) for c in pairs(table))
        yield from batches_of(chunks, schema)

    return run


def _spread(rows: DataFrame, near: bool) -> DataFrame:
    """Rows dealt to the block pairs (x, y) of their top node; side 1 is the second block of a pair."""
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    rows = rows.withColumn("_own", own)
    if near:
        return rows.withColumns({"x": F.col("_own"), "y": F.col("_own"), "side": F.lit(0)}).drop("_own")
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.withColumns(
        {
            "x": F.least("_own", "_other"),
            "y": F.greatest("_own", "_other"),
            "side": F.when(F.col("_own") > F.col("_other"), 1).otherwise(0),
        }
    ).drop("_own", "_other")


def _verified(store: Store, pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose whole texts link. Where an id has several texts, the class ids tell which is meant.

    Only texts of some pair are shuffled. Which these are is a table, so Spark knows its
    size: below its threshold it is broadcast and all other texts stay where they are.
    """
    named = pairs.select(F.col("doc_a").alias("doc")).union(pairs.select("doc_b"))
    wanted = store.put(named.distinct(), "wanted")
    texts = docs.join(wanted, "doc", "left_semi")
    both = (
        pairs.join(texts.select(F.col("doc").alias("doc_a"), F.col("text").alias("text_a")), "doc_a")
        .join(texts.select(F.col("doc").alias("doc_b"), F.col("text").alias("text_b")), "doc_b")
        .select("doc_a", "doc_b", "cid_a", "cid_b", "text_a", "text_b")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            sets = (
                (t for part in slices(batch.column(c)) for t in shingle_sets(part, size)) for c in ("text_a", "text_b")
            )
            for k, (x, y) in enumerate(zip(*sets, strict=True)):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    if all(
                        _cid(hashlib.md5(t.tobytes(), usedforsecurity=False).digest()) == batch.column(c)[k].as_py()
                        for t, c in ((x, "cid_a"), (y, "cid_b"))
                    ):
                        kept.append(k)
            yield batch.select(["doc_a", "doc_b"]).take(pa.array(kept, type=pa.int64()))

    return both.mapInArrow(check, "doc_a long, doc_b long").select(
        F.col("doc_a").alias("a"), F.col("doc_b").alias("b")
    )


def jaccard_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id) of every row: groups of texts linked by Jaccard similarity.

    Two rows link when ``100 * |intersection| >= percent * |union|`` of their
    sets of distinct ``size``-word shingles; a component is named by its smallest
    id. A null text counts as empty; a text without words links with nothing,
    not even its copies. Rows with a null id are returned with a null component
    and link nothing. Rows that repeat an id are all returned; where their texts
    differ they are separate documents that meet in that id. Other columns are
    ignored, an empty input gives an empty result.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie between 50 and 100")
    spark = docs.sparkSession
    store = Store(spark, "jaccard")
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    hot = spark.sparkContext.broadcast(hot_shingles(store, docs, "text", size))

    def features(batches):
        return _features(size, percent, *hot.value)(batches)

    rows = store.put(
        docs.mapInArrow(features, "doc long, n long, digest binary, cid long, prefix array<long>, bits binary"), "rows"
    )
    # Copies combine on the map side, so each class is shuffled about once.
    detail = F.struct("doc", "cid", "n", "prefix", "bits")
    classes = rows.where("n > 0 and doc is not null").groupBy("digest").agg(F.min(detail).alias("_m"))
    classes = store.put(classes.select("digest", "_m.*"), "classes")
    reps = classes.select("digest", "doc")

    # Linked sets overlap by so much of the smaller one that their first common shingle is early in it.
    late = F.expr(f"_p > n - ({2 * percent} * n + {99 + percent}) div {100 + percent}")
    # Sizes of linked sets lie in one band or in neighbouring ones; the bands are slightly too wide.
    band = F.floor(F.log("n") / -math.log(0.99 * percent / 100)).cast("int")
    tokens = classes.select(F.posexplode("prefix").alias("_p", "token"), "cid", "n")
    tokens = tokens.select("token", "cid", band.alias("band"), late.alias("late"))
    # Most shingles are in one class only: counts come first, and only shared ones are told apart by their members.
    counts = tokens.groupBy("token").agg(F.count("*").alias("members"), F.bool_and("late").alias("late"))
    counts = counts.where("members > 1 and not late").select("token", "members")
    shared = store.put(tokens.drop("late").join(counts, "token"), "shared")
    postings = shared.groupBy("token", "members").agg(
        F.bit_xor("cid").alias("_x"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("_y")
    )
    nodes = postings.groupBy("members", "_x", "_y").agg(F.min("token").alias("token"))
    members = store.put(shared.join(nodes.select("token"), "token", "left_semi"), "members")
    carried = classes.select("cid", "doc", "n", "bits")

    def descent(rows: DataFrame, near: bool = False, likeliest: bool = False) -> DataFrame:
        keys = ["token", "x", "y"]
        dealt = _spread(rows, near).select(*keys, "side", "doc", "cid", "n", "bits", "grp", "heads")
        parted = dealt.repartition(*keys).sortWithinPartitions(*keys)
        found = parted.mapInArrow(
            _candidates(percent, near, likeliest), "doc_a long, cid_a long, doc_b long, cid_b long"
        )
        pairs = store.put(found.distinct(), "pairs")
        return store.put(_verified(store, pairs, docs, size, percent), "links")

    def still_open(groups: DataFrame) -> DataFrame:
        """Members, with their groups, that have another group's member of like size in their top node."""
        own = carried.select("cid", "doc").join(groups, F.col("doc") == F.col("node"), "left")
        own = own.select("cid", F.coalesce("component", "doc").alias("grp")).join(named.select("cid", "heads"), "cid")
        placed = store.put(members.join(own, "cid"), "placed")
        ends = [F.min("grp").alias("_l"), F.max("grp").alias("_h")]
        bands = placed.groupBy("token", "band").agg(*ends)
        around = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
        around = bands.select("token", around.alias("band"), "_l", "_h").groupBy("token", "band")
        apart = around.agg(F.min("_l").alias("_l"), F.max("_h").alias("_h")).where("_l <> _h")
        return placed.join(apart.select("token", "band"), ["token", "band"]).join(carried, "cid")

    none = F.array(*[F.lit(_NO_HEAD)] * HEADS)
    named = members.groupBy("cid").agg(
        F.max(F.struct("members", "token")).alias("_m"), F.sort_array(F.collect_set("token")).alias("_t")
    )
    named = store.put(named.select("cid", "_m.*", F.slice(F.concat("_t", none), 1, HEADS).alias("heads")), "named")
    first = named.select("cid", "members", "token", none.alias("heads")).join(carried, "cid")
    first = first.withColumn("grp", F.col("doc"))
    links = descent(first, near=True, likeliest=True)
    links = links.union(descent(still_open(components(store, links)), likeliest=True))
    links = links.union(descent(still_open(components(store, links))))
    final = store.put(components(store, links), "groups")

    grouped = (
        reps.join(final, F.col("doc") == F.col("node"), "left")
        .select(F.col("digest"), F.coalesce("component", "doc").alias("_c"))
    )
    return rows.select("doc", "n", "digest").join(grouped, "digest", "left").select(
        F.col("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNotNull(), F.coalesce("_c", "doc")).alias("component_id"),
    )
