"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of word shingles. All sets are ordered by one global order, rare
shingles first; two sets that are similar enough share at least k shingles within their
k-prefixes. Each document lengthens its prefix as long as the estimated cost of its
candidates falls, and two documents become a candidate pair only when they share as many
prefix shingles as the shorter-reaching of the two asks for. Candidates are verified on
their whole sets.

A shared shingle counts only where both documents have it early enough: two sets of known
sizes that are similar enough have their first k shared shingles within prefixes that are,
for sets of one size, about half as long as those that partners of any size ask for.

Only connected groups are asked for, so pairs within a group need not all be met. Equal
sets count once. Each document is first verified against one other, the least document of
the prefix shingles they share; what links joins into groups. Then, in a few rounds, the
documents of a shingle are verified against some drawn from them. After that all candidate pairs that still lie in different groups are met: of a shingle's
documents, those outside its largest group meet the rest. No link between two groups is
lost. A large group of near copies costs rows in proportion to its size, and copies too
far from each other to be linked are told apart by small sketches within the join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringroster.llm.common import (
    free_shuffles,
    mixed,
    repeat_rows,
    row_tag,
    small_batches,
    texts_of,
    windows_hash,
    word_hashes,
)
from ringroster.llm.components import stars
from ringroster.spool import spooled

WORDS = 5
PERCENT = 80
BINS = 1 << 14  # of the table of estimated frequencies
REACH = 4  # longest multi-match considered
VERIFY = 8.0  # cost of verifying a pair, in postings
SALT_ROWS = 4096  # postings of one shingle per group
ROUNDS = 1  # in which documents meet some others of a shingle; the rest is met in any case
DRAWN = 8  # documents of each shingle in a round
SKETCH = 4  # 64-bit words of parities
SKETCHES = [f"s{i}" for i in range(SKETCH)]
NODES = "doc_id long, text_hash long, tag long, node long, n int, bin int, bits array<long>, " + ", ".join(f"{s} long" for s in SKETCHES)
POSTINGS = "token long, node long, meta long"
SETS = "node long, items array<long>"
LONGS = pa.list_(pa.int64())


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of n words; fewer words are one run; none, none."""
    h = word_hashes(text)
    return np.unique(windows_hash(h, min(n, len(h)))) if len(h) else h


def node_of(items: np.ndarray) -> int:
    """64-bit identity of a set; d different sets collide with a chance of d * d / 2 ** 65."""
    with np.errstate(over="ignore"):
        total = items.sum(dtype=np.uint64) ^ np.bitwise_xor.reduce(mixed(items))
        return int(mixed(np.array([total + np.uint64(len(items))], np.uint64)).view(np.int64)[0])


def _bin(items: np.ndarray) -> np.ndarray:
    return (items >> np.uint64(64 - 14)).astype(np.int64)


def needed(n: int, percent: int) -> int:
    """Least overlap of a set of n with any set similar enough."""
    return -(-n * percent // 100)


def prefix(items: np.ndarray, extra: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """Prefix of a set in the global order, and how many shared shingles it stands for.

    `extra` estimates, per bin, in how many other documents a shingle of it occurs. The
    order is by the size class of that estimate, then by hash. Reaching one further costs
    one more shingle and its occurrences, and divides the expected candidates.
    """
    load = extra[_bin(items)]
    rank = np.frexp(load)[1]
    order = np.lexsort((items, rank))
    t = needed(len(items), percent)
    base = len(items) - t + 1
    reach = np.arange(1, max(1, min(REACH, t)) + 1)
    scanned = np.cumsum(load[order[: base + len(reach) - 1]])[base + reach - 2]
    cost = base + reach + scanned * (1 + VERIFY / reach)
    best = int(reach[np.argmin(cost)])
    return items[order[: base + best - 1]], best


def _nodes(words: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = np.zeros(BINS, np.int64)
        names = ["doc_id", "text_hash", "tag", "node", "n", "bin", "bits", *SKETCHES]
        for batch in batches:
            nodes, sizes, bits, sketches = [], [], [], []
            for text in texts_of(batch.column(3)):
                items = shingles(text, words)
                sizes.append(len(items))
                nodes.append(node_of(items) if len(items) else None)
                bits.append(np.frombuffer(signature(items), "<i8") if len(items) else None)
                sketches.append(sketch(items))
                bins += np.bincount(_bin(items), minlength=BINS) if len(items) > BINS else 0
                if len(items) <= BINS:
                    np.add.at(bins, _bin(items), 1)
            none = pa.nulls(len(nodes), pa.int32())
            columns = [*batch.columns[:3], pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), none, pa.array(bits, LONGS)]
            columns += [pa.array(x) for x in np.array(sketches, np.int64).reshape(-1, SKETCH).T]
            yield pa.RecordBatch.from_arrays(columns, names)
        used = np.flatnonzero(bins)
        none = pa.nulls(len(used), pa.int64())
        columns = [none, none, none, pa.array(bins[used]), pa.nulls(len(used), pa.int32()), pa.array(used, pa.int32())]
        yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(used), LONGS), *[none] * SKETCH], names)

    return scan


def _postings(words: int, percent: int, extra: np.ndarray):
    """Prefix shingles; meta holds the set's size, the shingle's place in the prefix (in
    256ths, rounded down), a salt for very common shingles, whether there is one, and the
    reach."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        parts: list[np.ndarray] = []
        total = 0
        for batch in batches:
            for text in texts_of(batch.column(0)):
                items = shingles(text, words)
                if not len(items) or (node := node_of(items)) in seen:
                    continue
                seen.add(node)
                first, reach = prefix(items, extra, percent)
                salts = (extra[_bin(first)] // SALT_ROWS).astype(np.int64) + 1
                salt = (node & 0xFFFFF) % np.minimum(salts, 1 << 19)
                place = np.arange(len(first)) * 256 // len(first)
                meta = len(items) << 32 | place << 24 | salt << 4 | (salts > 1).astype(np.int64) << 3 | reach
                rows = np.empty((3, len(first)), np.int64)
                rows[0], rows[1], rows[2] = first.view(np.int64), node, meta
                parts.append(rows)
                total += len(first)
                if total > 200_000:
                    yield _rows(parts)
                    parts, total = [], 0
        if parts:
            yield _rows(parts)

    return scan


def _rows(parts: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.concatenate(parts, 1)
    return pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["token", "node", "meta"])


def signature(items: np.ndarray) -> bytes:
    """Parity of the items in each of 2n to 4n bits. Two sets differ in at least as many
    items as their signatures, folded to one width, differ in bits."""
    width = 1 << max(6, int(2 * len(items) - 1).bit_length())
    odd = np.bincount((items & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketch(items: np.ndarray) -> np.ndarray:
    """Parity of the items in each of 64 * SKETCH bits, as a few integers."""
    width = 64 * SKETCH
    odd = np.bincount((items % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def may_be_similar(a: np.ndarray, b: np.ndarray, sizes: int, percent: int) -> bool:
    """False only if two sets, of `sizes` items together, cannot be similar enough. The plain
    form of `_may_be_similar`."""
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    shared = (sizes - int(np.bitwise_count(a ^ b).sum())) // 2
    return 100 * shared >= percent * (sizes - shared)


def _set_rows(nodes: list[int], held: list[np.ndarray]) -> pa.RecordBatch:
    items = pa.array([x.view(np.int64) for x in held], LONGS)
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), items], ["node", "items"])


def _sets(words: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            nodes, items_of, size = [], [], 0
            for text in texts_of(batch.column(0)):
                items = shingles(text, words)
                if len(items) and (node := node_of(items)) not in seen:
                    seen.add(node)
                    nodes.append(node)
                    items_of.append(items)
                    size += len(items)
                if size > 1 << 20:
                    yield _set_rows(nodes, items_of)
                    nodes, items_of, size = [], [], 0
            yield _set_rows(nodes, items_of)

    return scan


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets are similar enough. The plain form of `_similar`."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def _may_be_similar(a: Column, b: Column, sizes: Column, percent: int) -> Column:
    """False only if two sets with these signatures, of `sizes` items together, cannot be
    similar enough."""
    short = F.when(F.size(a) <= F.size(b), a).otherwise(b)
    long = F.when(F.size(a) <= F.size(b), b).otherwise(a)
    parts = F.sequence(F.lit(0), (F.size(long) / F.size(short)).cast("int") - 1)  # sizes are powers of two

    def folded(odd: Column, part: Column) -> Column:
        return F.zip_with(odd, F.slice(long, part * F.size(short) + 1, F.size(short)), lambda x, y: x.bitwiseXOR(y))

    differ = F.aggregate(F.aggregate(parts, short, folded), F.lit(0), lambda n, x: n + F.bit_count(x))
    return (sizes - differ) * (100 + percent) >= sizes * (2 * percent)


def _similar(a: Column, b: Column, percent: int) -> Column:
    """Whether two sets are similar enough."""
    sizes = F.size(a).cast("long") + F.size(b)
    return F.size(F.array_intersect(a, b)).cast("long") * (100 + percent) >= sizes * percent


def _beside(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """Pairs (u, v) with columns of both sets, as a_ and b_."""
    a, b = (sets.select(F.col("node").alias(k), *[F.col(c).alias(f"{x}_{c}") for c in columns]) for k, x in (("u", "a"), ("v", "b")))
    return pairs.join(b, "v").join(a, "u")


def _verified(
    pairs: DataFrame, nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int
) -> DataFrame:
    """Pairs (u, v) whose sets are similar enough: first by their signatures, which are a
    small part of the sets and never reject a similar pair, then by the whole sets, which are
    built only for the nodes of the pairs that are left. Both tests are columns, so they run
    with the joins; only the making of sets takes workers."""
    near = _beside(pairs, nodes, "bits", "source")
    near = near.where(_may_be_similar(F.col("a_bits"), F.col("b_bits"), F.col("sizes"), percent))
    near = spooled(near.select("u", "v", "a_source", "b_source"))
    sets = sets_of(near.select(F.explode(F.array("a_source", "b_source")).alias("s")).select("s.*").distinct())
    return _beside(near, sets, "items").where(_similar(F.col("a_items"), F.col("b_items"), percent)).select("u", "v")


def _size(meta: str) -> Column:
    return F.shiftright(meta, 32)


def _reach(meta: str) -> Column:
    return F.col(meta).bitwiseAND(7)


def _place(meta: str, percent: int) -> Column:
    """A shingle's place in its set's order, from 0; never more than the true one."""
    length = _size(meta) - F.ceil(_size(meta) * percent / 100) + _reach(meta)
    return F.shiftright(F.shiftright(meta, 24).bitwiseAND(255) * length + 255, 8)


def _fits(a: str, b: str, percent: int) -> Column:
    small, large = F.least(_size(a), _size(b)), F.greatest(_size(a), _size(b))
    return small * 100 >= large * percent


def _counts(a: str, b: str, percent: int) -> Column:
    """Whether a shared shingle may be one of the first k that a similar pair shares, k being
    the lesser reach. With an overlap of at least `least`, a set has at most its size less
    `least` shingles of its own, so no more of them come before."""
    least = F.ceil((_size(a) + _size(b)) * percent / (100 + percent))
    k = F.least(_reach(a), _reach(b))
    early = [_place(x, percent) < _size(x) - least + k for x in (a, b)]
    return _fits(a, b, percent) & early[0] & early[1]


def _near(a: str, b: str, percent: int, own: str = "", other: str = "") -> Column:
    """False only if two sets differ in more bits of their sketches, hence in more items,
    than similar sets of these sizes can."""
    sizes = _size(a) + _size(b)
    bits = sum((F.bit_count(F.col(own + s).bitwiseXOR(F.col(other + s))) for s in SKETCHES), F.lit(0))
    return bits <= sizes - 2 * F.ceil(sizes * percent / (100 + percent))


def _stars(postings: DataFrame, percent: int) -> DataFrame:
    """For each node the one hub, fitting in size, that it shares most shingles with."""
    own = postings.where("node <> hub.node").select("node", "meta", F.col("hub.node").alias("h"), F.col("hub.meta").alias("hm"))
    salted = postings.where(F.col("meta").bitwiseAND(8) != 0).select("token", "hub").distinct()
    among = Window.partitionBy("token")
    tops = salted.withColumn("top", F.min("hub").over(among)).where("hub.node <> top.node")
    tops = tops.select(F.col("hub.node").alias("node"), F.col("hub.meta").alias("meta"), F.col("top.node").alias("h"), F.col("top.meta").alias("hm"))
    pairs = own.where(_counts("meta", "hm", percent)).unionByName(tops.where(_fits("meta", "hm", percent)))
    # a node has as many rows as its prefix at most; dealt by node, they are shuffled once for all that follows
    pairs = pairs.select("node", "h", (_size("meta") + _size("hm")).alias("sizes")).repartition("node")
    counted = pairs.groupBy("node", "h").agg(F.count("*").alias("c"), F.first("sizes").alias("sizes"))
    best = counted.groupBy("node").agg(F.max(F.struct("c", "h", "sizes")).alias("b"))
    return best.select(F.col("b.h").alias("u"), F.col("node").alias("v"), "b.sizes")


def _opened(placed: DataFrame) -> DataFrame:
    """Postings (token, node, meta, root) of shingles in two groups or more, with the largest
    of them as `main`."""
    sizes = placed.groupBy("token", "root").agg(F.count("*").alias("c"))
    main = sizes.groupBy("token").agg(F.max(F.struct("c", "root")).alias("m"), F.count("*").alias("k")).where("k > 1")
    return placed.join(main.select("token", F.col("m.root").alias("main")), "token")


def _regrouped(opened: DataFrame, groups: DataFrame) -> DataFrame:
    """Open postings after further links."""
    return spooled(_opened(_placed(opened.drop("root", "main"), groups)))


def _placed(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds each node's root, from stars; what is in none is its own root, as a root is."""
    roots = groups.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _candidates(met: DataFrame, a: str, am: str, b: str, bm: str) -> DataFrame:
    """Pairs that share as many shingles as asked, from their shared shingles."""
    met = met.select(
        F.least(a, b).alias("u"), F.greatest(a, b).alias("v"),
        F.least(_reach(am), _reach(bm)).alias("reach"), (_size(am) + _size(bm)).alias("sizes"),
    )
    counted = met.groupBy("u", "v").agg(F.count("*").alias("c"), F.min("reach").alias("reach"), F.first("sizes").alias("sizes"))
    return counted.where("c >= reach").select("u", "v", "sizes")


def _drawn(opened: DataFrame, percent: int, seed: int) -> DataFrame:
    """Pairs of a shingle's documents with DRAWN of them, of other groups. These are few, so
    they are verified without asking for further shared shingles."""
    columns = ["node", "meta", "root", *SKETCHES]
    picks = [
        F.min(F.struct(F.xxhash64("node", "token", F.lit(seed * DRAWN + i)).alias("h"), *columns)).alias(f"p{i}")
        for i in range(DRAWN)
    ]
    hubs = opened.groupBy("token").agg(*picks)
    each = F.array_distinct(F.array(*[F.struct(*[f"p{i}.{c}" for c in columns]) for i in range(DRAWN)]))
    hubs = hubs.select("token", F.explode(each).alias("_hub"))
    hubs = hubs.select("token", *[F.col(f"_hub.{c}").alias(f"h_{c}") for c in columns])
    met = opened.join(hubs, "token").where(
        (F.col("root") != F.col("h_root")) & _counts("meta", "h_meta", percent) & _near("meta", "h_meta", percent, "", "h_")
    )
    sizes = (_size("meta") + _size("h_meta")).alias("sizes")
    return met.select(F.least("node", "h_node").alias("u"), F.greatest("node", "h_node").alias("v"), sizes).distinct()


def _across(opened: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs of different groups."""
    few = opened.where("root <> main").select("token", *[F.col(c).alias(f"a_{c}") for c in ("node", "meta", "root", *SKETCHES)])
    met = few.join(opened, "token").where(
        (F.col("a_root") != F.col("root"))
        & ((F.col("root") == F.col("main")) | (F.col("a_node") < F.col("node")))
        & _counts("a_meta", "meta", percent)
        & _near("a_meta", "meta", percent, "a_", "")
    )
    return _candidates(met, "a_node", "a_meta", "node", "meta")


def linked(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, root (null
    without words) and `_tag`.

    component_id is the least doc_id reachable by links, null if none has one. A text
    without words, or none, is linked with nothing: its component is its own doc_id. Rows
    with equal sets, repeated rows among them, are linked. An empty table gives no rows;
    other columns are ignored. Words are lower-cased A-Z; shingles are told apart by 64-bit
    hashes.
    """
    with small_batches(docs.sparkSession):  # all plans with texts or sets end within
        return _linked(docs, words, percent)


def _linked(docs: DataFrame, words: int, percent: int) -> DataFrame:
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), row_tag(docs).alias("tag"), "text")
    scanned = spooled(keyed.mapInArrow(_nodes(words), NODES))
    members = scanned.where("bin is null")
    table = scanned.where("bin is not null").groupBy("bin").agg(F.sum("node").alias("c"))
    counts = np.zeros(BINS)
    for row in table.collect():  # BINS rows at most
        counts[row["bin"]] = row["c"]
    usual = np.median(counts)
    extra = np.maximum(0.0, counts - usual - 5 * np.sqrt(usual + 1))

    postings = docs.select("text").mapInArrow(_postings(words, percent, extra), POSTINGS)
    salted = postings.withColumn("_salt", F.shiftright("meta", 4).bitwiseAND(0xFFFFF))
    together = Window.partitionBy("token", "_salt")
    shared = salted.withColumns({"hub": F.min(F.struct("node", "meta")).over(together), "_most": F.max("node").over(together)})
    shared = shared.where((F.col("hub.node") != F.col("_most")) | (F.col("meta").bitwiseAND(8) != 0))
    # token and node fix the salt; with it the rows need not be shuffled again
    shared = spooled(shared.dropDuplicates(["token", "_salt", "node"]).drop("_most", "_salt"))

    id_key = F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))
    nodes = members.where("node is not null").groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("bits", *SKETCHES)],
        F.min(F.struct("text_hash", id_key.alias("_id"))).alias("source"),
        F.min("doc_id").alias("d"),
    )
    nodes = spooled(nodes)  # one row per set, with one of its texts
    texts = docs.select("text", F.xxhash64("text").alias("text_hash"), id_key.alias("_id"))

    def sets_of(source: DataFrame) -> DataFrame:
        """The sets of some texts. The list of these texts is written first, so Spark knows
        its size when it chooses how to join."""
        found = texts.join(spooled(source), ["text_hash", "_id"], "left_semi").select("text")
        return spooled(found.mapInArrow(_sets(words), SETS).dropDuplicates(["node"]))

    links = spooled(_verified(_stars(shared, percent), nodes, sets_of, percent))
    groups = stars(links, distinct=True)  # of each link found later, the ends are in two groups
    opened = _opened(spooled(_placed(shared.select("token", "node", "meta"), groups)))
    opened = spooled(opened.join(nodes.select("node", *SKETCHES), "node"))
    free_shuffles(docs.sparkSession)  # some ten plans have ended, and the driver holds what they left
    for seed in range(ROUNDS):
        found = spooled(_verified(_drawn(opened, percent, seed), nodes, sets_of, percent))
        groups = stars(groups.unionByName(found), distinct=True)  # stars stand for all links before
        opened = _regrouped(opened, groups)
        free_shuffles(docs.sparkSession)
    rest = spooled(_verified(_across(opened, percent), nodes, sets_of, percent))
    named = _placed(nodes.select("node", "d"), stars(groups.unionByName(rest), distinct=True))
    least = named.groupBy("root").agg(F.min("d").alias("component_id"))
    named = named.join(least, "root").select(F.col("node").alias("_node"), "root", "component_id")
    grouped = members.where("node is not null").join(named, F.col("node") == F.col("_node"))
    out = ["doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "root", F.col("tag").alias("_tag")]
    alone = members.where("node is null").withColumns({"component_id": F.col("doc_id"), "root": F.lit(None).cast("long")})
    return grouped.select(*out).unionByName(alone.select(*out))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, one of each group: that with the least doc_id (null last), of
    equal ids the one with the least row hash. Rows without words all stay."""
    found = spooled(linked(docs, words, percent).select("doc_id", "root", "_tag"))  # read twice below
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_tag")).alias("m")
    kept = found.where("root is not null").groupBy("root").agg(first).select(F.col("m._tag").alias("_tag"))
    count = found.groupBy("_tag").agg(F.count("*").alias("_times"), F.first("root", True).alias("root"))
    alone = count.where("root is null").select("_tag", F.col("_times").alias("_copies"), "_times")
    one = count.join(kept.distinct(), "_tag").select("_tag", F.lit(1).cast("long").alias("_copies"), "_times")
    return repeat_rows(docs, alone.unionByName(one))
