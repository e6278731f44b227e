"""N-gram Jaccard join: documents whose sets of word shingles have a Jaccard index of 0.75 or more, and their components.

Sets are ordered rarest first: shingles of many documents come last, the commonest at the end, the
others stand by hash. Two similar sets share a shingle among the first few of each
(prefix filter), at places early enough for the rest to suffice (positional filter), which
is tested on the pairs that lists form; no part of a list is skipped by place. Two similar sets also share
so many of these shingles that few other pairs are left. Which shingles have a list at all is found out from
sorted, shortened shingles in packed shares, before any list is made.

Answers are derived, not recomputed, for sets that are highly similar to one already answered. Each list is
first checked against one pivot only, the set that shares most of its first shingles. What links becomes a cluster around
a hub, its set with the most links, and each is at a known distance from it. A list within one cluster is skipped as a whole; the others meet a new pivot, up to a few turns.
Then clusters are compared by their hubs. Two whose hubs link are one; two are skipped if their hubs are exactly so far
apart that no two members can be close, as Jaccard distance is a metric. Only members for which it leaves a doubt are
compared, by sketches first. In a group of many sets that are just not similar, these are still pairs of its members.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import bound, bucketed, sliced, staged, text_or_empty
from signalmill.llm.components import components

WORDS = 5
#: Similarity in percent.
LEAST = 75
#: Shingles of so many documents are put last, the commonest at the end. This changes the work, not the result.
COMMON = 24
#: So many of the commonest are put last, which bounds what every task holds (16 bytes each).
MOST_COMMON = 500_000
#: Shingles are counted by so many of their highest bits.
COUNTED_BITS = 40
#: Up to so many ids are broadcast to fetch their texts; more are joined.
BROADCAST_IDS = 500_000

_P = np.uint64(0x9E3779B97F4A7C15)
#: Column of the row marks that are landed with documents.
_MARK = "_landed_row_mark"
#: Lists meet a pivot so many times at the most. This changes the work, not the result.
TURNS = 3
#: Sketches have at least so many cells for each member.
CELLS = 4
#: Sets of about so many first shingles form a block, whose shingles travel together.
BLOCK_TOKENS = 300_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: str, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's 5-word shingles, A-Z lower-cased.

    With fewer words the whole sequence is one; without a word there is none.
    """
    words = text.encode().lower().split()  # bytes lower-case and split by ASCII alone
    n = min(len(words), WORDS)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = len(h) - n + 1
    joined = np.full(size, n, np.uint64)
    for i in range(n):
        joined = (joined ^ h[i : i + size]) * _P
        joined ^= joined >> np.uint64(29)
    return np.unique(joined * np.uint64(0xBF58476D1CE4E5B9))


def needed(n: int) -> int:
    """How many shingles a set of n shares at least with any similar one."""
    return -(-LEAST * n // 100)


def parity(found: np.ndarray) -> np.ndarray:
    """Bits of how often, odd or even, a set's hashes fall into ``CELLS`` times as many cells as it has members, rounded up to a power of 2.

    Two sets differ in at least as many members as their bits differ. Halves of the larger
    of two sketches, one laid over the other, give that of the smaller size.
    """
    cells = 1 << max(6, math.ceil(math.log2(max(CELLS * len(found), 1))))
    counts = np.bincount((found & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))


def _cut_in_shares(short: np.ndarray, bits: int, shares: int) -> list[tuple[int, int, int]]:
    """Share, begin and end of each run of sorted ``short`` that falls into one of equal parts of the token range."""
    rest = max(bits - 31, 0)  # shares are told by the highest bits alone
    share_of = (short >> np.uint64(rest)) * np.uint64(shares) >> np.uint64(bits - rest)
    cuts = np.searchsorted(share_of, np.arange(shares + 1, dtype=np.uint64)).tolist()
    return [(share, a, b) for share, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]


def _gaps(short: np.ndarray) -> bytes:
    """Sorted numbers as compressed gaps, byte by byte."""
    gaps = np.diff(short, prepend=np.uint64(0)).astype("<u8")
    planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes, codec="zstd", asbytes=True)


def _from_gaps(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def common_shingles(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The commonest shingles, shortened and sorted, and how many texts have each; both are broadcast.

    Every shingle of every text is counted, however few of its texts a task sees: tasks send what they have as packed gaps to
    shares of the token range, where it is added up. Any choice gives the same links, since it only has to be the same for
    all sets; so shortened shingles that agree by chance, one in a hundred of ten billion, do no harm.
    """
    shares = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = _Hashes(), [], 0

        def report() -> pa.RecordBatch:
            # equal ones follow one another with gaps of 0, so that they need no count of their own
            short = np.sort(np.concatenate([np.empty(0, np.uint64), *held])) >> np.uint64(64 - COUNTED_BITS)
            runs = _cut_in_shares(short, COUNTED_BITS, shares)
            columns = [pa.array([r[0] for r in runs], pa.int32()), pa.array([b - a for _, a, b in runs], pa.int32())]
            columns.append(pa.array([_gaps(short[a:b]) for _, a, b in runs], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["share", "n", "gaps"])

        for batch in sliced(batches):
            for text in batch.column(0):
                held.append(shingles(text.as_py(), hashes))
                size += len(held[-1])
                if size > 1_000_000:
                    yield report()
                    held, size = [], 0
        yield report()

    def count(table: pa.Table) -> pa.Table:
        held, times = np.empty(0, np.uint64), np.empty(0, np.int64)
        waiting, size = [], 0

        def add(more: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            found, n = np.unique(np.concatenate(more), return_counts=True)
            both = np.concatenate([held, found])
            known, number = np.unique(both, return_inverse=True)
            return known, np.bincount(number, np.concatenate([times, n]), len(known)).astype(np.int64)

        for n, gaps in zip(table["n"].to_pylist(), table["gaps"], strict=True):
            waiting.append(_from_gaps(gaps.as_py(), n))
            size += n
            if size > 2_000_000 + len(held):
                held, times = add(waiting)
                waiting, size = [], 0
        held, times = add(waiting) if waiting else (held, times)
        often = times >= COMMON
        return pa.table({"token": pa.array(held[often].astype(np.int64)), "n": pa.array(times[often])})

    sent = rows.select("text").mapInArrow(send, "share int, n int, gaps binary")
    seen = sent.groupBy("share").applyInArrow(count, "token long, n long")
    most = seen.orderBy(F.col("n").desc(), "token").limit(MOST_COMMON).toPandas().sort_values("token")
    return most["token"].to_numpy(np.int64).astype(np.uint64), most["n"].to_numpy(np.int64)


def shingle_sets(rows: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """block, doc_id, n_shingles, node (a hash of the set; null if empty), prefix, bits (a sketch of the set).

    ``prefix`` and ``bits`` are null where the task has seen the same set before.
    """
    shared = rows.sparkSession.sparkContext.broadcast(common)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (late, often), seen = _Hashes(), shared.value, set()
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in sliced(batches):
            sizes, nodes, prefixes, sketches = [], [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), hashes)
                n = len(found)
                node = int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)
                sizes.append(n)
                nodes.append(node if n else None)
                if not n or node in seen:
                    prefixes.append(None)
                    sketches.append(None)
                    continue
                if len(seen) < 200_000:  # only saves work
                    seen.add(node)
                is_late = np.zeros(n, bool)
                if len(late):
                    short = found >> np.uint64(64 - COUNTED_BITS)
                    at = np.minimum(np.searchsorted(late, short), len(late) - 1)
                    is_late = late[at] == short
                size = n - needed(n) + 1
                first = found[~is_late][:size]
                if len(first) < size:
                    rarest = np.argsort(often[at[is_late]], kind="stable")[: size - len(first)]
                    first = np.concatenate([first, found[is_late][rarest]])
                prefixes.append(first.view(np.int64))
                sketches.append(parity(found))
            columns = [pa.array([block] * len(sizes), pa.int64()), batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())]
            columns += [pa.array(prefixes, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "doc_id", "n_shingles", "node", "prefix", "bits"])
            held += sum(len(p) for p in prefixes if p is not None)
            if held >= BLOCK_TOKENS:
                block, held = block + 1, 0

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(make, f"block long, doc_id {id_type}, n_shingles long, node long, prefix array<long>, bits array<long>")


def _shortened(prefixes: pa.ChunkedArray, bits: int) -> np.ndarray:
    """The highest bits of all tokens, list by list."""
    held = [np.empty(0, np.int64), *(c.flatten().to_numpy() for c in prefixes.chunks)]
    return np.concatenate(held).view(np.uint64) >> np.uint64(64 - bits)


def shared_entries(sets: DataFrame) -> DataFrame:
    """node, n, place, token, whole: the first shingles that more than one set may have, and how many of 1000 first ones of its set do.

    Each block sends its sorted tokens, shortened and as gaps, in one row per share of the token range, and gets a
    bit per token back. A token goes out once per block, so none is hot. Shortened tokens are long enough that about one in a hundred
    agrees with another by chance, at any size of the data; such a token only makes a list of one set.
    """
    spark = sets.sparkSession
    blocks = sets.where("prefix IS NOT NULL").select("block", "node", F.col("n_shingles").alias("n"), "prefix")
    total = blocks.agg(F.sum(F.size("prefix"))).first()[0] or 0
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(total.bit_length() + 7, 63)

    def send(table: pa.Table) -> pa.Table:
        short, times = np.unique(_shortened(table["prefix"], bits), return_counts=True)
        runs = _cut_in_shares(short, bits, shares)
        rows = [(share, b - a, _gaps(short[a:b]), np.packbits(times[a:b] > 1).tobytes()) for share, a, b in runs]
        share, n, gaps, again = zip(*rows, strict=True) if rows else ((), (), (), ())
        columns = [pa.array([table["block"][0].as_py()] * len(rows), pa.int64()), pa.array(share, pa.int32()), pa.array(n, pa.int32())]
        return pa.table([*columns, pa.array(gaps, pa.binary()), pa.array(again, pa.binary())], names=["block", "share", "n", "gaps", "again"])

    def answer(table: pa.Table) -> pa.Table:
        sizes, held, again = table["n"].to_pylist(), [], []
        for n, gaps, more in zip(sizes, table["gaps"].to_pylist(), table["again"].to_pylist(), strict=True):
            held.append(_from_gaps(gaps, n))
            again.append(np.unpackbits(np.frombuffer(more, np.uint8), count=n).astype(bool))
        _, number, times = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
        shared = times > 1
        shared[number[np.concatenate(again)]] = True
        shared = shared[number]
        ends = np.cumsum(sizes).tolist()
        marks = [np.packbits(shared[e - n : e]).tobytes() for e, n in zip(ends, sizes, strict=True)]
        return pa.table([table["block"], table["share"], table["n"], pa.array(marks, pa.binary())], names=["block", "share", "n", "marks"])

    def pick(table: pa.Table, marks: pa.Table) -> pa.Table:
        order = np.argsort(marks["share"].to_numpy())
        sizes, packed = marks["n"].to_pylist(), marks["marks"].to_pylist()
        known = [np.unpackbits(np.frombuffer(packed[i], np.uint8), count=sizes[i]) for i in order]
        known = np.concatenate([np.empty(0, np.uint8), *known]).astype(bool)
        _, number = np.unique(_shortened(table["prefix"], bits), return_inverse=True)
        at = np.flatnonzero(known[number])
        lists = table["prefix"].combine_chunks()
        lengths = lists.value_lengths().to_numpy()
        of = np.repeat(np.arange(len(lengths)), lengths)[at]
        place = at - (np.cumsum(lengths) - lengths)[of]
        whole = 1000 * np.bincount(of, minlength=len(lengths)) // np.maximum(lengths, 1)
        columns = [pa.array(table[c].to_numpy()[of]) for c in ("node", "n")]
        columns += [pa.array(place, pa.int32()), lists.flatten().take(pa.array(at)), pa.array(whole[of], pa.int32())]
        return pa.table(columns, names=["node", "n", "place", "token", "whole"])

    sent = blocks.groupBy("block").applyInArrow(send, "block long, share int, n int, gaps binary, again binary")
    marks = sent.groupBy("share").applyInArrow(answer, "block long, share int, n int, marks binary")
    return blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(pick, "node long, n long, place int, token long, whole int")


def _distance_bound(n_a: Column, bits_a: Column, n_b: Column, bits_b: Column) -> Column:
    """A lower bound of the Jaccard distance, from sizes and sketches of sets whose sizes fit (one sketch is at most twice the other)."""

    def to(size: Column, bits: Column) -> Column:
        halves = F.zip_with(F.slice(bits, F.lit(1), size), F.slice(bits, size + 1, size), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(bits) > size, halves).otherwise(bits)

    size = F.least(F.size(bits_a), F.size(bits_b))
    unlike = F.zip_with(to(size, bits_a), to(size, bits_b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.greatest(F.aggregate(unlike, F.lit(0), lambda total, n: total + n).cast("long"), F.abs(n_a - n_b))
    return bound(apart, lambda d: 2 * d / (n_a + n_b + d))


class _Join:
    """One run of the join: where its sets and texts are."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str) -> None:
        self.rows = _rows(docs, id_col, text_col)
        self.sets = bucketed(shingle_sets(self.rows, common_shingles(self.rows)), "block", "shingle-sets")
        nodes = self.sets.where("node IS NOT NULL").groupBy("node")
        self.nodes = staged(nodes.agg(F.first("n_shingles").alias("n"), F.min("doc_id").alias("least")), "shingle-nodes")

    def described(self, pairs: DataFrame) -> DataFrame:
        """Adds the sizes of a and b, and how far they are apart at least."""
        # landed, so that sizes are known: while what pairs name is few, the sets are not shuffled to meet it
        pairs = staged(pairs, "sketched-pairs")
        wanted = staged(_ends(pairs), "sketched-nodes")
        sketches = self.sets.where("bits IS NOT NULL").select("node", F.col("n_shingles").alias("n"), "bits")
        sketches = sketches.join(wanted, F.col("node") == F.col("w")).drop("w").dropDuplicates(["node"])
        sketches = staged(sketches, "sketches")
        for side in ("a", "b"):
            own = sketches.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}"))
            pairs = pairs.join(own, side)
        fit = (100 * F.col("n_a") >= LEAST * F.col("n_b")) & (100 * F.col("n_b") >= LEAST * F.col("n_a"))
        if "radius" in pairs.columns:  # of hubs, whose members may fit all the same
            near = F.when(fit, _distance_bound(*map(F.col, ("n_a", "bits_a", "n_b", "bits_b"))))
            sizes = F.abs(F.col("n_a") - F.col("n_b")) / F.greatest("n_a", "n_b")
            return pairs.withColumn("apart", F.coalesce(near, sizes)).drop("bits_a", "bits_b")
        return pairs.where(fit).withColumn("apart", _distance_bound(*map(F.col, ("n_a", "bits_a", "n_b", "bits_b")))).drop("bits_a", "bits_b")

    def full_sets(self, wanted: DataFrame) -> DataFrame:
        """node, members of the wanted nodes (w), from the texts of their least ids."""
        few = wanted.count() <= BROADCAST_IDS
        ids = self.nodes.join(wanted, F.col("node") == F.col("w")).select(F.col("least").alias("i"), "w")
        ids = F.broadcast(ids) if few else ids
        rows = self.rows.join(ids, F.col("doc_id").eqNullSafe(F.col("i"))).select("w", "text")

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = _Hashes()
            for batch in sliced(batches):
                nodes, members = [], []
                for node, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    found = shingles(text.as_py(), hashes)
                    mark = int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)
                    if mark == node:  # an id may stand for several texts
                        nodes.append(node)
                        members.append(found.view(np.int64))
                columns = [pa.array(nodes, pa.int64()), pa.array(members, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "members"])

        found = rows.mapInArrow(make, "node long, members array<long>")
        return staged(found.dropDuplicates(["node"]), "full-sets")

    def shared(self, pairs: DataFrame, members: DataFrame) -> DataFrame:
        """a, b, both: how many members two sets share, exactly."""
        left = members.select(F.col("node").alias("a"), F.col("members").alias("members_a"))
        right = members.select(F.col("node").alias("b"), F.col("members").alias("members_b"))
        joined = pairs.join(left, "a").join(right, "b")
        both = F.size(F.array_intersect("members_a", "members_b")).cast("long")
        return joined.withColumn("both", both).drop("members_a", "members_b")

    def lists(self, entries: DataFrame, turn: int) -> DataFrame:
        """Entries of the lists that lead from one cluster to another, each with the pivot of its list.

        First this is the set with the most first shingles in common with others: among many edited copies of a text that is the
        one edited least, which links to more of them than any other, and lists of the same sets share it. In later turns each
        token orders nodes in a way of its own, so that a set meets many pivots.
        """
        mask = F.col("token") if turn % 2 else F.bitwise_not("token")
        order = F.col("node").bitwiseXOR(mask) if turn else -_ranked(F.col("whole"), "node")
        ends = entries.groupBy("token").agg(
            F.min("hub").alias("low"), F.max("hub").alias("high"), F.min_by("node", order).alias("pivot")
        )
        ends = ends.where("low <> high").select(F.col("token").alias("t"), "pivot")
        ends = staged(ends, "live-lists")  # its size is known then: while it is small, entries are not shuffled to meet it
        found = entries.join(ends, F.col("token") == F.col("t"))
        return staged(found.select("token", "node", "place", "n", "hub", "pivot"), "list-entries")

    def clusters(self, links: DataFrame) -> DataFrame:
        """node, component: for each linked node the hub of its cluster, which is the node with the most links.

        Hubs from which members are not far leave the least doubt about them.
        """
        found = staged(components(links), "components")
        ends = links.select(F.col("a").alias("x")).unionByName(links.select(F.col("b").alias("x")))
        linked = ends.groupBy("x").agg(F.count("*").alias("times"))
        hubs = found.join(linked, F.col("node") == F.col("x")).groupBy(F.col("component").alias("c"))
        hubs = hubs.agg(F.max_by("node", _ranked(F.col("times"), "node")).alias("hub"))
        return staged(found.join(hubs, F.col("component") == F.col("c")).select("node", F.col("hub").alias("component")), "clusters")

    def with_sets(self, members: DataFrame | None, pairs: DataFrame) -> DataFrame:
        """``members`` and the full sets of whatever else the pairs name."""
        wanted = _ends(pairs)
        if members is None:
            return self.full_sets(wanted)
        more = staged(wanted.join(members.select("node"), F.col("w") == F.col("node"), "left_anti"), "more-nodes")
        return members if more.isEmpty() else members.unionByName(self.full_sets(more))

    def links(self) -> DataFrame:
        """a, b: enough similar pairs to connect whatever is connected."""
        tokens = staged(shared_entries(self.sets), "shared-entries")
        entries = self.lists(tokens.withColumn("hub", F.col("node")), 0)

        # each list against its pivot; what links becomes a cluster, and lists within one cluster are skipped from then on
        links, clusters, members = None, None, None
        for turn in range(TURNS):
            star = entries.where("node <> pivot").groupBy(F.col("pivot").alias("a"), F.col("node").alias("b")).agg(
                F.count("*").alias("times"), F.first("hub").alias("hub"), F.first("n").alias("n")
            )
            # half of what two similar sets of this size share; whoever meets a pivot too rarely is compared by clusters
            star = star.where("times > 1 AND 56 * times >= 3 * n")
            if clusters is not None:
                own = clusters.select(F.col("node").alias("p"), "component")
                star = star.join(own, F.col("a") == F.col("p"), "left").where(F.coalesce("component", "a") != F.col("hub"))
            star = staged(self.described(star.select("a", "b")).where("apart <= 0.25"), "star-pairs")
            members = self.with_sets(members, star)
            found = staged(self.shared(star, members).where(_similar()).select("a", "b"), "star-links")
            if turn and found.isEmpty():
                break
            links = found if links is None else links.unionByName(found)
            clusters = self.clusters(links)
            own = clusters.select(F.col("node").alias("x"), "component")
            named = entries.drop("hub", "pivot").join(own, F.col("node") == F.col("x"), "left")
            entries = self.lists(named.select("token", "node", "place", "n", F.coalesce("component", "node").alias("hub")), turn + 1)

        # how far members are from their hubs
        to_hub = clusters.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
        members = self.with_sets(members, to_hub)
        far = staged(self.shared(_sized(to_hub, self.nodes), members).select("a", "b", _distance().alias("far")), "hub-distances")
        own = far.select(F.col("b").alias("x"), "far")
        placed = entries.drop("pivot").join(own, F.col("node") == F.col("x"), "left").drop("x").fillna(0.0, "far")
        placed = staged(placed, "cluster-entries")

        # clusters that meet in a list, and whose hubs are near enough for any of their members
        reach = far.groupBy(F.col("a").alias("h")).agg(F.max("far").alias("radius"))
        heads = placed.groupBy("token", "hub").agg(F.min("n").alias("n_low"), F.max("n").alias("n_high"))
        pairs = _meeting(heads, F.col("l.hub") < F.col("r.hub"), _sizes_fit("n_low", "n_high"))
        pairs = pairs.groupBy(F.col("l.hub").alias("a"), F.col("r.hub").alias("b")).agg(
            F.count("*").alias("times"), F.min("l.n_low").alias("low_a"), F.max("l.n_high").alias("high_a"),
            F.min("r.n_low").alias("low_b"), F.max("r.n_high").alias("high_b"),
        )
        enough = _enough_shared(F.col("times"), *map(F.col, ("low_a", "high_a", "low_b", "high_b")))
        pairs = staged(pairs.where(enough).select("a", "b"), "met-hubs")
        for side in ("a", "b"):
            own = reach.select(F.col("h").alias(f"h_{side}"), F.col("radius").alias(f"radius_{side}"))
            pairs = pairs.join(own, F.col(side) == F.col(f"h_{side}"), "left").drop(f"h_{side}")
        pairs = pairs.withColumn("radius", F.coalesce("radius_a", F.lit(0.0)) + F.coalesce("radius_b", F.lit(0.0)))
        near = self.described(pairs.select("a", "b", "radius")).where(F.col("apart") - F.col("radius") <= 0.25 + 1e-9)
        near = staged(near, "hub-pairs")
        members = self.with_sets(members, near)
        hubs = staged(self.shared(near, members).select("a", "b", "radius", _distance().alias("apart"), _similar().alias("linked")), "hub-links")
        links = links.unionByName(hubs.where("linked").select("a", "b"))
        # clusters whose hubs link are one already; pairs of single sets are answered
        doubtful = hubs.where(~F.col("linked") & (F.col("radius") > 0) & (F.col("apart") - F.col("radius") <= 0.25 + 1e-9))
        doubtful = doubtful.select(F.col("a").alias("hub_a"), F.col("b").alias("hub_b"), F.col("apart").alias("hubs_apart"))

        # members for which the triangle leaves a doubt
        left = placed.alias("l").join(doubtful.alias("d"), F.col("l.hub") == F.col("d.hub_a"))
        same = (F.col("l.token") == F.col("r.token")) & (F.col("d.hub_b") == F.col("r.hub"))
        met = left.join(placed.alias("r"), same).where(_places_fit())
        met = met.where(F.col("hubs_apart") - F.col("l.far") - F.col("r.far") <= 0.25 + 1e-9)
        met = met.groupBy(F.col("l.node").alias("a"), F.col("r.node").alias("b")).agg(
            F.count("*").alias("times"), F.first("l.n").alias("own_a"), F.first("r.n").alias("own_b")
        )
        met = met.where(_enough_shared(F.col("times"), *map(F.col, ("own_a", "own_a", "own_b", "own_b")))).select("a", "b")
        met = staged(self.described(met).where("apart <= 0.25"), "member-pairs")
        members = self.with_sets(members, met)
        return links.unionByName(self.shared(met, members).where(_similar()).select("a", "b"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("w")).distinct()


def _ranked(first: Column, node: str) -> Column:
    """Orders by a number below 2 ** 22, then by the lowest bits of a hash."""
    return F.least(first, F.lit((1 << 22) - 1)) * F.lit(1 << 40) + F.col(node).bitwiseAND((1 << 40) - 1)


def _sized(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}")), side)
    return pairs


def _distance() -> Column:
    return 1 - F.col("both") / (F.col("n_a") + F.col("n_b") - F.col("both"))


def _similar() -> Column:
    return 100 * F.col("both") >= LEAST * (F.col("n_a") + F.col("n_b") - F.col("both"))


def _sizes_fit(low: str, high: str) -> Column:
    return (100 * F.col(f"l.{high}") >= LEAST * F.col(f"r.{low}")) & (100 * F.col(f"r.{high}") >= LEAST * F.col(f"l.{low}"))


def _places_fit() -> Column:
    """The positional filter: what stands before and after a shared shingle in both sets must suffice for the overlap.

    It holds for every shingle that two similar sets share, so that these can be counted behind it.
    """
    before = F.least("l.place", "r.place")
    after = F.least(F.col("l.n") - F.col("l.place"), F.col("r.n") - F.col("r.place"))
    return _sizes_fit("n", "n") & ((100 + LEAST) * (before + after) >= LEAST * (F.col("l.n") + F.col("r.n")))


def _enough_shared(times: Column, low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> Column:
    """Whether sets of such sizes that share ``times`` of their first shingles may be similar.

    Of a set's first n - ceil(3n/4) + 1 shingles, all but n - o are shared if o are shared in all, and o is at least 3/7 of both
    sizes. The set whose first ones end earlier shares them with the first ones of the other, as both stand in one order.
    """
    return 28 * times >= F.least(12 * low_a - 9 * high_b, 12 * low_b - 9 * high_a) + 7


def _meeting(heads: DataFrame, order: Column, fit: Column) -> DataFrame:
    return heads.alias("l").join(heads.alias("r"), (F.col("l.token") == F.col("r.token")) & order).where(fit)


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id that links reach).

    Equal sets are linked. Null and empty texts, and those without a word, have no shingle and are linked with nothing: their
    component is their own id. Texts under five words are linked with equal word sequences only. Rows with
    the same id but other texts are documents of their own; a null id is reachable, but never the
    smallest. Other columns are ignored.
    """
    run = _Join(docs, id_col, text_col)
    groups = components(run.links())
    named = run.nodes.select("node", "least").join(groups.withColumnRenamed("node", "g"), F.col("node") == F.col("g"), "left")
    named = staged(named.select("node", F.coalesce("component", "node").alias("component"), "least"), "named-nodes")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = staged(named.select("node", "component").join(smallest, "component").select(F.col("node").alias("g"), "component_id"), "node-components")
    joined = run.sets.select("doc_id", "n_shingles", "node").join(of_node, F.col("node") == F.col("g"), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of similar ones: that with the smallest id (null ids come last), then text hash.

    Of rows equal in both, one stays. Each row is judged by its own text, whatever other rows have its id. Rows
    without a shingle are similar to nothing and stay.
    """
    # rows are told apart by a mark, which has to be landed to stay the same
    rows = staged(docs.withColumn(_MARK, F.monotonically_increasing_id()), "marked-documents")
    found = similar_documents(rows, _MARK, text_col).select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.xxhash64(text_col).alias("h"), F.col(_MARK).alias("r"))
    keys = rows.select(F.col(_MARK).alias("_mark"), order.alias("_order"))
    groups = staged(found.join(keys, F.col("_row") == F.col("_mark")).select("_row", "component_id", "_order"), "similar-rows")
    first = groups.groupBy("component_id").agg(F.min("_order").alias("_first")).select(F.col("_first.r").alias("_kept"))
    gone = groups.join(first, F.col("_row") == F.col("_kept"), "left_anti").select(F.col("_row").alias("_similar_to_another"))
    gone = staged(gone, "similar-ids")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return rows.join(gone, rows[_MARK] == gone["_similar_to_another"], "left_anti").select(*docs.columns)
