"""Near-duplicate documents by SimHash fingerprints and covering locality-sensitive hashing.

A document's fingerprint has a bit set if more than half of its shingles' hashes have it set. Two
fingerprints are linked if at most `radius` of 64 bits differ. Candidates come from 2^(radius+1)-1
tables: each bit position gets a vector of radius+1 bits, each table a non-zero vector v, and the
table keeps the positions whose vector has an odd product with v. For any `radius` positions some v is
orthogonal to all their vectors, so some table keeps none of the positions that differ: every pair
within the radius meets in a table, with certainty.

Only different fingerprints are compared, so exact copies cost one row. Fingerprints that meet are
compared inside the task that holds their bucket; it yields a spanning set of links, not all pairs.
A bucket of over `chunk` fingerprints is cut into chunks, and every two chunks meet in a task of their
own: exact, with bounded memory, whatever the bucket's size.

A document can have several fingerprints, each over its own hashes of the same shingles. They link two
documents if any of them does: k of them find what one overlooks with probability p but for p^k.

Null and empty texts have fingerprint zero and are linked like any other. Rows that repeat an id count
as rows; rows with null ids link like any other, but name no component: one that only they reach has a
null name. Very long texts are read whole, a slice of their hashes at a time. Empty tables give no rows.
Columns other than key and text are not read, or come back as they were.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import free_names, removed, small_parts, table, written
from .components import components

SHINGLE, SEED, RADIUS, CHUNK = 4, 42, 4, 4096
#: Shingles that one task holds at once are those of two chunks of about so many, or of two texts that are longer.
SET_SHINGLES = 1 << 19
#: A bucket with up to so many pairs for each row yields them all; of a denser one, each row meets the one of least rank (by HOOK) and one other in each of the drawn orders, and so many rows with most links, before the rest.
FEW, HOOK, DRAWN = 8, 0x2545F4914F6C, (0x51ED270B35E1, 0x3C6EF372FE94)
#: Rows of least rank that a dense bucket tries; rows that meet none of them stay trees of their own until trees that touch are joined.
HOOK_TURNS = 64
#: Tables of up to so many rows (of a few numbers) are broadcast.
BROADCAST_ROWS = 100_000


def fingerprint_set(text: str | None, shingle: int = SHINGLE, seed: int = SEED, distinct: bool = False, count: int = 1) -> list[int]:
    """`count` fingerprints of one text as signed 64-bit numbers; distinct: each different shingle counts once.

    The first is over the shingles' XXH64; the k-th over numbers that those and k determine.
    """
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return [0] * count
    if shingle == 1:
        runs = words
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else (b" ".join(words),)
    hashes = np.fromiter((xxh64_intdigest(s, seed) for s in (set(runs) if distinct else runs)), np.uint64)
    ones = np.zeros(64 * count, np.int64)
    for lo in range(0, len(hashes), 1 << 14):
        part = hashes[lo : lo + (1 << 14), None]
        if count > 1:
            part = np.concatenate([part, _mixed(part + np.arange(1, count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))], 1)
        bits = np.ascontiguousarray(part).view(np.uint8).reshape(len(part), -1)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64).tolist()


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED, distinct: bool = False) -> int:
    return fingerprint_set(text, shingle, seed, distinct)[0]


def _mixed(x):
    """Numbers whose bits all depend on all bits of x (numpy uint64)."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, seed: int = SEED, distinct: bool = False, count: int = 1) -> DataFrame:
    """doc_id, fps (array<long>) and text_hash of every row."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_parts(batches):
            fps = [fingerprint_set(t.as_py(), shingle, seed, distinct, count) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.list_(pa.int64())), b.column(2)], names=["doc_id", "fps", "text_hash"])

    return rows.mapInArrow(per_batch, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fps array<long>, text_hash long")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The tables' masks, as signed 64-bit numbers: positions get the vectors 1, 2, ... in turn."""
    n = 1 << (radius + 1)
    masks = []
    for v in range(1, n):
        mask = sum(1 << bit for bit in range(64) if (v & (bit % (n - 1) + 1)).bit_count() & 1)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def spanning_links(fps, radius: int) -> list[tuple[int, int]]:
    """Pairs of positions in fps (numpy uint64, all different) that connect what the radius connects.

    A row's turn compares it with all rows at once. The row nearest the bitwise majority comes first,
    so that a dense group falls together soon. Rows of the largest group need no turn: each link that
    leaves that group is found from its other end.
    """
    import numpy as np

    n = len(fps)
    bits = np.unpackbits(fps.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    centre = np.packbits(bits.sum(0) * 2 > n, bitorder="little").view(np.uint64)[0]
    order = np.argsort(np.bitwise_count(fps ^ centre), kind="stable")
    label, size, done = np.arange(n), np.ones(n, np.int64), np.zeros(n, bool)
    links: list[tuple[int, int]] = []
    turns = order[:1]
    while len(turns):
        for i in turns:
            if len(turns) > 1 and label[i] == size.argmax():
                continue
            done[i] = True
            near = np.nonzero(np.bitwise_count(fps ^ fps[i]) <= radius)[0]
            for other, at in zip(*np.unique(label[near], return_index=True)):
                mine = label[i]
                if other != mine and size[other]:
                    links.append((int(i), int(near[at])))
                    keep, drop = (mine, other) if size[mine] >= size[other] else (other, mine)
                    label[label == drop] = keep
                    size[keep] += size[drop]
                    size[drop] = 0
        turns = order[(label[order] != size.argmax()) & ~done[order]]
    return links


def _bounds(rows) -> tuple:
    """Where the buckets (equal v, key, i, j) of sorted rows start and end."""
    import numpy as np

    cut = np.nonzero((rows[1:, :4] != rows[:-1, :4]).any(1))[0] + 1
    return np.r_[0, cut], np.r_[cut, len(rows)]


def _whole_buckets(batches: Iterator[pa.RecordBatch], width: int):
    """The rows of the batches as arrays of numbers that hold whole buckets."""
    import numpy as np

    held = np.zeros((0, width), np.int64)
    for batch in batches:
        rows = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1)])
        last = len(rows)  # where the last bucket, which may go on, begins
        while last and (rows[last - 1, :4] == rows[-1, :4]).all():
            last -= 1
        held = rows[last:]
        if last:
            yield rows[:last]
    if len(held):
        yield held


def _drawn(a, b):
    """A number below 2^32 for each pair, the same whichever comes first."""
    import numpy as np

    mixed = (a.astype(np.uint64) ^ b.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + (a + b).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)


def _all_pairs(group, radius: int):
    """All pairs of ids within the radius of one bucket's rows; None if they are more than FEW for each row."""
    import numpy as np

    fps, ids = np.ascontiguousarray(group[:, 4]).view(np.uint64), group[:, 5]
    n, found, count = len(fps), [], 0
    for k in range(n - 1):
        near = k + 1 + np.nonzero(np.bitwise_count(fps[k + 1 :] ^ fps[k]) <= radius)[0]
        count += len(near)
        if count > FEW * n:
            return None
        found.append(np.stack([np.full(len(near), ids[k]), ids[near]], 1))
    return np.concatenate(found)


def _partners(group, radius: int):
    """For each row of a dense bucket: [partner, its rank] of the row within the radius whose id's hash is least, and of one row for each order of DRAWN; its own id where there is none.

    The ranks are the same in all buckets, so the least of a row's partners over all of them is one for each order.
    """
    import numpy as np

    fps, ids = np.ascontiguousarray(group[:, 4]).view(np.uint64), group[:, 5]
    n = len(fps)
    out = np.empty((n, 1 + len(DRAWN), 2), np.int64)
    out[:, :, 0], out[:, :, 1] = ids[:, None], np.iinfo(np.int64).max
    rank = _drawn(ids, np.full(n, HOOK)).astype(np.int64)
    order = np.argsort(rank, kind="stable")
    free = order  # rows that no row of lesser rank has met
    for other in order[:HOOK_TURNS]:
        free = free[rank[free] > rank[other]]
        near = np.bitwise_count(fps[free] ^ fps[other]) <= radius
        out[free[near], 0, 0], out[free[near], 0, 1] = ids[other], rank[other]
        free = free[~near]
        if not len(free):
            break
    for k, salt in enumerate(DRAWN, 1):
        turn = np.roll(np.argsort(_drawn(ids, np.full(n, salt))), 1)
        other = np.empty(n, np.int64)
        other[turn] = np.roll(turn, 1)
        near = np.nonzero(np.bitwise_count(fps ^ fps[other]) <= radius)[0]
        out[near, k, 0], out[near, k, 1] = ids[other[near]], _drawn(ids[near], ids[other[near]])
    return out


def _bucket_links(radius: int):
    """For rows sorted by bucket: (a, b) of the links that span each bucket."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def links(rows: np.ndarray) -> pa.RecordBatch:
            """rows: columns v, key, i, j, fp, id of whole buckets."""
            starts, ends = _bounds(rows)
            pairs = starts[ends - starts == 2]
            near = pairs[np.bitwise_count((rows[pairs, 4] ^ rows[pairs + 1, 4]).view(np.uint64)) <= radius]
            found = [np.stack([rows[near, 5], rows[near + 1, 5]], 1)]
            for lo, hi in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
                at = spanning_links(np.ascontiguousarray(rows[lo:hi, 4]).view(np.uint64), radius)
                if at:
                    found.append(rows[lo:hi, 5][np.array(at)])
            ids = np.concatenate(found)
            return pa.RecordBatch.from_arrays([pa.array(ids[:, 0], pa.int64()), pa.array(ids[:, 1], pa.int64())], names=["a", "b"])

        yield from map(links, _whole_buckets(batches, 6))

    return per_partition


def _bucket_candidates(radius: int):
    """For rows sorted by bucket: (a, b) of all pairs of a bucket within the radius; of a dense bucket (a, null) with the _partners of a instead."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        width = 2 * (1 + len(DRAWN))
        names = ["a", "b", *(f"{c}{k}" for k in range(1 + len(DRAWN)) for c in "pr")]

        def some(rows: np.ndarray) -> pa.RecordBatch:
            starts, ends = _bounds(rows)
            pairs = starts[ends - starts == 2]
            near = pairs[np.bitwise_count((rows[pairs, 4] ^ rows[pairs + 1, 4]).view(np.uint64)) <= radius]
            few, dense = [np.stack([rows[near, 5], rows[near + 1, 5]], 1)], [np.zeros((0, 1 + width), np.int64)]
            for lo, hi in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
                at = _all_pairs(rows[lo:hi], radius)
                if at is not None:
                    few.append(at)
                else:
                    dense.append(np.concatenate([rows[lo:hi, 5:6], _partners(rows[lo:hi], radius).reshape(hi - lo, width)], 1))
            few, dense = np.concatenate(few), np.concatenate(dense)
            none = pa.nulls(len(few), pa.int64())
            columns = [pa.array(np.r_[few.min(1), dense[:, 0]]), pa.concat_arrays([pa.array(few.max(1)), pa.nulls(len(dense), pa.int64())])]
            return pa.RecordBatch.from_arrays([*columns, *(pa.concat_arrays([none, pa.array(dense[:, k])]) for k in range(1, 1 + width))], names=names)

        yield from map(some, _whole_buckets(batches, 6))

    return per_partition


def candidates(nodes: DataFrame, radius: int, chunk: int, count: int) -> DataFrame:
    """a, b of all pairs within the radius in some bucket that is not dense; a and `others` (b null) of each row of a dense one.

    others: over all of a row's dense buckets one partner for each of a few orders, itself not among them.
    """
    orders = range(1 + len(DRAWN))
    found = dealt_buckets(nodes, count, radius, chunk).mapInArrow(_bucket_candidates(radius), "a long, b long, " + ", ".join(f"p{k} long, r{k} long" for k in orders))
    least = [F.min(F.struct(f"r{k}", f"p{k}")).getField(f"p{k}") for k in orders]
    return found.groupBy("a", "b").agg(F.array_distinct(F.filter(F.array(*least), lambda p: p.isNotNull() & (p != F.col("a")))).alias("others"), least[0].alias("hook"))


def touching_groups(state: DataFrame, radius: int, chunk: int, count: int) -> DataFrame:
    """a, b: links between the groups g of state's rows (id, fps, g) that rows within the radius connect."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for rows in _whole_buckets(batches, 7):
            found = set()
            for lo, hi in zip(*_bounds(rows)):
                names, label, size = np.unique(rows[lo:hi, 6], return_inverse=True, return_counts=True)
                if len(names) < 2:
                    continue
                fps = np.ascontiguousarray(rows[lo:hi, 4]).view(np.uint64)
                joined = np.arange(len(names))  # groups that links of this bucket connect already
                for t in np.nonzero(label != size.argmax())[0]:
                    own = joined[label]
                    near = np.unique(label[(np.bitwise_count(fps ^ fps[t]) <= radius) & (own != own[t])])
                    for g in near:
                        if joined[g] != joined[label[t]]:
                            found.add((int(names[label[t]]), int(names[g])))
                            joined[joined == joined[g]] = joined[label[t]]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return dealt_buckets(state, count, radius, chunk, ("g",)).mapInArrow(per_partition, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def dealt_buckets(nodes: DataFrame, count: int, radius: int, chunk: int, also: tuple[str, ...] = ()) -> DataFrame:
    """v, key, i, j, fp, id and the columns `also` of nodes, once for each fingerprint, table and pair of chunks, sorted by bucket.

    nodes: id and fps, of `count` fingerprints each.
    """
    masks = covering_masks(radius)
    fp = lambda k: F.get("fps", F.lit(k))
    tables = F.explode(F.array(*(F.struct(F.lit(k * len(masks) + v).alias("v"), fp(k).bitwiseAND(F.lit(m).cast("long")).alias("key"), fp(k).alias("fp")) for k in range(count) for v, m in enumerate(masks))))
    rows = nodes.select("id", *also, tables.alias("t")).select("t.v", "t.key", "t.fp", "id", *also)
    keys = ["v", "key", "i", "j"]
    large = large_buckets(rows.select("v", "key"), nodes.count() * len(masks) * count, chunk)
    n_large = large.count()
    if not n_large:
        dealt = rows.select("v", "key", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp", "id", *also)
    else:
        parts = F.ceil(F.col("n") / chunk).cast("int")
        own = F.coalesce(F.pmod(F.xxhash64("fp", "id"), parts).cast("int"), F.lit(0))
        meets = F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), parts - 1))
        dealt = rows.join(F.broadcast(large) if n_large <= BROADCAST_ROWS else large, ["v", "key"], "left").select("v", "key", own.alias("c"), F.explode(meets).alias("j"), "fp", "id", *also)
        dealt = dealt.select("v", "key", F.least("c", "j").alias("i"), F.greatest("c", "j").alias("j"), "fp", "id", *also)
    return dealt.repartition(*keys).sortWithinPartitions(*keys)


def links(nodes: DataFrame, radius: int = RADIUS, chunk: int = CHUNK, count: int = 1) -> DataFrame:
    """a, b: links that connect the ids of which some fingerprint differs in at most radius bits.

    nodes: id long and fps array<long>, one row for each text or fingerprint.
    """
    return dealt_buckets(nodes, count, radius, chunk).mapInArrow(_bucket_links(radius), "a long, b long").distinct()


def first_links(found: DataFrame) -> DataFrame:
    """a, b: the pairs of candidates that are checked at first: those of few, and of rows of dense buckets (1 + orders of DRAWN) each."""
    dense = found.filter("b IS NULL")
    ends = dense.select("a").withColumn("_dense", F.lit(True))
    few = found.filter("b IS NOT NULL").select("a", "b").join(ends, "a", "left").join(ends.select(F.col("a").alias("b"), F.col("_dense").alias("_both")), "b", "left")
    few = few.filter("_dense IS NULL OR _both IS NULL").select("a", "b")  # pairs of rows of dense buckets come later
    drawn = dense.select("a", F.explode("others").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return few.union(drawn.distinct())


def reach_of_dense(found: DataFrame, nodes: DataFrame, radius: int, chunk: int, count: int) -> DataFrame:
    """id, fps, near: the nodes of dense buckets, and which of them the radius connects.

    Every node is hooked to the one of least rank that it meets anywhere, which leaves a few trees; a
    second pass over the buckets finds the trees that touch.
    """
    dense = found.filter("b IS NULL").select(F.col("a").alias("id"), "hook")
    hooks = written(dense.select(F.col("id").alias("a"), F.col("hook").alias("b")).filter("a <> b"), "hooks")
    trees = components(hooks).select(F.col("node").alias("id"), F.col("component").alias("g"))
    state = written(nodes.join(dense.select("id"), "id", "left_semi").join(trees, "id", "left").select("id", "fps", F.coalesce("g", "id").alias("g")), "trees")
    touching = components(touching_groups(state, radius, chunk, count)).select(F.col("node").alias("g"), "component")
    out = written(state.join(touching, "g", "left").select("id", "fps", F.coalesce("component", "g").alias("near")), "near")
    for df in (hooks, state):
        removed(df)
    return out


def _owner_table(masks: list[int]):
    """For each of 8 bytes and each value: the tables (bits of two numbers) that the byte's bits keep a pair out of."""
    import numpy as np

    out = np.zeros((8, 256, 2), np.uint64)
    for byte in range(8):
        for value in range(256):
            for v, m in enumerate(masks):
                if (m >> (8 * byte)) & 255 & value:
                    out[byte, value, v >> 6] |= np.uint64(1 << (v & 63))
    return out


def open_pairs(state: DataFrame, count: int, radius: int, chunk: int, hubs: bool) -> DataFrame:
    """id, others: pairs of state's rows within the radius and of different groups g, each listed at both ends.

    hubs: only pairs with one of the rows of a bucket that have most links so far (degree); else all. A
    pair comes from the first fingerprint that links it and the first table that both rows meet in, so it
    comes once. A row of a bucket lists all its partners at once.
    """
    masks = covering_masks(radius)
    kept_out = _owner_table(masks)
    earlier_fps = [f"f{k}" for k in range(count - 1)]
    state = state.select("id", "fps", "g", "degree", *(F.get("fps", F.lit(k)).alias(n) for k, n in enumerate(earlier_fps)))

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            starts = np.r_[0, np.nonzero(a[1:] != a[:-1])[0] + 1]
            ends = pa.array(np.r_[starts, len(a)].astype(np.int32))
            return pa.RecordBatch.from_arrays([pa.array(a[starts]), pa.ListArray.from_arrays(ends, pa.array(b))], names=["id", "others"])

        def first_met(v: int, differ: np.ndarray) -> np.ndarray:
            """Whether table v is the first that keeps none of the bits in which the pairs differ."""
            parts = differ.view(np.uint8).reshape(-1, 8)
            out = np.zeros((len(differ), 2), np.uint64)
            for byte in range(8):
                out |= kept_out[byte, parts[:, byte]]
            free = ~out
            earlier = free[:, v >> 6] & np.uint64((1 << (v & 63)) - 1)
            return (earlier == 0) & ((free[:, 0] == 0) if v >> 6 else True)

        for rows in _whole_buckets(batches, 8 + len(earlier_fps)):
            for lo, hi in zip(*_bounds(rows)):
                fps, ids, g, degree = np.ascontiguousarray(rows[lo:hi, 4]).view(np.uint64), rows[lo:hi, 5], rows[lo:hi, 6], rows[lo:hi, 7]
                names, label, size = np.unique(g, return_inverse=True, return_counts=True)
                if len(names) < 2:
                    continue
                if hubs:
                    turns = np.argsort(-degree, kind="stable")[:FEW]
                    turns = turns[degree[turns] > 0]
                else:
                    turns = np.nonzero(label != size.argmax())[0]
                taken = np.zeros(hi - lo, bool)
                taken[turns] = True
                space, v = divmod(int(rows[lo, 0]), len(masks))
                before = np.ascontiguousarray(rows[lo:hi, 8 : 8 + space]).view(np.uint64)
                found, held = [], 0
                for t in turns:
                    near = np.nonzero((np.bitwise_count(fps ^ fps[t]) <= radius) & (label != label[t]))[0]
                    if space and len(near):
                        near = near[(np.bitwise_count(before[near] ^ before[t]) > radius).all(1)]
                    if v:
                        near = near[first_met(v, fps[near] ^ fps[t])]
                    if len(near):
                        found.append((np.full(len(near), ids[t]), ids[near]))
                        # The other ends that take no turn of their own list the pair too.
                        rest = near[~taken[near]]
                        found.append((ids[rest], np.full(len(rest), ids[t])))
                        held += 2 * len(near)
                    if held > 1 << 20:
                        yield batch(*map(np.concatenate, zip(*found)))
                        found, held = [], 0
                if found:
                    yield batch(*map(np.concatenate, zip(*found)))

    return dealt_buckets(state, count, radius, chunk, ("g", "degree", *earlier_fps)).mapInArrow(per_partition, "id long, others array<long>")


def alike_pairs(pairs: DataFrame, state: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """a, b: links that connect what the pairs whose shingles agree to `least` connect.

    The nodes of a component of near fingerprints are cut into chunks by what their shingles number; a task
    holds the shingles of two chunks at most, and only of nodes that have a pair there.
    """
    size = state.join(sets.select("id", F.size("shingles").alias("size")), "id").groupBy("near").agg(F.ceil(F.sum("size") / SET_SHINGLES).cast("int").alias("parts"))
    large = written(size.filter("parts > 1"), "parts")  # at most one for each SET_SHINGLES shingles
    large = F.broadcast(large) if large.count() <= BROADCAST_ROWS else large
    part = lambda id_: F.pmod(F.xxhash64(F.lit("sets"), id_), F.col("parts")).cast("int")
    of = pairs.join(state.select("id", "near"), "id").join(large, "near", "left").fillna(1, ["parts"])
    of = of.withColumn("to", F.explode(F.array_distinct(F.transform("others", part)))).withColumn("c", part(F.col("id")))
    of = of.withColumn("others", F.filter("others", lambda o: part(o) == F.col("to"))).select("near", F.least("c", "to").alias("i"), F.greatest("c", "to").alias("j"), "id", "others")
    of = of.groupBy("near", "i", "j", "id").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))

    def check(block: pa.Table) -> pa.Table:
        import numpy as np

        ids = block.column("id").to_numpy()
        lists = block.column("shingles").combine_chunks()
        ends = lists.offsets.to_numpy()
        _, codes = np.unique(lists.values.to_numpy()[ends[0] : ends[-1]], return_inverse=True)
        ends = ends - ends[0]
        size = np.diff(ends)
        order = np.argsort(ids)
        label, found = np.arange(len(ids)), []
        mask = np.zeros(int(codes.max(initial=-1)) + 1, bool)
        for k, others in enumerate(block.column("others")):
            near = order[np.searchsorted(ids[order], others.values.to_numpy())]
            near = near[(near > k) & (label[near] != label[k])]
            near = near[(size[near] >= least * size[k]) & (size[k] >= least * size[near])]
            if not len(near):
                continue
            mask[codes[ends[k] : ends[k + 1]]] = True
            if 4 * len(near) > len(ids):
                sums = np.r_[0, np.cumsum(mask[codes])]
                same = sums[ends[near + 1]] - sums[ends[near]]
            else:
                same = np.array([np.count_nonzero(mask[codes[ends[o] : ends[o + 1]]]) for o in near])
            mask[codes[ends[k] : ends[k + 1]]] = False
            for o in near[same / (size[near] + size[k] - same) >= least]:
                if label[o] != label[k]:
                    found.append((ids[k], ids[o]))
                    label[label == label[o]] = label[k]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return of.join(sets, "id").groupBy("near", "i", "j").applyInArrow(check, "a long, b long")


def large_buckets(rows: DataFrame, n: int, chunk: int) -> DataFrame:
    """v, key, n of the buckets of over chunk rows.

    Buckets are first counted by cells of their hash, which are few; only those in a cell that could
    hold a large bucket are counted one by one.
    """
    cell = F.pmod(F.xxhash64("v", "key"), F.lit(max(1 << 10, 4 * n // chunk))).alias("cell")
    full = written(rows.groupBy(cell).agg(F.count("*").alias("n")).filter(F.col("n") > chunk).select("cell"), "cells")
    n_full = full.count()
    if not n_full:
        return full.select(F.lit(0).alias("v"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("n"))
    inside = rows.withColumn("cell", cell).join(F.broadcast(full) if n_full <= BROADCAST_ROWS else full, "cell", "left_semi")
    return written(inside.groupBy("v", "key").agg(F.count("*").alias("n")).filter(F.col("n") > chunk), "large")


def near_duplicate_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE, distinct: bool = False) -> DataFrame:
    """key, fp and component_id, the smallest id that links reach, of every row."""
    prints = fingerprints(docs, key, text, shingle, distinct=distinct).select(F.col("doc_id").cast("long").alias("doc_id"), F.get("fps", F.lit(0)).alias("fp"))
    prints = written(prints, "fingerprints")
    # A fingerprint is its own node, so that it links whether or not a row with an id has it.
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = components(links(nodes.select(F.col("fp").alias("id"), F.array("fp").alias("fps")), radius))
    of = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    of = written(of, "components")
    names = of.groupBy("component").agg(F.min("least").alias("component_id"))
    of = of.join(names, "component").select("fp", "component_id")
    return prints.join(of, "fp", "left").select(F.col("doc_id").alias(key), "fp", "component_id")


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """id, shingles (hashes of the different runs of `words` words; of all words, if fewer) of id and text."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for b in batches:
            sets = []
            for text in b.column(1):
                w = (text.as_py() or "").encode().lower().split()
                runs = set(zip(*(w[i:] for i in range(words)))) if len(w) >= words else {tuple(w)}
                sets.append([h - (1 << 64) if (h := xxh64_intdigest(b" ".join(r), SEED)) >> 63 else h for r in runs])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])

    return texts.select("id", "text").mapInArrow(per_batch, "id long, shingles array<long>")


def sets_of_ends(found: DataFrame, also: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """id, shingles of the texts that links or `also` name."""
    ends = found.select(F.col("a").alias("id")).union(found.select(F.col("b").alias("id"))).union(also).distinct()
    named = written(nodes.join(ends, "id", "left_semi").select("id", "least", "text_hash"), "ends")
    n = named.count()
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    # Rows that repeat an id and a text are one text.
    rows = rows.join(F.broadcast(named) if n <= BROADCAST_ROWS else named, (F.col("hash") == F.col("text_hash")) & F.col("doc_id").eqNullSafe(F.col("least"))).select("id", "text").dropDuplicates(["id"])
    return written(shingle_sets(rows, words), "shingles")


def similar_links(found: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The links (a, b) whose texts share at least `least` of their different runs of words."""
    left, right = (sets.select(F.col("id").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    share = F.size(F.array_intersect("sa", "sb")) / F.size(F.array_union("sa", "sb"))
    return found.join(left, "a").join(right, "b").filter(share >= least).select("a", "b")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE, distinct: bool = False, count: int = 1, words: int = 5, least: float = 0.8, chunk: int = CHUNK) -> DataFrame:
    """One row of docs for each group of texts that links connect: the row with the smallest id.

    A link counts if its two texts share at least `least` of their runs of `words` words. Equal texts are
    one text. Null ids come after all others. Of rows that share id and text one stays, no matter which;
    of different texts with the group's smallest id the one whose text has the least hash. Every pair
    within the radius is checked, unless checked pairs connect it already: in dense buckets a few pairs
    are checked first, then those with the rows that have most links, and last all pairs between what are
    still different groups.
    """
    prints = fingerprints(docs, key, text, shingle, distinct=distinct, count=count)
    prints = written(prints.select(F.col("doc_id").cast("long").alias("doc_id"), "fps", "text_hash"), "fingerprints")
    nodes = prints.groupBy("fps", "text_hash").agg(F.min("doc_id").alias("least"))
    nodes = written(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    removed(prints)
    met = written(candidates(nodes.select("id", "fps"), radius, chunk, count), "candidates")
    found = written(first_links(met), "links")
    dense = met.filter("b IS NULL").select(F.col("a").alias("id"))
    sets = sets_of_ends(found, dense, nodes, docs, key, text, words)
    alike = written(similar_links(found, sets, least), "alike")
    groups, near = components(alike), None
    if not dense.isEmpty():
        near = reach_of_dense(met, nodes.select("id", "fps"), radius, chunk, count)
        for hubs in (True, False):
            degree = alike.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
            state = near.join(groups.select(F.col("node").alias("id"), F.col("component").alias("g")), "id", "left").join(degree, "id", "left")
            state = state.select("id", "fps", "near", F.coalesce("g", "id").alias("g"), F.coalesce("degree", F.lit(0)).alias("degree"))
            split = state.groupBy("near").agg(F.min("g").alias("low"), F.max("g").alias("high")).filter("low < high")
            state = written(state.join(split, "near", "left_semi").select("id", "fps", "near", "g", "degree"), "state")
            if state.isEmpty():
                break
            pairs = written(open_pairs(state, count, radius, chunk, hubs), "pairs")
            before, alike = alike, written(alike.union(alike_pairs(pairs, state, sets, least)), "alike")
            for df in (before, pairs, state):
                removed(df)
            groups = components(alike)
    of = nodes.join(groups, nodes["id"] == groups["node"], "left").select("least", "text_hash", F.coalesce("component", "id").alias("component"))
    first = of.groupBy("component").agg(F.min(F.struct(F.col("least").isNull().alias("none"), F.coalesce("least", F.lit(0)).alias("id"), "text_hash")).alias("first"))
    keys = free_names(docs, "_none", "_id", "_hash")
    kept = written(first.select(*(F.col(f"first.{c}").alias(k) for c, k in zip(("none", "id", "text_hash"), keys))), "kept")
    for df in (nodes, met, found, sets, alike, *([near] if near is not None else [])):
        removed(df)
    id_ = F.col(key).cast("long")
    marked = docs.withColumns(dict(zip(keys, (id_.isNull(), F.coalesce(id_, F.lit(0)), F.xxhash64(F.coalesce(F.col(text), F.lit("")))))))
    return marked.join(kept, keys, "left_semi").dropDuplicates(keys).select(docs.columns)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicate_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
