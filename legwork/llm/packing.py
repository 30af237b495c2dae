"""Documents packed into sequences of bounded length.

Sizes are whole numbers up to the capacity, so the instance is a histogram with at most
``capacity`` counts, whatever the number of documents. Martello and Toth's reduction
fixes sets that dominate all others of an item, best-fit packs the rest, both on counts:
equal bins are one class with a multiplicity. The pieces then find their bins by their
rank among pieces of the same length.

Nulls, empty texts: one piece holding the end token. Repeated rows are separate pieces.
An empty table gives an empty result. Clashing columns of the input are not carried.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwork.llm.storage import landed
from legwork.llm.tokens import byte_encoder

#: Pieces of one length ranked by one task.
RANKED_ROWS = 50_000

Pattern = tuple[int, ...]


class Sizes:
    """Item counts by size with the sizes in order."""

    def __init__(self, counts: dict[int, int]):
        self.count = {size: n for size, n in counts.items() if n > 0}
        self.order = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            self.order.pop(bisect_left(self.order, size))

    def at_most(self, room: int, without: Pattern = ()) -> int:
        """The largest size that fits and is left beyond ``without``; 0 if none."""
        i = bisect_left(self.order, room + 1) - 1
        while i >= 0 and self.count[self.order[i]] <= without.count(self.order[i]):
            i -= 1
        return self.order[i] if i >= 0 else 0

    def smallest(self, k: int, without: Pattern) -> list[int]:
        found: list[int] = []
        for size in self.order:
            found += [size] * min(k - len(found), self.count[size] - without.count(size))
            if len(found) >= k:
                break
        return found


def dominating(sizes: Sizes, size: int, capacity: int) -> Pattern | None:
    """A set of at most three items with the given one that dominates every other, if one is known."""
    room, own = capacity - size, (size,)
    best = sizes.at_most(room, own)
    if not best:
        return own
    least = sizes.smallest(3, own)
    if best == room or len(least) < 2 or sum(least[:2]) > room:
        return (size, best)
    if len(least) == 3 and sum(least) <= room:
        return None
    # at most two further items fit: one large enough for any two, or a pair led by the largest
    pair = 0
    for a in sizes.order:
        if a >= room:
            break
        if sizes.count[a] > own.count(a) and (b := sizes.at_most(room - a, (size, a))):
            pair = max(pair, a + b)
    if best >= pair:
        return (size, best)
    second = sizes.at_most(room - best, (size, best))
    if second and best + second == pair:
        # no other pair may hold an item larger than the second but not the first
        i = bisect_left(sizes.order, best)
        between = [a for a in sizes.order[:i] if a > second and sizes.count[a] > own.count(a)]
        if not between:
            return (size, best, second)
    return None


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[dict[Pattern, int], dict[int, int]]:
    """Bins fixed by dominance, as pattern counts, and the sizes left.

    Sizes are tried from the largest down; after a pass that fixed something the rest is
    tried again, as fewer items leave more sets dominating.
    """
    fixed: dict[Pattern, int] = defaultdict(int)
    sizes = Sizes(counts)
    changed = True
    while changed and sizes.order:
        changed = False
        for size in reversed(list(sizes.order)):
            while sizes.count.get(size):
                pattern = dominating(sizes, size, capacity)
                if pattern is None:
                    break
                # as long as all its items last, the same set goes on dominating
                times = min(sizes.count[s] // pattern.count(s) for s in set(pattern))
                fixed[pattern] += times
                for s in set(pattern):
                    sizes.take(s, times * pattern.count(s))
                changed = True
    return dict(fixed), dict(sizes.count)


def best_fit(counts: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """Best-fit decreasing: each item to the fullest bin that holds it, else to a new one."""
    bins: dict[int, dict[Pattern, int]] = {}
    rooms: list[int] = []

    def add(room: int, pattern: Pattern, n: int) -> None:
        if room not in bins:
            bins[room] = {}
            insort(rooms, room)
        bins[room][pattern] = bins[room].get(pattern, 0) + n

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            i = bisect_left(rooms, size)
            if i == len(rooms):
                each = min(left, capacity // size)
                opened = left // each
                add(capacity - each * size, (size,) * each, opened)
                left -= opened * each
                continue
            room = rooms[i]
            pattern, there = bins[room].popitem()
            moved = min(left, there)
            if moved < there:
                bins[room][pattern] = there - moved
            if not bins[room]:
                del bins[room]
                rooms.pop(i)
            add(room - size, (*pattern, size), moved)
            left -= moved
    packed: dict[Pattern, int] = defaultdict(int)
    for patterns in bins.values():
        for pattern, n in patterns.items():
            packed[pattern] += n
    return dict(packed)


def plan_bins(counts: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """Number of bins by the sizes they hold."""
    fixed, rest = reduce_instance(counts, capacity)
    plan = defaultdict(int, fixed)
    for pattern, n in best_fit(rest, capacity).items():
        plan[pattern] += n
    return dict(plan)


def slots_of(plan: dict[Pattern, int]) -> dict[str, np.ndarray]:
    """Per size, runs of ranks that go to consecutive bins, sorted by size and first rank."""
    rows, taken, bin_base = [], defaultdict(int), 0
    for pattern, n in plan.items():
        offset = 0
        for size in pattern:
            rows.append((size, taken[size], bin_base, offset))
            taken[size] += n
            offset += size
        bin_base += n
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4)
    return {name: columns[:, i] for i, name in enumerate(("size", "rank", "bin", "offset"))}


def ranked(pieces: DataFrame, size: str, key: list[str], n_rows: int) -> DataFrame:
    """Pieces with ``_rank``, their place among those of the same size, from 0.

    A size may hold most rows, so each is ranked in parts, whose counts give the offsets.
    """
    parts = max(1, -(-n_rows // RANKED_ROWS))
    dealt = pieces.withColumn("_part", F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int"))
    counts = dealt.groupBy(size, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(size).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(size, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(size, "_part").orderBy(*key)) - 1
    return (
        dealt.withColumn("_rank", within)
        .join(offsets, [size, "_part"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
        .drop("_part", "_before")
    )


def pack(pieces: DataFrame, capacity: int, key: list[str], size: str = "length") -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``, replacing columns of these names.

    ``pieces`` should be a stored table: it is read twice. Each size must lie between 1
    and ``capacity``. The plan that every task looks up has at most a few rows for each
    size and pattern; its size depends on the capacity, not on the rows.
    """
    histogram = {row[0]: row[1] for row in pieces.groupBy(size).agg(F.count("*")).collect()}
    if any(n is None or not 1 <= n <= capacity for n in histogram):
        raise ValueError(f"sizes must lie between 1 and {capacity}")
    slots = slots_of(plan_bins(histogram, capacity))
    shared = pieces.sparkSession.sparkContext.broadcast(slots)

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(sizes: pa.Array, ranks: pa.Array) -> pa.Array:
        runs = shared.value
        sizes, ranks = sizes.to_numpy(zero_copy_only=False).astype(np.int64), ranks.to_numpy(zero_copy_only=False)
        if not len(sizes):
            return pa.StructArray.from_arrays([pa.array([], pa.int64())] * 2, ["sequence_id", "offset"])
        span = np.int64(1 << 44)
        at = np.searchsorted(runs["size"] * span + runs["rank"], sizes * span + ranks, "right") - 1
        bins = runs["bin"][at] + ranks - runs["rank"][at]
        return pa.StructArray.from_arrays([pa.array(bins), pa.array(runs["offset"][at])], ["sequence_id", "offset"])

    rows = ranked(pieces.drop("sequence_id", "offset"), size, key, sum(histogram.values()))
    placed = rows.withColumn("_at", place(F.col(size), F.col("_rank")))
    return placed.withColumns({"sequence_id": F.col("_at.sequence_id"), "offset": F.col("_at.offset")}).drop("_at", "_rank")


def cut_pieces(text: Column, path: str, capacity: int, end_id: int) -> Column:
    """Array of ``piece, start, length, ids_crc32`` of a text's ids with the end token.

    A document over the capacity is cut from its end into full pieces; its first piece
    holds what is left.
    """

    @F.arrow_udf("array<struct<piece: int, start: bigint, length: bigint, ids_crc32: bigint>>")
    def cut(texts: pa.Array) -> pa.Array:
        encoder, end = byte_encoder(path), end_id.to_bytes(4, "little")
        offsets, starts, numbers, lengths, sums = [0], [], [], [], []
        for text in texts:
            ids = encoder.encode(text.as_py() or "") + end
            n, start, number = len(ids) // 4, 0, 0
            length = (n - 1) % capacity + 1
            while start < n:
                starts.append(start)
                numbers.append(number)
                lengths.append(length)
                sums.append(zlib.crc32(ids[4 * start : 4 * (start + length)]))
                start, number, length = start + length, number + 1, capacity
            offsets.append(len(starts))
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        columns = [pa.array(x, t) for x, t in zip((numbers, starts, lengths, sums), types)]
        rows = pa.StructArray.from_arrays(columns, ["piece", "start", "length", "ids_crc32"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    return cut(text)


def pack_documents(
    docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: the key, ``piece, start, length, ids_crc32, sequence_id, offset``.

    The pieces are stored under the shared folder first, as the plan and the placing both
    read them and texts should be encoded once.
    """
    pieces = landed(
        docs.select(F.col(key), F.explode(cut_pieces(F.col(text), path, capacity, end_id)).alias("_p")).select(key, "_p.*")
    )
    return pack(pieces, capacity, [key, "piece", "start", "ids_crc32"])
