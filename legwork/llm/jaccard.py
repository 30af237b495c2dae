"""Near-duplicate documents by a grouped prefix join on word shingles.

Two texts link when the Jaccard similarity of their sets of 5-word shingles is at least
0.8. Equal sets are one node. Shingles have one global order, frequent ones last; similar
sets share a shingle among their first ``n - ceil(0.8 n) + 1``, their prefix. Nodes with
the same prefix and size are one group. Groups that share a prefix shingle, and pass the
size and position filters, are candidates; their members are then verified on whole sets.

Only connectivity is asked for, so a bucket of groups that share a shingle need not emit
all its pairs. In a few turns each group of a crowded bucket meets one pivot, that of most
of its buckets; the links make components. Then the candidate pairs across components are
left, and all of them are verified, so no link between components is lost.

Null texts and texts without words have no shingles and are alone; fewer than five words
are one shingle. Ties and repeated rows are copies. Rows without a key have no component.
An empty table gives an empty result. Only the key and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwork.llm.chars import mix
from legwork.llm.components import components
from legwork.llm.key_filter import maybe_in
from legwork.llm.recurring import in_batches, runs_of, taken
from legwork.llm.storage import landed

WORDS = 5
#: The least similarity as a fraction.
SIMILAR, OF = 4, 5
#: About so many shingles, the most frequent, are put in order by how many documents hold
#: them; the rest come first, by their hash.
ORDERED = 1 << 20
#: A shingle in more than this part of the documents is in the order in any case. There are
#: at most ``FREQUENT`` times as many as a document has on average, whatever the corpus.
FREQUENT = 2_000
#: Shingles counted together before they leave a task, and the least count that leaves it.
COUNTED, LEAST = 1 << 22, 2
#: Steps by which the least count of an ordered shingle grows when it doubles.
LEVELS = 8

#: Buckets of at least so many groups are first joined through pivots, in so many turns.
CROWD, TURNS = 8, 2

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of a text's distinct shingles, ascending."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    found = np.full(n, width, np.uint64)
    for i in range(width):
        found = found * _STEP + hashes[i : i + n]
    return np.unique(mix(found))


def prefix_size(n: int) -> int:
    return n - -(-n * SIMILAR // OF) + 1 if n else 0


def _digest(values: np.ndarray, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(values.tobytes(), seed) - (1 << 63)


def frequent_shingles(docs: DataFrame, text: str, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``ORDERED`` most frequent shingles, ascending, and how many documents hold each.

    Each task counts all its shingles and reports those that recur; a frequent one recurs
    in some task. The counts only order shingles, so what a task leaves out costs no link.
    The driver sees the counts by level and the shingles that are put in order.
    """

    def count(batches):
        held, size = [], 0

        def flush():
            found = taken(held)
            starts, n = runs_of(found)
            kept = n >= LEAST
            return in_batches(pa.record_batch([pa.array(found[starts[kept]].view(np.int64)), pa.array(n[kept])], ["shingle", "n"]))

        for batch in batches:
            for value in batch.column(0):
                held.append(shingles(value.as_py()))
                size += len(held[-1])
                if size > COUNTED:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    counts = docs.select(text).mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    counts = landed(counts.withColumn("level", F.floor(F.log2("n") * LEVELS)))
    lowest, held = None, 0
    for level, n in sorted(counts.groupBy("level").agg(F.count("*").alias("n")).collect(), reverse=True):
        held += n
        if held > ORDERED:
            break
        lowest = level
    in_order = F.col("n") > n_docs / FREQUENT
    table = counts.where(in_order if lowest is None else in_order | (F.col("level") >= lowest)).select("shingle", "n").toArrow()
    found, n = table.column("shingle").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(found)
    return found[order], n[order]


_SET = "struct<n: bigint, set_id: bigint, prefix_id: bigint, n_rare: int, prefix: array<bigint>>"


def described(text: Column, frequent: tuple[np.ndarray, np.ndarray], spark) -> Column:
    """Size, identity and ordered prefix of each text's set; ``n_rare`` of the prefix are not in the order of frequency."""
    shared = spark.sparkContext.broadcast(frequent)

    @F.arrow_udf(_SET)
    def describe(texts: pa.Array) -> pa.Array:
        common, counts = shared.value
        sizes, ids, prefix_ids, rare_sizes, prefixes, ends = [], [], [], [], [], [0]
        for value in texts:
            found = shingles(value.as_py())
            if len(common):
                at = np.minimum(np.searchsorted(common, found), len(common) - 1)
                hot = common[at] == found
            else:
                hot = np.zeros(len(found), bool)
            often = found[hot]
            if len(often) > 1:
                often = often[np.argsort(counts[at[hot]], kind="stable")]
            prefix = np.concatenate([found[~hot], often])[: prefix_size(len(found))]
            sizes.append(len(found))
            ids.append(_digest(found))
            prefix_ids.append(_digest(prefix, len(found)))
            rare_sizes.append(min(len(prefix), len(found) - len(often)))
            prefixes.append(prefix)
            ends.append(ends[-1] + len(prefix))
        flat = np.concatenate([*prefixes, np.zeros(0, np.uint64)]).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        columns = [pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(prefix_ids, pa.int64()), pa.array(rare_sizes, pa.int32())]
        return pa.StructArray.from_arrays([*columns, lists], ["n", "set_id", "prefix_id", "n_rare", "prefix"])

    return describe(text)


def whole_set(text: Column) -> Column:
    """Identity and all shingles of each text's set."""

    @F.arrow_udf("struct<set_id: bigint, tokens: array<bigint>>")
    def collect(texts: pa.Array) -> pa.Array:
        sets = [shingles(t.as_py()) for t in texts]
        ends = np.cumsum([0, *map(len, sets)])
        flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        return pa.StructArray.from_arrays([pa.array([_digest(s) for s in sets], pa.int64()), lists], ["set_id", "tokens"])

    return collect(text)


def can_link(n: str, position: str, other_n: str, other_position: str) -> Column:
    """Size and position filters: the most that two sets can share from a common shingle on."""
    a, b = F.col(n), F.col(other_n)
    needed = F.ceil((a + b) * SIMILAR / (SIMILAR + OF) - F.lit(1e-9))
    rest = F.least(a - F.col(position), b - F.col(other_position))
    return (F.least(a, b) * OF >= F.greatest(a, b) * SIMILAR) & (rest >= needed)


def links_of(pairs: DataFrame, members: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The pairs ``a, b`` of set ids whose whole sets are similar enough."""
    wanted = landed(pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "set_id"))
    first = landed(members.join(wanted, "set_id").select("set_id", F.col("first_key").alias(key)))
    texts = docs.select(key, text).where(maybe_in(key, first)).join(first.withColumnRenamed("set_id", "_want"), key)
    found = texts.dropDuplicates([key, text]).select("_want", whole_set(F.col(text)).alias("s"))
    sets = found.where("s.set_id = _want").select("s.*")
    left = sets.select(F.col("set_id").alias("a"), F.col("tokens").alias("_left"))
    right = sets.select(F.col("set_id").alias("b"), F.col("tokens").alias("_right"))
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("_left", "_right"))
    union = F.size("_left") + F.size("_right") - shared
    return both.where(shared * OF >= union * SIMILAR).select("a", "b")


def candidate_buckets(groups: DataFrame) -> DataFrame:
    """``shingle, gid, n, position, crowd`` of the prefix shingles that two groups or more share.

    ``crowd`` is the number of groups in the bucket. A frequent shingle's bucket may be
    large: its groups are counted in the tasks and the count joined back, where Spark can
    split it. The buckets of all others are small.
    """
    posted = groups.select("gid", "n", "n_rare", F.posexplode("prefix").alias("position", "shingle"))
    columns = ["shingle", "gid", "n", "position"]
    here = Window.partitionBy("shingle")
    rare = posted.where("position < n_rare").select(*columns, F.count("*").over(here).alias("crowd"))
    hot = posted.where("position >= n_rare").select(columns)
    shared = hot.groupBy("shingle").agg(F.count("*").alias("crowd"))
    columns = [*columns, "crowd"]
    return rare.where("crowd > 1").select(columns).unionByName(hot.join(shared.where("crowd > 1"), "shingle").select(columns))


def with_reach(buckets: DataFrame) -> DataFrame:
    """Buckets with ``reach``, how many other groups each group meets in all of its buckets.

    Of near copies of one text, that with the fewest changes of its own reaches most.
    """
    return buckets.join(buckets.groupBy("gid").agg(F.sum("crowd").alias("reach")), "gid")


def placed_members(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``gid, set_id, part``: each member's component so far."""
    if labels is None:
        return members.select("gid", "set_id", F.col("set_id").alias("part"))
    named = labels.select(F.col("node").alias("set_id"), "label")
    return members.join(named, "set_id", "left").select("gid", "set_id", F.coalesce("label", "set_id").alias("part"))


def parted_buckets(buckets: DataFrame, placed: DataFrame) -> DataFrame:
    """Buckets with the range of components, ``low`` to ``high``, that each group's members are in."""
    spans = placed.groupBy("gid").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    return buckets.join(spans, "gid")


def star_pairs(buckets: DataFrame, placed: DataFrame, turn: int) -> DataFrame:
    """Members of groups in crowded buckets against the pivot of most of the group's buckets.

    The pivot of a bucket is at first its group of the greatest reach, then one by a hash
    that changes with the turn. Groups in the pivot's component are left out, and so are
    buckets within one component.
    """
    posted = parted_buckets(buckets.where(F.col("crowd") >= CROWD), placed)
    order = F.xxhash64("gid", F.lit(turn)) if turn else F.col("reach")
    first = F.max(F.struct(order.alias("order"), "gid", "n", "position", "low")).alias("pivot")
    crowds = posted.groupBy("shingle").agg(first, F.min("low").alias("_low"), F.max("high").alias("_high"))
    crowds = crowds.where(F.col("_low") != F.col("_high")).select("shingle", "pivot")
    meeting = posted.join(crowds, "shingle").withColumns({"_n": F.col("pivot.n"), "_position": F.col("pivot.position")})
    meeting = meeting.where((F.col("gid") != F.col("pivot.gid")) & (F.col("low") != F.col("pivot.low")))
    met = meeting.where(can_link("n", "position", "_n", "_position"))
    times = met.groupBy("gid", F.col("pivot.gid").alias("a")).agg(F.count("*").alias("_times"))
    best = times.groupBy("gid").agg(F.max(F.struct("_times", "a")).alias("_best")).select("gid", F.col("_best.a").alias("a"))
    across = best.join(placed, "gid").select("a", F.col("set_id").alias("b"))
    if turn:
        return across
    return across.union(placed.where("set_id <> gid").select(F.col("gid").alias("a"), F.col("set_id").alias("b")))


def share_enough(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Pairs of groups whose common prefix shingles, and all beyond a prefix, can make them similar.

    Prefixes are a fifth of the sets, so most pairs end here before whole sets move, and
    only prefixes of a pair's groups do.
    """
    wanted = landed(pairs.select("gid").union(pairs.select("o_gid")).distinct())
    prefixes = prefixes.where(maybe_in("gid", wanted))
    left = prefixes.select("gid", F.col("n").alias("_a"), F.col("prefix").alias("_left"))
    right = prefixes.select(F.col("gid").alias("o_gid"), F.col("n").alias("_b"), F.col("prefix").alias("_right"))
    both = pairs.join(right, "o_gid").join(left, "gid")
    beyond = F.greatest(F.col("_a") - F.size("_left"), F.col("_b") - F.size("_right"))
    needed = F.ceil((F.col("_a") + F.col("_b")) * SIMILAR / (SIMILAR + OF) - F.lit(1e-9))
    return both.where(F.size(F.array_intersect("_left", "_right")) + beyond >= needed).select("gid", "o_gid")


def meeting(buckets: DataFrame) -> DataFrame:
    """``gid, o_gid`` of the groups that share a bucket, pass the filters and are not in one component.

    Both sides keep their columns' names, so that the buckets are shuffled once for the two.
    """
    one, two = (lambda c: F.col(f"one.{c}")), (lambda c: F.col(f"two.{c}"))
    differ = (one("low") != two("low")) | (one("high") != two("high")) | (one("low") != one("high"))
    apart = (one("gid") < two("gid")) & differ & can_link("one.n", "one.position", "two.n", "two.position")
    met = buckets.alias("one").join(buckets.alias("two"), one("shingle") == two("shingle")).where(apart)
    return met.select(one("gid"), two("gid").alias("o_gid")).distinct()


def open_pairs(buckets: DataFrame, placed: DataFrame, prefixes: DataFrame) -> DataFrame:
    """All candidate pairs of members that are in different components."""
    posted = parted_buckets(buckets, placed)
    split = posted.groupBy("shingle").agg(F.min("low").alias("_low"), F.max("high").alias("_high")).where("_low <> _high")
    open_buckets = landed(posted.join(split.select("shingle"), "shingle", "left_semi").select("shingle", "gid", "n", "position", "low", "high"))
    groups = share_enough(landed(meeting(open_buckets)), prefixes)
    one = placed.select("gid", F.col("set_id").alias("a"), F.col("part").alias("_a"))
    two = placed.select(F.col("gid").alias("o_gid"), F.col("set_id").alias("b"), F.col("part").alias("_b"))
    across = groups.join(one, "gid").join(two, "o_gid").where("_a <> _b").select("a", "b")
    mixed = placed.groupBy("gid").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("gid")
    apart = one.join(mixed, "gid", "left_semi").join(two.withColumnRenamed("o_gid", "gid"), "gid")
    return across.union(apart.where((F.col("a") < F.col("b")) & (F.col("_a") != F.col("_b"))).select("a", "b"))


#: Tells rows with one key and different texts apart.
_CONTENT = "_content"


def _content(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _components(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Each row's ``key, n, set_id, _content``, and ``set_id, part, component_id`` of all sets with shingles."""
    spark = docs.sparkSession
    rows = docs.select(key, text)
    frequent = frequent_shingles(rows, text, rows.count())
    sets = landed(
        rows.select(key, _content(text).alias(_CONTENT), described(F.col(text), frequent, spark).alias("s"))
        .select(key, _CONTENT, "s.*", F.monotonically_increasing_id().alias("row"))
    )
    filled = sets.where((F.col("n") > 0) & F.col(key).isNotNull())
    nodes = filled.groupBy("set_id").agg(F.min(F.struct(key, "row")).alias("_first"), F.min("n").alias("n"), F.min("prefix_id").alias("prefix_id"))
    nodes = landed(nodes.select("set_id", "n", "prefix_id", F.col(f"_first.{key}").alias("first_key"), F.col("_first.row").alias("row")))
    groups = nodes.groupBy("prefix_id", "n").agg(F.min("set_id").alias("gid"))
    members = landed(nodes.join(groups, ["prefix_id", "n"]).select("set_id", "gid", "n", "first_key", "row"))
    leads = members.where("set_id = gid").select("row", "gid")
    grouped = filled.select("row", "n", "n_rare", "prefix").join(leads, "row")
    buckets = landed(candidate_buckets(grouped))

    buckets = landed(with_reach(buckets))
    links, labels = spark.createDataFrame([], "a bigint, b bigint"), None
    for turn in range(TURNS):
        placed = landed(placed_members(members, labels))
        stars = landed(star_pairs(buckets, placed, turn))
        if stars.isEmpty():
            break
        links = landed(links.union(links_of(stars, members, rows, key, text)))
        labels = components(links)
    placed = landed(placed_members(members, labels))
    rest = landed(open_pairs(buckets, placed, grouped))
    if not rest.isEmpty():
        links = landed(links.union(links_of(rest, members, rows, key, text)))
    labels = components(links)

    parts = members.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").select("set_id", "first_key", F.coalesce("label", "set_id").alias("part"))
    smallest = parts.groupBy("part").agg(F.min("first_key").alias("component_id"))
    return sets.select(key, "n", "set_id", _CONTENT), parts.join(smallest, "part").select("set_id", "part", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id``: the smallest key that links lead to."""
    sets, named = _components(docs, key, text)
    found = sets.join(named, "set_id", "left")
    return found.select(key, F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col(key)).alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: of those with its smallest key, the one with the smallest hashes.

    Rows that share a key but whose texts are not linked are all kept, and so is a text
    without words; equal rows are one. Rows without a key stay as they are.
    """
    sets, named = _components(docs, key, text)
    sets = sets.where(F.col(key).isNotNull())
    first = F.min(F.struct(key, "set_id", _CONTENT)).alias("_first")
    kept = sets.where("n > 0").join(named, "set_id").groupBy("part").agg(first).select(f"_first.{key}", f"_first.{_CONTENT}")
    kept = kept.unionByName(sets.where("n = 0").select(key, _CONTENT)).distinct()
    rows = docs.where(F.col(key).isNotNull()).withColumn(_CONTENT, _content(text)).join(kept, [key, _CONTENT], "left_semi")
    return rows.dropDuplicates([key, _CONTENT]).drop(_CONTENT).select(*docs.columns).unionByName(docs.where(F.col(key).isNull()))
