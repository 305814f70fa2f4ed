"""N-gram Jaccard join: a grouped prefix join.

A document is the set of its distinct word n-grams (64-bit hashes; two different n-grams of one
pair of documents collide with a chance near 1e-13). Documents with equal sets form a class; only
classes go on. Two sets can reach the threshold only if their prefixes, the first
``n - ceil(t n) + 1`` members in one order for all, share a member. The order puts n-grams known
to be frequent last, the most frequent at the very end, so that boilerplate rarely is in a prefix;
the order changes only how many candidates there are, never the result.

Classes with the same size and prefix are one group, and prefixes are joined group by group. The
candidates of a prefix member are first verified as a star: each group against the smallest group
of that list (a longer list has further pivots), and each member of a group against the group's
first. What the stars connect needs no further check. Then only rows of a list outside its largest
component meet the other components, as expanded members: first a few of the largest, then all.

Three bounds drop pairs inside a join, before a set is moved: sizes too far apart; too few members
left behind the shared one in either order (if it is the first that the two share; every pair is
also met there); and bitmaps of about a bit per member, which differ in no more bits than the sets
differ in members. What is left is verified on whole sets. A pair that is never verified lies within one
component already, so the components are those of all links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import (
    bit_filter,
    components,
    free_name,
    narrowed,
    pieces,
    split_by_filter,
    stored,
)

# n-grams ordered by their frequency; the rest of the order is by hash
MAX_FREQUENT = 1 << 19
_FREQUENT = 32
_BATCH_TOKENS = 1_000_000
_CACHED_WORDS = 100_000
_LEAST_BITS = 64
_FILTER_BITS = 1 << 26
_SHORT_LIST, _MORE_PIVOTS = 8, 3
_ROUNDS, _TRIED = 1, 6
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """64-bit hashes of words; forgotten when too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of the word k-grams; of the whole sequence if it is shorter.

    Only ASCII letters are lower-cased and only ASCII white space separates words, which is what
    the methods of byte strings do.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(k, len(h))
    grams = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        grams = grams * _ODD + h[i : len(h) - width + 1 + i]
    return np.unique(_mixed(grams))


def _row_key(id_column: str, text: str) -> Column:
    """A non-negative number for a row's id and text."""
    return F.shiftrightunsigned(F.xxhash64(f"`{id_column}`", f"`{text}`"), 1)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _sets(
    batches: Iterator[pa.RecordBatch], k: int
) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[str]]]:
    """(rows, their sets, a key for each whole set), a few rows at a time.

    Sets take more room than their texts, so they are made anew in each pass and not stored.
    """
    hashes = _Hashes()
    for batch in pieces(batches):
        sets = [shingles(t, k, hashes) for t in batch.column("text").to_pylist()]
        yield batch, sets, [xxhash.xxh128_hexdigest(s.tobytes()) for s in sets]


def _keys_and_counts(docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row_key, n, class_key) per document, and (gram, times): counts of n-grams.

    One pass makes both. All sets are counted, a few million members at a time; a member found
    once in such a batch is left out, so a count is at most the number of batches too low.
    """
    kind = docs.schema["doc_id"].dataType
    names = ["doc_id", "row_key", "n", "class_key", "gram", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, id_type = 0, None

        def counted() -> pa.RecordBatch:
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            often = np.flatnonzero(counts > 1)
            types = (id_type, pa.int64(), pa.int64(), pa.string())
            columns = [pa.nulls(len(often), t) for t in types]
            columns.append(pa.array(grams[often].view(np.int64)))
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts[often].astype(np.int64))], names
            )

        for batch, sets, class_keys in _sets(batches, k):
            id_type = batch.column("doc_id").type
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(class_keys, pa.string()),
                    pa.nulls(len(sets), pa.int64()),
                    pa.nulls(len(sets), pa.int64()),
                ],
                names,
            )
            for grams in sets:
                held.append(grams)
                size += len(grams)
                if size >= _BATCH_TOKENS:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    rows = docs.select("doc_id", "text", _row_key("doc_id", "text").alias("row_key")).mapInArrow(
        run,
        f"doc_id {kind.simpleString()}, row_key long, n long, class_key string, gram long, "
        "times long",
    )
    both = stored(rows, "set_keys")
    keys = both.filter("class_key IS NOT NULL").select("doc_id", "row_key", "n", "class_key")
    return keys, both.filter("gram IS NOT NULL").select("gram", "times")


class Frequent:
    """The most frequent n-grams with their counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        self.grams, self.counts = grams[order], counts[order]
        # by leading bits, so that few others are looked up
        self.may_be = np.zeros(1 << 22, bool)
        self.may_be[self.grams >> np.uint64(42)] = True

    def counts_of(self, grams: np.ndarray) -> np.ndarray:
        """The count of each n-gram, 0 for the others."""
        found = np.zeros(len(grams), np.int64)
        maybe = np.flatnonzero(self.may_be[grams >> np.uint64(42)])
        if len(maybe):
            place = np.searchsorted(self.grams, grams[maybe])
            place[place == len(self.grams)] = 0
            hit = self.grams[place] == grams[maybe]
            found[maybe[hit]] = self.counts[place[hit]]
        return found


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most ``MAX_FREQUENT`` n-grams and their counts."""
    found = (
        counts.groupBy("gram")
        .agg(F.sum("times").alias("n"))
        .filter(F.col("n") > _FREQUENT)
        .orderBy(F.desc("n"), "gram")
        .limit(MAX_FREQUENT)
        .toPandas()
    )
    return found["gram"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)


def _bitmap(grams: np.ndarray) -> np.ndarray:
    """The parity of members per hash class, as 64-bit numbers; a class for one or two members.

    Two unrelated sets of n members differ in n / 4 bits or more, sets at a threshold of 0.8 in at
    most n / 4.5. Two bitmaps differ in at most as many bits as their sets differ in members. The number of
    classes is a power of two, so the larger bitmap of a pair folds onto the smaller one.
    """
    size = max(_LEAST_BITS, 1 << (len(grams).bit_length() - 1))
    place = (grams >> np.uint64(20)).astype(np.int64) & (size - 1)
    odd = np.bincount(place, minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _number_lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0] + [len(r) for r in rows])
    values = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _classes(docs: DataFrame, rows: DataFrame, counts: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, class_key, row_key, n, group_key, prefix, bits): a row per set of at least a member.

    Only one row of each class has to be read, so the others are kept back by a bit filter where it
    can tell them apart; copies that pass it are reduced to one by the aggregation.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_frequent(counts))
    first_rows = rows.filter("n > 0").groupBy("class_key").agg(F.min("row_key").alias("row_key"))
    first_rows = stored(first_rows, "first_rows")
    among = bit_filter(first_rows, "row_key", first_rows.count(), _FILTER_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Frequent(*sent.value)
        for batch, sets, class_keys in _sets(_picked(batches, among), k):
            full = [i for i, grams in enumerate(sets) if len(grams)]
            prefixes, keys, bits = [], [], []
            for grams in (sets[i] for i in full):
                p = prefix_length(len(grams), percent)
                prefix = grams[:p]
                if frequent.counts_of(prefix).any():
                    prefix = grams[np.lexsort((grams, frequent.counts_of(grams)))[:p]]
                prefixes.append(prefix.view(np.int64))
                key = len(grams).to_bytes(8, "little") + prefix.tobytes()
                keys.append(hashlib.blake2b(key, digest_size=16).hexdigest())
                bits.append(_bitmap(grams))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([class_keys[i] for i in full], pa.string()),
                    batch.column("row_key").take(pa.array(full, pa.int64())),
                    pa.array([len(sets[i]) for i in full], pa.int64()),
                    pa.array(keys, pa.string()),
                    *map(_number_lists, (prefixes, bits)),
                ],
                ["class_key", "row_key", "n", "group_key", "prefix", "bits"],
            )

    found = _keyed_texts(docs).mapInArrow(
        run,
        "class_key string, row_key long, n long, group_key string, prefix array<long>, "
        "bits array<long>",
    )
    names = ("row_key", "n", "group_key", "prefix", "bits")
    first = found.groupBy("class_key").agg(*(F.first(c).alias(c) for c in names))
    return stored(first.withColumn("node", F.monotonically_increasing_id()), "classes")


def _keyed_texts(docs: DataFrame) -> DataFrame:
    return docs.select("text", _row_key("doc_id", "text").alias("row_key"))


def _picked(
    batches: Iterator[pa.RecordBatch], among: Callable[[np.ndarray], np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """The rows whose ``row_key`` passes a filter."""
    for batch in batches:
        yield batch.filter(pa.array(among(batch.column("row_key").to_numpy())))


def _long_enough(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _enough_behind(x: str, y: str, percent: int) -> Column:
    """Whether the members from the shared one on can make the overlap that is needed."""
    left = F.least(F.col(f"{x}.n") - F.col(f"{x}.pos"), F.col(f"{y}.n") - F.col(f"{y}.pos"))
    return left * (100 + percent) >= (F.col(f"{x}.n") + F.col(f"{y}.n")) * percent


def _close(x: str, y: str, percent: int) -> Column:
    """Length and bitmap filter for rows aliased ``x`` and ``y`` that hold n and bits.

    Sets that are long enough for each other have bitmaps of one size, or one is twice the other.
    """
    differ = (
        f"aggregate(sequence(0, least(size({x}.bits), size({y}.bits)) - 1), 0, (total, word) -> total + "
        f"bit_count({{0}} ^ {{1}}))"
    ).format(*(_folded(a, b) for a, b in ((x, y), (y, x))))
    a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
    close = F.expr(differ) * (100 + percent) <= (a + b) * (100 - percent)
    return _long_enough(a, b, percent) & close


def _folded(x: str, y: str) -> str:
    """SQL for one ``word`` of the bitmap of ``x``, folded onto that of ``y`` if it is longer."""
    more = f"size({x}.bits) > size({y}.bits)"
    return f"({x}.bits[word] ^ IF({more}, {x}.bits[word + size({y}.bits)], 0L))"


def _verified(
    pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int
) -> DataFrame:
    """Those of the distinct pairs (a, b) of nodes whose whole sets reach the threshold.

    Bitmaps leave few others; if they leave none, no text is read. Only the texts of classes that are in a pair are cut into n-grams
    again, and a set is moved once for itself and once for each pair it is the second of.
    """
    known = classes.select("node", "n", "bits", "class_key", "row_key")
    pairs = stored(
        pairs.join(known.alias("p"), F.col("a") == F.col("p.node"))
        .join(known.alias("q"), F.col("b") == F.col("q.node"))
        .filter(_close("p", "q", percent))
        .select(
            "a",
            "b",
            *(F.col(f"{x}.{c}").alias(f"{c}_{x}") for x in "pq" for c in ("class_key", "row_key")),
        ),
        "near_pairs",
    )
    if pairs.isEmpty():
        return pairs.select("a", "b")
    needed = (
        pairs.select(F.col("row_key_p").alias("row_key"))
        .union(pairs.select("row_key_q"))
        .distinct()
    )
    needed = stored(needed, "needed_rows")
    among = bit_filter(needed, "row_key", needed.count(), _FILTER_BITS)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets, class_keys in _sets(_picked(batches, among), k):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(class_keys, pa.string()),
                    _number_lists([grams.view(np.int64) for grams in sets]),
                ],
                ["class_key", "grams"],
            )

    sets = (
        _keyed_texts(docs)
        .mapInArrow(likely, "class_key string, grams array<long>")
        .groupBy("class_key")
        .agg(F.first("grams").alias("grams"))
    )
    side = {
        x: sets.select(
            F.col("class_key").alias(f"class_key_{x}"), F.col("grams").alias(f"grams_{x}")
        )
        for x in "pq"
    }
    both = F.size(F.array_intersect("grams_p", "grams_q"))
    union = F.size("grams_p") + F.size("grams_q") - both
    return (
        pairs.select("a", "b", "class_key_p", "class_key_q")
        .join(side["q"], "class_key_q")
        .join(side["p"], "class_key_p")
        .filter(both * 100 >= union * percent)
        .select("a", "b")
    )


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _posts(classes: DataFrame, others: DataFrame) -> DataFrame:
    """(gram, node, n, pos): the prefix members of the groups' first classes that are shared.

    ``others`` are the nodes that are not the first of their group. Members that occur in one prefix
    only are counted in a shuffle of the members alone, and most of them are left out of all that
    follows by a bit filter; what it lets through makes lists of one row.
    """
    key = F.shiftrightunsigned("gram", 1)
    grams = classes.select(F.explode("prefix").alias("gram")).groupBy("gram").count()
    shared = stored(grams.filter("count > 1").select(key.alias("key")), "shared_members")
    among = bit_filter(shared, "key", shared.count(), _FILTER_BITS)
    node_key = F.shiftrightunsigned(F.xxhash64("node"), 1)
    others = stored(others.select("node", node_key.alias("key")), "other_members")
    is_other = bit_filter(others, "key", others.count(), _FILTER_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            prefix = batch.column("prefix")
            grams = prefix.flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(prefix.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            pos = np.arange(len(grams)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            hit = among((grams.view(np.uint64) >> np.uint64(1)).view(np.int64))
            row, columns = row[hit], {"gram": grams[hit], "pos": pos[hit]}
            for name in ("node", "n", "doubtful"):
                columns[name] = batch.column(name).to_numpy(zero_copy_only=False)[row]
            yield pa.RecordBatch.from_pydict(columns)

    # the first classes are found without moving prefixes; only rows in doubt are looked up
    def doubt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doubtful = pa.array(is_other(batch.column("key").to_numpy()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("node", "n", "prefix")), doubtful],
                ["node", "n", "prefix", "doubtful"],
            )

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(doubt(batches))

    posts = classes.select("node", "n", "prefix", node_key.alias("key")).mapInArrow(
        both, "gram long, pos long, node long, n long, doubtful boolean"
    )
    posts = stored(posts, "posts")
    sure = posts.filter("NOT doubtful")
    rest = posts.filter("doubtful").join(others.select("node"), "node", "left_anti")
    return sure.unionByName(rest).select("gram", "node", "n", "pos")


def linked_classes(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Rows (node, component) of the nodes that have a link."""
    leads = classes.groupBy("group_key").agg(F.min("node").alias("lead"))
    members = stored(
        classes.select("node", "n", "group_key").join(leads, "group_key").select("node", "lead", "n"),
        "members",
    )
    posts = _posts(classes, members.filter("node <> lead"))
    # A list has the smallest group as its pivot; a longer one has more, which differ by list.
    # Lists of the same groups, as the n-grams of one shared passage make them, are one list: that
    # of the member which comes first in the order, and so stands first in every one of the groups.
    own = F.struct("n", "node", "pos")
    lists = (
        posts.groupBy("gram")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.bit_xor(F.xxhash64("node")).alias("mark"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("other_mark"),
            F.sum("pos").alias("places"),
        )
        .filter("size > 1")
    )
    chosen = (
        lists.groupBy("size", "mark", "other_mark")
        .agg(F.min(F.struct("places", "gram"))["gram"].alias("gram"))
        .select("gram", "size")
    )
    listed = stored(posts.join(chosen, "gram"), "listed")
    more = [F.when(F.col("size") > _SHORT_LIST, F.col(f"p{i}.own")) for i in range(_MORE_PIVOTS)]
    pivots = F.explode(F.array_distinct(F.array_compact(F.array("first", *more)))).alias("pivot")
    seeds = listed.groupBy("gram", "size").agg(
        F.min(own).alias("first"),
        *(
            F.min(F.struct(F.xxhash64("node", "gram", F.lit(i)), own.alias("own"))).alias(f"p{i}")
            for i in range(_MORE_PIVOTS)
        ),
    )

    # Stars
    starred = listed.alias("row").join(
        seeds.select(F.col("gram").alias("list"), pivots), F.col("gram") == F.col("list")
    )
    starred = starred.filter(
        (F.col("row.node") != F.col("pivot.node"))
        & _long_enough(F.col("row.n"), F.col("pivot.n"), percent)
        & _enough_behind("row", "pivot", percent)
    )
    star = _pairs(
        starred.select(F.col("row.node").alias("x"), F.col("pivot.node").alias("y")).union(
            members.filter("node <> lead").select("node", "lead")
        )
    )
    links = stored(_verified(star, docs, classes, k, percent), "star_links")
    found = components(links)

    # What the stars have missed is mostly near some other member of the largest component; a few
    # members chosen by hash connect most of it, before all members are tried.
    for round in range(_ROUNDS):
        strays, rows = _open_lists(listed, members, found)
        if rows.isEmpty():
            return found
        seeds = rows.filter("NOT stray").groupBy("kind", "gram").agg(
            *(
                F.min(F.struct(F.xxhash64("node", "gram", F.lit(round), F.lit(i)), "n", "node", "pos"))
                .alias(f"p{i}")
                for i in range(_TRIED)
            )
        )
        pivots = F.explode(F.array(*(F.col(f"p{i}") for i in range(_TRIED)))).alias("pivot")
        tried = strays.alias("s").join(
            seeds.select("kind", "gram", pivots).alias("p"),
            (F.col("s.kind") == F.col("p.kind")) & (F.col("s.gram") == F.col("p.gram")),
        )
        tried = tried.filter(
            _long_enough(F.col("s.n"), F.col("pivot.n"), percent)
            & _enough_behind("s", "pivot", percent)
        ).select(F.col("s.node").alias("x"), F.col("pivot.node").alias("y"))
        more = stored(_verified(_pairs(tried), docs, classes, k, percent), "round_links")
        found = _joined_components(found, more)

    strays, rows = _open_lists(listed, members, found)
    if rows.isEmpty():
        return found
    bits = classes.select("node", "bits")
    cross = (
        strays.join(bits, "node").alias("s")
        .join(
            rows.join(bits, "node").alias("r"),
            (F.col("s.kind") == F.col("r.kind"))
            & (F.col("s.gram") == F.col("r.gram"))
            & (F.col("s.component") != F.col("r.component"))
            & (~F.col("r.stray") | (F.col("s.node") < F.col("r.node")))
            & _enough_behind("s", "r", percent)
            & _close("s", "r", percent),
        )
        .select(F.col("s.node").alias("x"), F.col("r.node").alias("y"))
    )
    more = stored(_verified(_pairs(cross), docs, classes, k, percent), "cross_links")
    return _joined_components(found, more)


def _joined_components(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links; those that were found go in as stars, which settle at once."""
    if links.isEmpty():
        return found
    stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(stars.unionByName(links))


def _open_lists(
    listed: DataFrame, members: DataFrame, found: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(strays, all rows) of the lists whose members are not connected yet.

    Rows (kind, gram, node, n, pos, component, stray); groups are expanded into their members, and a
    group whose members are not connected is a list of its own, of kind 1. A stray is outside its
    list's largest component. The two rows of a list of two have met in the star already. There are
    strays if there are rows at all.
    """
    own = members.join(found, "node", "left").select(
        "node", "lead", "n", F.coalesce("component", "node").alias("component")
    )
    ends = own.groupBy("lead").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.count(F.lit(1)).alias("size"),
    )
    split = (
        ends.join(listed.select("gram", F.col("node").alias("lead")), "lead")
        .groupBy("gram")
        .agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.sum("size").alias("size")
        )
        .filter("low <> high AND size > 2")
        .select("gram")
    )
    open_posts = listed.select("gram", F.col("node").alias("lead"), "pos").join(split, "gram")
    # a group that is the only one with its prefix members is a list of its own
    within = ends.filter("low <> high AND size > 2").select(
        F.col("lead").alias("gram"), "lead", F.lit(0).cast("long").alias("pos")
    )
    open_lists = stored(
        open_posts.withColumn("kind", F.lit(0))
        .unionByName(within.withColumn("kind", F.lit(1)))
        .join(own, "lead")
        .select("kind", "gram", "node", "n", "pos", "component"),
        "open_lists",
    )
    counted = open_lists.groupBy("kind", "gram", "component").agg(F.count(F.lit(1)).alias("size"))
    main = counted.groupBy("kind", "gram").agg(
        F.max(F.struct("size", "component"))["component"].alias("main")
    )
    rows = open_lists.join(main, ["kind", "gram"]).withColumn(
        "stray", F.col("component") != F.col("main")
    )
    return rows.filter("stray"), rows


def _labelled(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, row_key, n, component, component_id); no component without a set."""
    rows, counts = _keys_and_counts(docs, words)
    classes = _classes(docs, rows, counts, words, percent)
    linked = linked_classes(docs, classes, words, percent)
    class_ids = (
        rows.filter("n > 0").groupBy("class_key").agg(F.min("doc_id").alias("class_id"))
    )
    labelled = (
        classes.select("class_key", "node")
        .join(class_ids, "class_key")
        .join(linked, "node", "left")
        .select("class_key", "class_id", F.coalesce("component", "node").alias("component"))
    )
    smallest = labelled.groupBy("component").agg(F.min("class_id").alias("component_id"))
    by_class = stored(
        labelled.join(smallest, "component").select(
            F.col("class_key").alias("known_class"), "component", "component_id"
        ),
        "class_components",
    )
    own_class = (F.col("class_key") == F.col("known_class")) & (F.col("n") > 0)
    return rows.join(by_class, own_class, "left").drop("class_key", "known_class")


def similar_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    *,
    words: int = 4,
    percent: int = 85,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents are linked when 100 * intersection >= percent * union of their sets of distinct
    word n-grams. ``component_id`` is the smallest id that links reach, the document's own
    included. A null or empty text has an empty set and no link. Null ids are never the smallest,
    unless there is no other. Rows with equal ids stay separate rows. An empty table gives an
    empty table; other columns of ``docs`` are ignored.
    """
    return _labelled(narrowed(docs, doc_id=id_column, text=text), words, percent).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )


def representatives(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    *,
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document of each component.

    The smallest id stays, null ids last; among different texts under that id one is chosen by
    hash. Documents without words stay, and so do repeated rows of the document that stays.
    """
    labelled = stored(
        _labelled(narrowed(docs, doc_id=id_column, text=text), words, percent)
        .filter("component IS NOT NULL")
        .select("doc_id", "row_key", "component"),
        "component_rows",
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    first = labelled.groupBy("component").agg(F.min_by("row_key", order).alias("first_key"))
    own = free_name(docs.columns, "_row_key")
    gone = stored(
        labelled.join(first, "component")
        .filter("row_key <> first_key")
        .select(F.col("row_key").alias(own))
        .distinct(),
        "gone",
    )
    among = bit_filter(gone, own, gone.count())
    keyed = docs.withColumn(own, _row_key(id_column, text))
    stay, likely = split_by_filter(keyed, own, among)
    return stay.unionByName(likely.join(gone, own, "left_anti")).drop(own)
