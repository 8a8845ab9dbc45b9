"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets, then connected groups.

A document's set is that of its shingles of ``words`` words; two sets link when their Jaccard
similarity is at least ``percent`` of 100. Texts with equal sets form a class, told by a 128-bit
digest; everything further works on one text per class.

* Light sets, up to the boundary ``light_limit()``, enumerate subsets of fixed size: two sets of a
  and b shingles link only if they share ``c = ceil(percent (a + b) / (100 + percent))`` of them, so
  every set emits its subsets of the sizes c it can need, and linked sets meet at a common subset.
* Heavy sets use inverted lists. The shingle hashes are cut into more ranges than two linked sets of
  a size class can differ in, so they agree in all shingles of at least one range: the lists are
  kept per (class, range, shingles in it), where a frequent shingle alone makes no list long. A set
  enters only its fullest ranges, those of at least t shingles, with t the most that leaves more
  ranges than it can differ in from any partner: linked sets agree in one that is full enough for
  both, and ranges of few or no shingles, equal by chance, stay out. Light sets near the boundary
  enter the lists as well.
* The boundary is the size at which enumerating costs more than the lists, with a set in a list
  counted as ``CHECK_COST`` entries for the checks it causes.

Sets that share a list meet at the list's smallest set, its hub. The texts of a hub are compared in
full, exactly, on integer counts; a large hub is cut into pieces by hash and compared piece by piece,
so that no task holds a group, and a task gives links that connect what it found linked, not all
pairs. Connected components are found by alternating large-star and small-star steps.

NULL texts and texts without words have an empty set and are linked with nothing. Texts of fewer
words than a shingle are one shingle. Repeated rows are one class, each row with its result. An
empty table gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hemline.llm.common import keep, small_batches, text_key, without

WORDS = 3
PERCENT = 90
CHECK_COST = 8
CLASS_GROWTH = 1.25
#: Ranges a size class has beyond those that linked sets can differ in, as a part of these.
SPARE_RANGES = 6
#: Different sets a task remembers in order to emit the lists of equal sets once.
SEEN = 200_000
#: Shingles of the texts that are compared with each other in one piece.
PIECE = 60_000
BROADCAST_ROWS = 500_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(29)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _SHIFT)) * _MIX
    return values ^ (values >> np.uint64(32))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def shingle_hashes(words: list[bytes], length: int = WORDS) -> np.ndarray:
    """Sorted different 64-bit hashes of the shingles of ``length`` words."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if len(words) < length:
        out = np.array([len(words)], np.uint64)
        for i in range(len(words)):
            out = mixed(out * _ODD + hashes[i:i + 1])
        return out
    out = hashes[: len(hashes) - length + 1]
    for i in range(1, length):
        out = mixed(out * _ODD) + hashes[i: len(hashes) - length + 1 + i]
    return np.unique(mixed(out))


def needed(a: int, b: int, percent: int = PERCENT) -> int:
    """Shingles that sets of a and b must share: 100 I >= percent (a + b - I)."""
    return -(-percent * (a + b) // (100 + percent))


def partner_sizes(a: int, percent: int = PERCENT) -> range:
    """Sizes of sets that can link with a set of a."""
    return range(-(-percent * a // 100), 100 * a // percent + 1)


def subset_sizes(a: int, percent: int = PERCENT) -> list[int]:
    return sorted({c for b in partner_sizes(a, percent) if (c := needed(a, b, percent)) <= min(a, b)})


def most_different(both: int, percent: int = PERCENT) -> int:
    """Shingles in just one of two linked sets of at most ``both`` shingles, counted in each."""
    return (100 - percent) * both // (100 + percent)


@lru_cache(maxsize=None)
def light_limit(percent: int = PERCENT) -> int:
    a = 1
    while sum(math.comb(a + 1, c) for c in subset_sizes(a + 1, percent)) <= CHECK_COST * (most_different(2 * (a + 1), percent) + 1):
        a += 1
    return a


@lru_cache(maxsize=None)
def size_classes(largest: int, percent: int = PERCENT) -> tuple[int, ...]:
    """Lower bounds of the size classes of the lists; linked sets lie in one class or neighbours."""
    edges = [partner_sizes(light_limit(percent) + 1, percent)[0]]
    while edges[-1] <= 100 * largest // percent + largest:
        edges.append(max(edges[-1] * 100 // percent + 2, int(edges[-1] * CLASS_GROWTH)))
    return tuple(edges)


@lru_cache(maxsize=None)
def range_bounds(number: int) -> np.ndarray:
    return np.array([(i << 64) // number for i in range(1, number)], dtype=np.uint64)


def list_keys(hashes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """64-bit keys of all lists a set is in."""
    n, keys = len(hashes), []
    marks = mixed(hashes * _ODD)
    if n <= light_limit(percent):
        total = marks.sum(dtype=np.uint64)
        for c in subset_sizes(n, percent):
            drop = [sum((int(marks[i]) for i in out), 0) for out in itertools.combinations(range(n), n - c)]
            left = total - np.array([d & 0xFFFFFFFFFFFFFFFF for d in drop], np.uint64)
            keys.append(mixed(left ^ mixed(np.full(1, c, np.uint64) * _ODD)))
    edges = size_classes(1 << max(n, 64).bit_length(), percent)
    if n >= edges[0]:
        home = int(np.searchsorted(edges, n, side="right")) - 1
        sums = np.concatenate(([np.uint64(0)], np.cumsum(marks, dtype=np.uint64)))
        partner = partner_sizes(n, percent)[-1]
        for k in (home, home + 1):
            if k > home and partner < edges[k]:
                continue
            most = most_different(2 * (edges[k + 1] - 1), percent)
            number = most + 1 + most // SPARE_RANGES
            cuts = np.concatenate(([0], np.searchsorted(hashes, range_bounds(number)), [n]))
            inside, filled = sums[cuts[1:]] - sums[cuts[:-1]], np.diff(cuts)
            own = most_different(n + min(partner, edges[k + 1] - 1), percent)
            full = filled >= np.sort(filled)[number - 1 - own]
            place = np.arange(number, dtype=np.uint64) + np.uint64(1 + (k << 32))
            keys.append(mixed(inside ^ mixed(place * _ODD))[full])
    return np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)


def _digests(hashes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests of a set; the first, signed, is its short id."""
    first = int(mixed(hashes ^ _ODD).sum(dtype=np.uint64))
    return first, int(mixed(hashes * _ODD + _MIX).sum(dtype=np.uint64))


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def shingle_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_id, short_id) of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, shorts = [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingle_hashes(words_of(text), words)
                first, second = _digests(hashes)
                sizes.append(len(hashes))
                ids.append(f"{first:016x}{second:016x}{len(hashes):x}")
                shorts.append(_signed(first))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(ids, pa.string()),
                 pa.array(shorts, pa.int64())],
                names=["doc_id", "text_key", "n_shingles", "set_id", "short_id"])

    return keyed(docs).mapInArrow(run, "doc_id long, text_key long, n_shingles long, set_id string, short_id long")


def set_lists(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(short_id, list_keys) of the sets, which a task gives once for equal sets.

    The lists are as large as the texts, so they are made from the texts where they are shuffled
    and never written.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            shorts, lists, ends = [], [np.zeros(0, np.int64)], [0]
            for text in batch.column("text").to_pylist():
                hashes = shingle_hashes(words_of(text), words)
                digests = _digests(hashes)
                if digests in seen or not len(hashes):
                    continue
                seen = set() if len(seen) >= SEEN else seen
                seen.add(digests)
                shorts.append(_signed(digests[0]))
                lists.append(list_keys(hashes, percent))
                ends.append(ends[-1] + len(lists[-1]))
            keys = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(shorts, pa.int64()), keys], names=["short_id", "list_keys"])

    return docs.select("text").mapInArrow(run, "short_id long, list_keys array<long>")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), F.col("text"))


def hub_members(lists: DataFrame) -> DataFrame:
    """(hub, short_id): sets that share a list, by the smallest set of the list.

    The entries are shuffled once, and lists of one set end there. A task reads a list of many sets
    row by row and may spill it.
    """
    entries = lists.select("short_id", F.explode("list_keys").alias("key"))
    sharing = Window.partitionBy("key")
    shared = entries.select("short_id", F.min("short_id").over(sharing).alias("hub"), F.max("short_id").over(sharing).alias("other"))
    return shared.where(F.col("hub") < F.col("other")).select("hub", "short_id").distinct()


def _exact_sets(texts: list[str], length: int = WORDS) -> list[np.ndarray]:
    """Sorted shingle codes without collisions, for texts that are compared with each other."""
    numbers: dict[bytes, int] = {}
    known: dict[tuple, int] = {}
    coded = []
    for text in texts:
        words = words_of(text)
        coded.append(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64))
    every = np.concatenate(coded) if coded else np.zeros(0, np.int64)
    # shingles that cross from one text into the next get a code as well, which no text takes
    code, bits = every, max(1, len(numbers).bit_length())
    held = bits
    for i in range(1, length):
        if held + bits > 63:  # codes in use are numbered anew
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
            held = len(code).bit_length()
        code = (code[:-1] << bits) | every[i:]
        held += bits
    out, at = [], 0
    for ids in coded:
        if len(ids) < length:
            out.append(np.array([-1 - known.setdefault(tuple(ids.tolist()), len(known))], np.int64))
        else:
            out.append(np.unique(code[at:at + len(ids) - length + 1]))
        at += len(ids)
    return out


def _overlaps(sets: list[np.ndarray], percent: int = PERCENT) -> Iterator[tuple[int, int, int]]:
    """(i, j, common) of pairs that link."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) <= 6:
        for i, j in itertools.combinations(range(len(sets)), 2):
            low, high = sorted((sizes[i], sizes[j]))
            if 100 * low >= percent * high:
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * common >= percent * (low + high - common):
                    yield i, j, common
        return
    codes, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    often = times[column] > 1
    column, owner = column[often], owner[often]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    shared = np.cumsum(np.concatenate(([0], column[1:] != column[:-1]))) if len(column) else column
    width = max(64, 4_000_000 // len(sets))
    for at in range(0, int(shared[-1]) + 1 if len(shared) else 0, width):
        a, b = np.searchsorted(shared, (at, at + width))
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], shared[a:b] - at] = 1
        common += part @ part.T
    common = common.astype(np.int64)
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    for i, j in zip(*np.nonzero(np.triu(linked, 1))):
        yield int(i), int(j), int(common[i, j])


def _links(ids: list[str], texts: list[str], words: int = WORDS, percent: int = PERCENT) -> list[tuple[str, str]]:
    """Links that connect all sets found linked: each set with the smallest of its group."""
    distinct = dict(zip(ids, texts))
    names = sorted(distinct)
    root = list(range(len(names)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j, _ in _overlaps(_exact_sets([distinct[n] for n in names], words), percent):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [(names[i], names[find(i)]) for i in range(len(names)) if find(i) != i]


def verified_links(
    members: DataFrame, sets: DataFrame, docs: DataFrame, piece: int = PIECE, broadcast_rows: int = BROADCAST_ROWS,
    words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """(set_id, smaller): exact links between sets of the same hub, enough to connect them."""
    with_id_first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    firsts = sets.groupBy("set_id", "short_id", "n_shingles").agg(F.min(with_id_first).alias("first"))
    firsts = firsts.select("set_id", "short_id", "n_shingles", "first.doc_id", "first.text_key")
    rows = keep(members.join(firsts, "short_id"), "hub-members")
    sizes = rows.groupBy("hub").agg(F.sum("n_shingles").alias("total")).select(
        "hub", F.ceil(F.col("total") / piece).cast("int").alias("pieces"))
    placed = rows.join(sizes, "hub").withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("pieces")).cast("int"))
    pieces = placed.select(
        "hub", "set_id", "doc_id", "text_key", "own", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other"))
    wanted = pieces.select(
        "hub", "set_id", "doc_id", "text_key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    wanted = keep(wanted, "hub-pieces")
    small = wanted.count() <= broadcast_rows
    wanted = wanted.withColumnRenamed("doc_id", "first_id").withColumnRenamed("text_key", "first_key")
    every = keyed(docs)
    # a text without an id stands for its set only where no copy has one; its rows are all alike
    every = every.where(F.col("doc_id").isNotNull()).unionByName(every.where(F.col("doc_id").isNull()).distinct())
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key"))
    texts = every.join(F.broadcast(wanted) if small else wanted, same).select("hub", "a", "b", "set_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, held = None, [], []

        def out(links: list[tuple[str, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.string()) for k in (0, 1)], names=["set_id", "smaller"])

        for batch in batches:
            links: list[tuple[str, str]] = []
            columns = [batch.column(c).to_pylist() for c in ("hub", "a", "b", "set_id", "text")]
            for *now, set_id, text in zip(*columns):
                if now != key:
                    links += _links(ids, held, words, percent) if len(ids) > 1 else []
                    key, ids, held = now, [], []
                ids.append(set_id)
                held.append(text)
            yield out(links)
        if len(ids) > 1:
            yield out(_links(ids, held, words, percent))

    grouped = texts.repartition("hub", "a", "b").sortWithinPartitions("hub", "a", "b")
    return grouped.mapInArrow(run, "set_id string, smaller string")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of the connected component, for nodes with a link.

    Alternates large-star and small-star steps over (node, smaller) until they change nothing; the
    edges are written after each round.
    """
    edges = keep(links.toDF("u", "v").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
        edges = keep(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        state = now


def near_duplicate_groups(
    docs: DataFrame, piece: int = PIECE, broadcast_rows: int = BROADCAST_ROWS, words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """doc_id, text_key, n_shingles and component_id (smallest doc_id reachable by links) of every row."""
    sets = keep(shingle_sets(docs, words), "shingle-sets")
    links = verified_links(hub_members(set_lists(docs, words, percent)), sets, docs, piece, broadcast_rows, words, percent)
    labels = components(links)
    classes = sets.groupBy("set_id").agg(F.min("doc_id").alias("first_id"))
    labelled = classes.join(labels, classes["set_id"] == labels["node"], "left").select(
        "set_id", "first_id", F.coalesce("label", "set_id").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    groups = labelled.join(smallest, "label").select("set_id", "component_id")
    return sets.select("doc_id", "text_key", "n_shingles", "set_id").join(groups, "set_id").select(
        "doc_id", "text_key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows, with all their columns, of which one is left in each group of linked documents:
    that of the smallest doc_id (and text hash). Documents with an empty set all stay."""
    groups = keep(near_duplicate_groups(docs, words=words, percent=percent), "groups").where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    heads = groups.where(F.col("doc_id") == F.col("component_id")).groupBy("component_id").agg(
        F.min("text_key").alias("text_key"), F.count("*").alias("rows")).withColumnRenamed("component_id", "doc_id")
    left = without(docs, groups.join(heads, ["doc_id", "text_key"], "left_anti"))
    repeated = groups.groupBy("doc_id", "text_key").agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
    repeated = keep(repeated.select("doc_id", "text_key"), "repeated-rows")
    if not repeated.head(1):
        return left
    # equal ids and texts: the rest without them, and one row of each
    again = repeated.select(F.col("doc_id").alias("again_id"), F.col("text_key").alias("again_key"))
    same = (left["doc_id"] == F.col("again_id")) & (text_key(left["text"]) == F.col("again_key"))
    return without(left, repeated).unionByName(left.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
