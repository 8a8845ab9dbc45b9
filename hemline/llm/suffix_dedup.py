"""Removal of repeated byte strings by suffix sorting with Lyndon groups.

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts anywhere else.

1. Every window of ``LENGTH`` bytes has an anchor: of its ``GRAM``-byte strings the one with the
   smallest hash. Equal windows have equal anchors at equal places, so windows meet in the group of
   their anchor. A document gives one row per anchor: the anchor's hash and a digest of the bytes of
   all windows it stands for (its context). Tasks combine equal rows before the shuffle.
2. Equal contexts settle each other. Where different contexts share an anchor, one text per context
   is cut down to what it has in common with another one; what can still hold a repeated window is
   suffix-sorted, with the anchor's bytes as one symbol. A window is repeated when a neighbour in
   the suffix array starts with it. Groups of many contexts are cut into pieces that are sorted
   pairwise, so no task holds a group.
3. Repeated window starts go back to the documents that have the context; their union is removed.

Texts are joined by a shuffle at every size: what travels grows with the input alone.

Suffixes are sorted in linear grouping steps: groups of suffixes, by first symbol at the outset, are
taken in descending order; the previous smaller suffixes of a group's members are moved into groups
right above their own, those that point to more members higher. Each group then holds the suffixes
with one longest Lyndon prefix, and one ascending pass along the same pointers puts each group in
order. Nothing is renamed and no recursion is needed.

Windows never cross documents. NULL is an empty text; texts shorter than ``LENGTH`` keep all bytes.
Repeated rows repeat each other, so all their long texts go. Empty table: empty result. Only doc_id
and text are read. Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hemline.llm.common import keep, small_batches

LENGTH = 200
GRAM = 60
FREE = LENGTH - GRAM  # bytes of a window beside its anchor
#: Contexts of one anchor that are sorted together.
PIECE = 400
#: Symbols sorted in one run.
RUN = 60_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 31) - 1)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


@lru_cache(maxsize=1)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    inverse = pow(int(_BASE), -1, 1 << 64)
    out = []
    for base in (int(_BASE), inverse):
        values = np.full(size + 1, base, np.uint64)
        values[0] = 1
        out.append(np.multiply.accumulate(values))
    return out[0], out[1]


def prefix_sums(data: np.ndarray, up: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while 2 * length <= width:
        values, length = np.minimum(values[:-length], values[length:]), length * 2
    return np.minimum(values[: len(values) - (width - length)], values[width - length:]) if width > length else values


def anchors(data: bytes) -> tuple[np.ndarray, ...]:
    """Of each anchor: gram hash, context digest, place, and how far before it its windows start (from, to)."""
    n = len(data)
    up, down = powers(1 << max(20, n.bit_length()))
    sums = prefix_sums(np.frombuffer(data, np.uint8), up)
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    place = np.arange(len(grams), dtype=np.uint64)
    chosen = sliding_min((grams & ~_PLACE) | (_PLACE - place), FREE + 1)
    at = (_PLACE - (chosen & _PLACE)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((first[1:], [len(at)])) - 1
    at = at[first]
    context = mixed((sums[last + LENGTH] - sums[first]) * down[first])
    context = mixed(context ^ ((at - first).astype(np.uint64) << np.uint64(32)) ^ (at - last).astype(np.uint64))
    return grams[at].view(np.int64), context.view(np.int64), at, at - last, at - first


def lyndon_groups(text: list[int]) -> tuple[list[int], list[int]]:
    """For a text that ends in its only smallest symbol: the start, in the suffix order, of the group
    of each suffix, and its previous smaller suffix (-1: none)."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    slot = [0] * n
    group = [0] * n  # start of the group of a suffix
    size = [0] * n  # by start
    start = 0
    for k, i in enumerate(order):
        if k and text[i] != text[order[k - 1]]:
            start = k
        slot[i], group[i] = k, start
        size[start] += 1
    smaller = [-1] * n
    end = n
    while end > 0:
        start = group[order[end - 1]]
        points: dict[int, int] = {}
        for i in sorted(order[start:end]):
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                points[p] = points.get(p, 0) + 1
        if points:
            by_count: dict[int, list[int]] = {}
            for p, times in points.items():
                by_count.setdefault(times, []).append(p)
            for times in sorted(by_count, reverse=True):
                moved: dict[int, int] = {}  # old group: members to move
                for p in by_count[times]:
                    old = group[p]
                    taken = moved.get(old, 0)
                    to = old + size[old] - 1 - taken
                    other, here = order[to], slot[p]
                    order[to], order[here] = p, other
                    slot[p], slot[other] = to, here
                    moved[old] = taken + 1
                for old, taken in moved.items():
                    left = size[old] - taken
                    if left:
                        new = old + left
                        size[old], size[new] = left, taken
                        for k in range(new, new + taken):
                            group[order[k]] = new
        end = start
    return group, smaller


def suffix_array(text: list[int]) -> list[int]:
    """Suffixes in order; the text ends in its only smallest symbol."""
    n = len(text)
    group, smaller = lyndon_groups(text)
    free = list(range(n))  # next free slot, by group start
    out = [-1] * n
    placed = bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    free[group[n - 1]] += 1
    for k in range(n):
        i = out[k] - 1
        while i >= 0 and not placed[i]:
            placed[i] = 1
            g = group[i]
            out[free[g]] = i
            free[g] += 1
            i = smaller[i]
    return out


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def longest_common(parts: list[bytes]) -> list[int]:
    """Longest prefix each part has in common with another one."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    out = [0] * len(parts)
    for x, y in zip(order, order[1:]):
        shared = common_prefix(parts[x], parts[y])
        out[x], out[y] = max(out[x], shared), max(out[y], shared)
    return out


class Sorter:
    """Finds the repeated windows of contexts, group by group, sorting in runs of bounded size."""

    def __init__(self) -> None:
        self.found: list[tuple[int, int, int, int]] = []  # anchor, context, from, to
        self._clear()

    def _clear(self) -> None:
        self.text: list[int] = []
        self.waiting: list[tuple[int, int, int, int, int]] = []  # start of text, d from, d to, anchor, context
        self.groups = 0

    def add_group(self, anchor: int, rows: list[tuple[int, int, bytes, bytes, int, int]]) -> None:
        """rows: context, occurrences, bytes before and after the anchor, windows start from..to before it."""
        after = longest_common([r[3] for r in rows])
        before = longest_common([r[2][::-1] for r in rows])
        parts: dict[tuple[bytes, bytes, int, int], list[tuple[int, int]]] = {}
        for (context, times, left, right, low, high), r, l in zip(rows, after, before):
            low, high = max(low, FREE - r), min(high, l)
            if low <= high:
                part = (left[len(left) - high:], right[: FREE - low], low, high)
                parts.setdefault(part, []).append((context, times))
        single = {p: members[0][0] for p, members in parts.items() if len(members) == 1 and members[0][1] == 1}
        for (_, _, low, high), members in parts.items():
            if len(members) > 1:  # equal strings
                self.found += [(anchor, context, low, high) for context, times in members if times == 1]
        if not single:
            return
        for part in parts:
            left, right, low, high = part
            if part in single:
                self.waiting.append((len(self.text), low, high, anchor, single[part]))
            self.text += [b + 2 for b in left]
            self.text.append(258 + self.groups)
            self.text += [b + 2 for b in right]
            self.text.append(1)
        self.groups += 1
        if len(self.text) >= RUN:
            self.sort()

    def sort(self) -> None:
        if not self.text:
            return
        self.text.append(0)
        order = suffix_array(self.text)
        rank = [0] * len(order)
        for k, i in enumerate(order):
            rank[i] = k
        codes = "".join(map(chr, self.text))
        for start, low, high, anchor, context in self.waiting:
            run_from = None
            for d in range(high, low - 1, -1):  # the window that starts d bytes before the anchor
                i = start + high - d
                window, k = codes[i:i + FREE + 1], rank[i]
                same = codes.startswith(window, order[k - 1]) or (k + 1 < len(order) and codes.startswith(window, order[k + 1]))
                if same and run_from is None:
                    run_from = d
                elif not same and run_from is not None:
                    self.found.append((anchor, context, d + 1, run_from))
                    run_from = None
            if run_from is not None:
                self.found.append((anchor, context, low, run_from))
        self._clear()


def keyed(docs: DataFrame, keep_columns: list[str]) -> DataFrame:
    """The other columns to keep as a struct, text as bytes, and a key of the text."""
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    kept = [F.col(f"`{c}`") for c in keep_columns]
    return docs.select(F.struct(F.col("text").isNull().alias("no_text"), *kept).alias("kept"), F.xxhash64(data).alias("text_key"), data.alias("data"))


_ROWS = {"anchor": pa.int64(), "context": pa.int64(), "text_key": pa.int64(), "at": pa.int32(), "low": pa.int16(), "high": pa.int16()}
_ROWS_SQL = "anchor long, context long, text_key long, at int, low short, high short"


def _anchor_batch(batch: pa.RecordBatch) -> list[np.ndarray]:
    found = []
    for key, data in zip(batch.column("text_key").to_pylist(), batch.column("data")):
        raw = data.as_py()
        if len(raw) >= LENGTH:
            gram, context, at, low, high = anchors(raw)
            found.append((gram, context, np.full(len(at), key, np.int64), at, low, high))
    return [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 6


def anchor_rows(texts: DataFrame) -> DataFrame:
    """One row per anchor of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _anchor_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, _ROWS.values())], names=list(_ROWS))

    return texts.select("text_key", "data").mapInArrow(run, _ROWS_SQL)


def context_counts(texts: DataFrame) -> DataFrame:
    """(anchor, context, times, contexts, first text_key, at, low, high) of shared anchors.

    Equal rows of a batch are one row before the shuffle, so a hot passage is at most one row per
    batch and context.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _anchor_batch(batch)
            pair = mixed(columns[0].view(np.uint64) * _BASE) ^ columns[1].view(np.uint64)
            _, first, times = np.unique(pair, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[first].astype(t.to_pandas_dtype()), t) for c, t in zip(columns, _ROWS.values())] + [pa.array(times, pa.int64())],
                names=[*_ROWS, "times"])

    rows = texts.select("text_key", "data").mapInArrow(run, f"{_ROWS_SQL}, times long").repartition("anchor")
    counted = rows.groupBy("anchor", "context").agg(
        F.sum("times").alias("times"), F.min(F.struct("text_key", "at", "low", "high")).alias("first"))
    every = Window.partitionBy("anchor")
    shared = counted.withColumn("contexts", F.count("*").over(every)).where((F.col("times") > 1) | (F.col("contexts") > 1))
    return shared.select("anchor", "context", "times", "contexts", "first.*")


def sorted_contexts(texts: DataFrame, counts: DataFrame, piece: int = PIECE) -> DataFrame:
    """(anchor, context, low, high): repeated windows of contexts that occur once."""
    mixed_rows = counts.where(F.col("contexts") > 1)
    wanted = mixed_rows.groupBy("text_key").agg(F.collect_list(F.struct("anchor", "context", "times", "contexts", "at", "low", "high")).alias("rows"))
    one_each = texts.select("text_key", "data").join(wanted, "text_key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "context", "times", "before", "after", "low", "high", "own", "pieces"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int16(), pa.int16(), pa.int32(), pa.int32()]
        seen: set[int] = set()  # copies of a text in this task
        for batch in batches:
            out: list[tuple] = []
            for key, data, rows in zip(*(batch.column(c).to_pylist() for c in ("text_key", "data", "rows"))):
                if key in seen:
                    continue
                seen = set() if len(seen) > 100_000 else seen
                seen.add(key)
                for r in rows:
                    at, pieces = r["at"], -(-r["contexts"] // piece)
                    out.append((
                        r["anchor"], r["context"], r["times"], data[at - r["high"]:at], data[at + GRAM:at - r["low"] + LENGTH],
                        r["low"], r["high"], r["context"] % pieces, pieces))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names=names)

    parts = one_each.mapInArrow(
        cut, "anchor long, context long, times long, before binary, after binary, low short, high short, own int, pieces int")
    paired = parts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
        "anchor", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "context", "times", "before", "after", "low", "high")
    grouped = paired.repartition("anchor", "a", "b").sortWithinPartitions("anchor", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorter, key, held = Sorter(), None, {}

        def out() -> pa.RecordBatch:
            found, sorter.found = sorter.found, []
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int16(), pa.int16()))],
                names=["anchor", "context", "low", "high"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "a", "b", "context", "times", "before", "after", "low", "high")]
            for anchor, a, b, context, *row in zip(*columns):
                if (anchor, a, b) != key:
                    if len(held) > 1:
                        sorter.add_group(key[0], list(held.values()))
                    key, held = (anchor, a, b), {}
                held[context] = (context, *row)  # once, though several tasks may hold the text
            yield out()
        if len(held) > 1:
            sorter.add_group(key[0], list(held.values()))
        sorter.sort()
        yield out()

    return grouped.mapInArrow(run, "anchor long, context long, low short, high short")


def repeated_starts(texts: DataFrame, piece: int = PIECE) -> DataFrame:
    """(text_key, starts): per text with any, the (first, last) starts of repeated windows."""
    counts = keep(context_counts(texts), "contexts")
    once = sorted_contexts(texts, counts, piece)
    settled = counts.where(F.col("times") > 1).select("anchor", "context", "low", "high").unionByName(once)
    settled = keep(settled, "settled").withColumnsRenamed({"low": "from", "high": "to"})
    starts = anchor_rows(texts).join(settled, ["anchor", "context"]).select(
        "text_key", F.struct((F.col("at") - F.col("to")).alias("first"), (F.col("at") - F.col("from")).alias("last")).alias("start"))
    return starts.groupBy("text_key").agg(F.collect_set("start").alias("starts"))


def kept_parts(data: bytes, starts: list[dict] | None) -> tuple[list[tuple[int, int]], bytes]:
    """Removed runs and the bytes left."""
    runs: list[tuple[int, int]] = []
    for first, last in sorted((s["first"], s["last"] + LENGTH) for s in starts or ()):
        if runs and first <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], last))
        else:
            runs.append((first, last))
    edges = [0, *(x for run in runs for x in run), len(data)]
    return runs, b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def remove_repeats(docs: DataFrame, keep_columns: list[str], piece: int = PIECE) -> DataFrame:
    """Of every row: ``kept`` (struct of ``keep_columns``), n_bytes, n_removed, n_spans, kept_sha256 and
    kept_text, the bytes left as text; characters that lost a byte go with it."""
    small_batches(docs.sparkSession)
    texts = keyed(docs, keep_columns)
    rows = texts.join(repeated_starts(texts, piece), "text_key", "left").select("kept", "data", "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, starts in zip(batch.column("data").to_pylist(), batch.column("starts").to_pylist()):
                runs, left = kept_parts(data, starts)
                out.append((len(data), len(data) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left.decode(errors="ignore")))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), *[pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)]],
                names=["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    kept = rows.schema["kept"].dataType.simpleString()
    return rows.mapInArrow(run, f"kept {kept}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows with their columns, repeated strings cut out of ``text``; n_chars follows the text."""
    others = [c for c in docs.columns if c != "text"]
    cut = remove_repeats(docs, others)
    text = F.when(~F.col("kept.no_text"), F.col("kept_text"))
    changed = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("kept.n_chars"))} \
        if "n_chars" in others else {"text": text}
    return cut.select(*[changed.get(c, F.col(f"kept.`{c}`")).alias(c) for c in docs.columns])
