"""Language-model scores from a log-bilinear model trained by noise-contrastive estimation.

Tokens are the words of a text (A-Z in lower case) and one end. Every word has a class: the most
frequent words one each, all others one of ``SUFFIX_CLASSES`` by their ending. The probability of a
token is P(class | two classes before) * P(word | class). The first factor is the log-bilinear
model: the context's vectors, weighted by place, against the vector of the class; the second is a
smoothed count. Both are normalised, an unknown word included.

1. Word counts of all training texts: summed per task, then by word. Nothing is cut off.
2. Training covers all training texts: each task runs numpy minibatches over its own rows, and the
   parameters are averaged by tokens in one aggregate, so the driver gets one set of parameters.
3. One batched matrix product scores all contexts; its soft-max is the table used by every task.
4. Scoring streams over the texts. The words with the highest counts, ``BROADCAST_WORDS`` at most,
   are broadcast; occurrences of other words are joined with their counts by word. With a vocabulary
   below the bound there are no others; results are the same on either side of it.

NULL texts are empty: one token, the end. Repeated rows are scored one by one. An empty training set
leaves uniform classes. An empty table gives an empty table; columns other than the named ones are
ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemline.llm.common import keep, small_batches

BROADCAST_WORDS = 1_000_000
OWN_CLASSES = 95
SUFFIX_CLASSES = 64
#: Own words, the end, suffix classes; the context has one more class, the start.
CLASSES = OWN_CLASSES + 1 + SUFFIX_CLASSES
END_CLASS, FIRST_SUFFIX, BEGIN = OWN_CLASSES, OWN_CLASSES + 1, CLASSES
WIDTH = 16
NOISE_PER_TOKEN = 10
NOISE_SAMPLE = 64
BATCH = 4_096
RATE = 0.1
#: Tokens whose equal contexts are gathered before a training pass, and partial counts held by a task.
TRAIN_CHUNK = 1_500_000
COUNT_CHUNK = 300_000


def tokens(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def encode(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(different words, number of each word of all texts, words of each text): ``tokens`` of a whole batch."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    encoded = lists.flatten().dictionary_encode()
    words = encoded.dictionary.cast(pa.binary()).to_pylist()
    numbers, lengths = encoded.indices.to_numpy().astype(np.int64), pc.list_value_length(lists).to_numpy().astype(np.int64)
    if b"" in words:  # beside blanks at the ends of a text
        real = numbers != words.index(b"")
        lengths = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[real], minlength=len(lengths))
        numbers = numbers[real]
    return words, numbers, lengths


def with_ends(values: np.ndarray, lengths: np.ndarray, end: float) -> tuple[np.ndarray, np.ndarray]:
    """(values with one more at the end of every text, where the texts start)."""
    ends = np.cumsum(lengths)
    return np.insert(values, ends, end), ends - lengths + np.arange(len(lengths))


def suffix_class(word: bytes) -> int:
    ending = word.rstrip(b".,;:!?%&*$#|)\"'")[-3:] + (b"." if word[-1:] == b"." else b"")
    return FIRST_SUFFIX + zlib.crc32(ending) % SUFFIX_CLASSES


def count_words(training: DataFrame) -> DataFrame:
    """(word, class, n) over all training texts; ``class`` is the one by ending."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array(list(held), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            words, numbers, _ = encode(batch.column("text"))
            counts = np.bincount(numbers, minlength=len(words))
            held.update({words[i]: int(counts[i]) for i in np.flatnonzero(counts)})
            if len(held) > COUNT_CHUNK:
                yield out()
                held = Counter()
        yield out()

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = [suffix_class(w.encode()) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(classes, pa.int32()), batch.column("n")], names=["word", "class", "n"])

    small_batches(training.sparkSession)
    partial = training.select("text").mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).mapInArrow(classed, "word string, class int, n long")


@dataclass
class Vocabulary:
    """The broadcast words with their class and count, and totals over all words."""

    words: pa.Array
    classes: np.ndarray
    counts: np.ndarray
    complete: bool
    total: int  # N
    distinct: int  # V
    class_counts: np.ndarray
    class_sizes: np.ndarray
    ends: int

    def index(self) -> dict[bytes, int]:
        return dict(zip(self.words.cast(pa.binary()).to_pylist(), range(len(self.words))))

    def base_logs(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def within_logs(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 P(word | class); a class of one word has no other words."""
        room = self.class_counts[classes] + 0.5 * (self.class_sizes[classes] + 1)
        return np.where(classes < FIRST_SUFFIX, 0.0, np.log10((counts + 0.5) / room))


def vocabulary(counts: DataFrame, training_texts: int, broadcast_words: int = BROADCAST_WORDS) -> tuple[Vocabulary, DataFrame]:
    """The broadcast part, and the table of the other words (word, class, n)."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = {r["level"]: (r["words"], r["n"]) for r in counts.groupBy(level.alias("level")).agg(
        F.count("*").alias("words"), F.sum("n").alias("n")).collect()}  # one row per power of two
    floor, held = max(sizes, default=0) + 1, 0
    for at in sorted(sizes, reverse=True):
        if held + sizes[at][0] > broadcast_words:
            break
        floor, held = at, held + sizes[at][0]
    top = counts.where(level >= floor).orderBy(F.desc("n"), "word").toArrow()
    words, classes = top["word"].combine_chunks(), top["class"].to_numpy().astype(np.int32)
    numbers = top["n"].to_numpy().astype(np.int64)
    per_class = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()  # at most CLASSES rows
    class_counts, class_sizes = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in per_class:
        class_counts[r["class"]], class_sizes[r["class"]] = r["n"], r["words"]
    own = min(OWN_CLASSES, len(words))
    np.subtract.at(class_counts, classes[:own], numbers[:own])
    np.subtract.at(class_sizes, classes[:own], 1)
    classes = classes.copy()
    classes[:own] = np.arange(own)
    class_counts[:own], class_sizes[:own] = numbers[:own], 1
    class_counts[END_CLASS], class_sizes[END_CLASS] = training_texts, 1
    total = sum(n for _, n in sizes.values()) + training_texts
    distinct = sum(w for w, _ in sizes.values()) + bool(training_texts)
    complete = held == sum(w for w, _ in sizes.values())
    return Vocabulary(words, classes, numbers, complete, total, distinct, class_counts, class_sizes, training_texts), counts.where(level < floor)


def contexts(classes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes one and two places before each token; the start before a text."""
    one, two = np.full(len(classes), BEGIN, np.int64), np.full(len(classes), BEGIN, np.int64)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    one[starts] = two[starts] = BEGIN
    second = starts + 1
    two[second[second < len(classes)]] = BEGIN
    return one, two


@dataclass
class LogBilinear:
    """Vectors of context classes, weights of the two places, vectors and biases of predicted classes."""

    context: np.ndarray
    place: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, noise: np.ndarray) -> "LogBilinear":
        random = np.random.default_rng(11)
        return cls(random.normal(0, 0.1, (CLASSES + 1, WIDTH)), np.ones((2, WIDTH)), random.normal(0, 0.1, (CLASSES, WIDTH)), np.log(noise))

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.place, self.target, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    @classmethod
    def from_flat(cls, values: np.ndarray, like: "LogBilinear") -> "LogBilinear":
        ends = np.cumsum([a.size for a in like.arrays()])[:-1]
        return cls(*(v.reshape(a.shape) for v, a in zip(np.split(values, ends), like.arrays())))

    def log10_table(self) -> np.ndarray:
        """log10 P(class | two before, one before), normalised, flat over (two, one, class)."""
        state = self.context[:, None, :] * self.place[1] + self.context[None, :, :] * self.place[0]
        scores = state.reshape(-1, WIDTH) @ self.target.T + self.bias
        top = scores.max(axis=1, keepdims=True)
        scores -= top + np.log(np.exp(scores - top).sum(axis=1, keepdims=True))
        return (scores / np.log(10)).astype(np.float32).ravel()


class Trainer:
    """Noise-contrastive estimation by weighted minibatches with per-parameter rates."""

    def __init__(self, model: LogBilinear, noise: np.ndarray) -> None:
        self.model, self.noise, self.random = model, noise, np.random.default_rng(5)
        self.squares = [np.full(a.shape, 1e-6) for a in model.arrays()]
        self.log_noise = np.log(NOISE_PER_TOKEN * noise)

    def fit(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> None:
        codes, weights = np.unique((two * (CLASSES + 1) + one) * CLASSES + target, return_counts=True)
        order = self.random.permutation(len(codes))
        for at in range(0, len(order), BATCH):
            part = order[at:at + BATCH]
            pair, now = np.divmod(codes[part], CLASSES)
            self._step(pair % (CLASSES + 1), pair // (CLASSES + 1), now, weights[part].astype(np.float64))

    def _step(self, one: np.ndarray, two: np.ndarray, now: np.ndarray, weight: np.ndarray) -> None:
        m = self.model
        weight = weight / weight.sum()
        a, b = m.context[one], m.context[two]
        state = a * m.place[0] + b * m.place[1]
        sample = self.random.choice(CLASSES, NOISE_SAMPLE, p=self.noise)
        of_data = np.einsum("ij,ij->i", state, m.target[now]) + m.bias[now] - self.log_noise[now]
        of_noise = state @ m.target[sample].T + m.bias[sample] - self.log_noise[sample]
        pull = weight / (1 + np.exp(np.clip(of_data, -30, 30)))
        push = (weight * NOISE_PER_TOKEN / NOISE_SAMPLE)[:, None] / (1 + np.exp(-np.clip(of_noise, -30, 30)))
        to_state = pull[:, None] * m.target[now] - push @ m.target[sample]
        grads = [np.zeros_like(x) for x in m.arrays()]
        np.add.at(grads[0], one, to_state * m.place[0])
        np.add.at(grads[0], two, to_state * m.place[1])
        grads[1][0], grads[1][1] = (to_state * a).sum(axis=0), (to_state * b).sum(axis=0)
        np.add.at(grads[2], now, pull[:, None] * state)
        np.add.at(grads[2], sample, -(push.T @ state))
        np.add.at(grads[3], now, pull)
        np.add.at(grads[3], sample, -push.sum(axis=0))
        for value, grad, square in zip(m.arrays(), grads, self.squares):
            square += grad * grad
            value += RATE * grad / np.sqrt(square)


def _classes_of(words: list[bytes], index: dict[bytes, int], classes: np.ndarray) -> np.ndarray:
    at = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
    out = classes[at] if len(classes) else np.zeros(len(at), np.int32)
    for i in np.flatnonzero(at < 0):
        out[i] = suffix_class(words[i])
    return out


def train(training: DataFrame, vocab: Vocabulary) -> LogBilinear:
    """Average, by tokens, of the models that tasks train on their rows from a common start."""
    noise = (vocab.class_counts + 1) / (vocab.class_counts + 1).sum()
    start = LogBilinear.start(noise)
    shared = training.sparkSession.sparkContext.broadcast((vocab.words, vocab.classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, classes = shared.value
        index = dict(zip(words.cast(pa.binary()).to_pylist(), range(len(words))))
        trainer = Trainer(LogBilinear.start(noise), noise)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        seen = held = 0

        def fit() -> None:
            joined = np.concatenate([p for p, _ in parts]).astype(np.int64)
            before = np.concatenate(([0], np.cumsum([len(p) for p, _ in parts])[:-1]))
            trainer.fit(*contexts(joined, np.concatenate([s + b for (_, s), b in zip(parts, before)])), joined)

        for batch in batches:
            found, numbers, lengths = encode(batch.column("text"))
            parts.append(with_ends(_classes_of(found, index, classes)[numbers], lengths, END_CLASS))
            held += len(parts[-1][0])
            if held >= TRAIN_CHUNK:
                fit()
                seen, held, parts = seen + held, 0, []
        if parts:
            fit()
            seen += held
        if seen:
            values = trainer.model.flat() * seen
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values) + 1), pa.int32()), pa.array(np.append(values, seen), pa.float64())], names=["at", "value"])

    sums = training.select("text").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    if not len(sums):
        return start
    flat = np.zeros(len(sums))
    flat[sums["at"].to_numpy()] = sums["value"].to_numpy()
    return LogBilinear.from_flat(flat[:-1] / flat[-1], start)


def score(docs: DataFrame, training: DataFrame, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``docs`` has doc_id, text and held_out; ``training`` has the rows to learn from.
    """
    spark = docs.sparkSession
    small_batches(spark)
    counts = keep(count_words(training), "word-counts")
    vocab, others = vocabulary(counts, training.count(), broadcast_words)
    table = train(training, vocab).log10_table()
    shared = spark.sparkContext.broadcast((vocab, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, table = shared.value
        index = vocab.index()
        # one more entry, reached as -1: an unknown word, whose class is filled in below
        classes = np.append(vocab.classes, 0).astype(np.int64)
        base = np.append(vocab.base_logs(vocab.counts), vocab.base_logs(np.zeros(1)))
        within = np.append(vocab.within_logs(vocab.classes, vocab.counts), 0.0)
        unknown = vocab.within_logs(np.arange(CLASSES), np.zeros(CLASSES))
        end_base = vocab.base_logs(np.array([vocab.ends]))[0]
        for batch in batches:
            words, numbers, lengths = encode(batch.column("text"))
            at = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
            cls, log_base, log_within = classes[at], base[at], within[at]
            missing = np.flatnonzero(at < 0)
            cls[missing] = [suffix_class(words[i]) for i in missing]
            if vocab.complete:
                log_within[missing] = unknown[cls[missing]]
            else:
                log_base[missing] = 0.0
            place, starts = with_ends(cls[numbers], lengths, END_CLASS)
            one, two = contexts(place, starts)
            log_class = table[(two * (CLASSES + 1) + one) * CLASSES + place].astype(np.float64)
            whole = lambda values, end: np.add.reduceat(with_ends(values, lengths, end)[0], starts) if len(starts) else values
            n_known = whole((at >= 0)[numbers].astype(np.int64), int(vocab.ends > 0))
            of_class = np.add.reduceat(log_class, starts) if len(starts) else log_class
            columns = [pa.array(lengths + 1, pa.int64()), pa.array(n_known, pa.int64()),
                       pa.array(whole(log_base[numbers], end_base), pa.float64()), pa.array(of_class + whole(log_within[numbers], 0.0), pa.float64())]
            other_words: list[list[dict] | None] = [None] * len(lengths)
            if not vocab.complete:
                for i, own in enumerate(np.split(numbers, np.cumsum(lengths)[:-1])):
                    which, counts = np.unique(own[at[own] < 0], return_counts=True)
                    other_words[i] = [{"word": words[w].decode(), "class": int(cls[w]), "n": int(n)} for w, n in zip(which, counts)]
            kind = pa.list_(pa.struct([("word", pa.string()), ("class", pa.int32()), ("n", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("held_out"), *columns, pa.array(other_words, kind)],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "others"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("held_out"), F.col("text"))
    scored = rows.mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
        "others array<struct<word: string, class: int, n: long>>")
    if not vocab.complete:
        scored = keep(scored, "scores")
        room = F.lit(float(vocab.total + 0.5 * (vocab.distinct + 1)))
        class_room = F.array(*[F.lit(float(x)) for x in vocab.class_counts + 0.5 * (vocab.class_sizes + 1)])
        spread = scored.select("row", F.explode_outer("others").alias("o")).where(F.col("o").isNotNull()).select("row", "o.*")
        c = F.coalesce(F.col("count"), F.lit(0))
        joined = spread.join(others.select("word", F.col("n").alias("count")), "word", "left")
        added = joined.groupBy("row").agg(
            F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more_known"),
            F.sum(F.col("n") * F.log10((c + 0.5) / room)).alias("more_base"),
            F.sum(F.col("n") * F.log10((c + 0.5) / F.get(class_room, F.col("class")))).alias("more_score"))
        scored = scored.drop("others").join(added, "row", "left").select(
            "row", "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
            (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(vocab.total).cast("long").alias("train_tokens"), "base_score", "score")
