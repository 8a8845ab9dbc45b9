"""Language identification by cross-parsing.

Per language, a suffix automaton is built over a bounded sample of labelled text. A text is parsed
against an automaton into phrases, each the longest match that starts where the last one ended (a
character the sample lacks is a phrase). The number of phrases over the number of symbols estimates
the cross entropy; the language that needs the fewest phrases wins, the smaller name on a tie.

Letters are taken in lower case, every run of other characters is one blank. Every letter of the
samples is a symbol of its own, whatever the number of scripts; letters of no sample are phrases.
Parsing needs no suffix links, so automata are transition tables, dense for the ``DENSE`` most
frequent symbols and sorted (state, symbol) pairs for the others. All blocks of ``BLOCK`` symbols of
a batch of texts are parsed side by side, one numpy step per symbol; each block starts a phrase of
its own. All symbols of every text are parsed.

The sample is ``sample_docs`` rows per language (smallest hash of the id) with up to ``sample_chars``
characters each, in slices spread over the text where it is longer; this bound is the only one, and
predictions never see lang, source or id. NULL texts
and texts without a letter are ``und`` with score 0, as are all texts when no labelled row exists.
Repeated rows get equal answers; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemline.llm.common import small_batches

SAMPLE_DOCS = 96
SAMPLE_CHARS = 160
SLICES = 4
#: Symbols with a column of their own in the dense tables.
DENSE = 64
BLOCK = 256
#: Symbols parsed at once.
CHUNK = 2_000_000
UNKNOWN = "und"
#: A text that needs more phrases per symbol than this is in none of the learned languages.
REJECT_AT = 0.75
#: Texts of fewer symbols count as this many, so that a short text isn't taken for none of them.
SHORT = 40

_LETTER = re.compile(r"[^\W\d_]")
_PAD, _BLANK, _OTHER = 0, 1, 2


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the minimal automaton of all substrings; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at != -1:
            to = step[at][c]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(step)
                step.append(dict(step[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at != -1 and step[at].get(c) == to:
                    step[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return step


@dataclass(frozen=True)
class RareMoves:
    """Transitions by symbols beyond the dense ones, as sorted codes ``state * width + symbol``."""

    width: int
    codes: np.ndarray
    targets: np.ndarray
    first: np.ndarray  # symbol -> target from the start, 0 where the sample lacks it

    @classmethod
    def of(cls, step: list[dict[int, int]], width: int) -> "RareMoves":
        moves = sorted((s * width + c, to) for s, m in enumerate(step) for c, to in m.items() if c >= DENSE)
        codes, targets = (np.array([m[k] for m in moves], np.int64) for k in (0, 1))
        first = np.zeros(width, np.int64)
        first[list(step[0])] = list(step[0].values())
        return cls(width, codes, targets, first)

    def move(self, row: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """As an entry of ``parse_table``."""
        state = row.astype(np.int64) // DENSE
        wanted, first = state * self.width + symbol, self.first[symbol]
        if not len(self.codes):
            found, to = np.zeros(len(wanted), bool), first
        else:
            at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
            found = self.codes[at] == wanted
            to = np.where(found, self.targets[at], first)
        return to * (DENSE * 4) + np.where(found, 0, (state > 0).astype(np.int64) + (first == 0))


def parse_table(step: list[dict[int, int]]) -> np.ndarray:
    """Flat table over (state * DENSE + symbol): next row offset * 4 + number of phrases that end.

    A symbol that doesn't go on ends the phrase before it; one that the sample lacks is a phrase too.
    """
    table = np.zeros((len(step), DENSE), dtype=np.int32)
    for state, moves in enumerate(step):
        for symbol, to in moves.items():
            if symbol < DENSE:
                table[state, symbol] = to
    missing = table == 0
    opened = (np.arange(len(step))[:, None] > 0).astype(np.int32)
    ends = missing * (opened + (table[0] == 0)[None, :])
    following = np.where(missing, table[0][None, :], table) * (DENSE * 4) + ends
    following[:, _PAD] = 1  # the end of a text closes its phrase
    following[0, _PAD] = 0
    return following.astype(np.int32).ravel()


@dataclass(frozen=True)
class CrossParser:
    languages: tuple[str, ...]
    symbol_of: np.ndarray  # code point -> symbol
    tables: tuple[np.ndarray, ...]
    rare: tuple[RareMoves, ...]

    @classmethod
    def learn(cls, samples: dict[str, str]) -> "CrossParser":
        """From one text per language."""
        letters = Counter(c.lower() for t in samples.values() for c in t if c.isalpha())
        known = {c: i + 3 for i, (c, _) in enumerate(sorted(letters.items(), key=lambda x: (-x[1], x[0])))}
        points = np.full(sys.maxunicode + 1, _BLANK, dtype=np.int32)
        for point in range(len(points)):
            if (c := chr(point)).isalpha():
                points[point] = known.get(c.lower(), _OTHER)
        names = tuple(sorted(samples))
        empty = cls(names, points, (), ())
        steps = [suffix_automaton(empty.symbols(samples[n]).tolist()) for n in names]
        width = max(DENSE, len(known) + 3)
        return cls(names, points, tuple(map(parse_table, steps)), tuple(RareMoves.of(s, width) for s in steps))

    def symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        out = self.symbol_of[points]
        blank = out == _BLANK
        return np.delete(out, np.flatnonzero(blank[1:] & blank[:-1]) + 1)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text under each language."""
        sizes = np.array([len(t) for t in texts])
        blocks = np.maximum(1, -(-sizes // BLOCK))
        first = np.concatenate(([0], np.cumsum(blocks)[:-1]))
        padded = np.zeros(blocks.sum() * BLOCK, dtype=np.int32)
        for text, at in zip(texts, first * BLOCK):
            padded[at:at + len(text)] = text
        columns = np.ascontiguousarray(padded.reshape(-1, BLOCK).T)
        rare = [np.flatnonzero(c >= DENSE) for c in columns]
        dense = np.where(columns < DENSE, columns, _OTHER)
        out = np.empty((len(self.tables), len(texts)), dtype=np.int64)
        for i, (table, others) in enumerate(zip(self.tables, self.rare)):
            state = np.zeros(columns.shape[1], dtype=np.int32)
            count = np.zeros(columns.shape[1], dtype=np.int32)
            for symbol, wide, column in zip(dense, rare, columns):
                move = table.take(state + symbol)
                if len(wide):
                    move[wide] = others.move(state[wide], column[wide])
                count += move & 3
                state = move >> 2
            out[i] = np.add.reduceat(count + (state > 0), first)
        return out.T

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, score and phrases per symbol of each text.

        The score is the share of phrases saved against the next language.
        """
        names, scores, rates = [UNKNOWN] * len(texts), [0.0] * len(texts), [1.0] * len(texts)
        if not self.tables:
            return names, scores, rates
        pending: list[int] = []
        symbols: list[np.ndarray] = []

        def flush() -> None:
            if not pending:
                return
            table = self.phrases(symbols)
            best = table.argmin(axis=1)
            ranked = np.sort(table, axis=1)
            for row, at in enumerate(pending):
                names[at] = self.languages[best[row]]
                scores[at] = float(1 - ranked[row, 0] / ranked[row, 1]) if table.shape[1] > 1 else 1.0
                rates[at] = float(ranked[row, 0] / max(len(symbols[row]), SHORT))
            pending.clear()
            symbols.clear()

        held = 0
        for at, text in enumerate(texts):
            if text is None or not _LETTER.search(text):
                continue
            pending.append(at)
            symbols.append(self.symbols(text))
            held += len(symbols[-1])
            if held >= CHUNK:
                flush()
                held = 0
        flush()
        return names, scores, rates


def spread_sample(text: Column, chars: int) -> Column:
    """The text, or ``SLICES`` slices of it from start to end, ``chars`` characters at most."""
    size = max(1, (chars - SLICES + 1) // SLICES)
    room = F.length(text) - size
    starts = [F.floor(room * i / (SLICES - 1)).cast("int") + 1 for i in range(SLICES)]
    return F.when(F.length(text) <= chars, text).otherwise(F.concat_ws(" ", *[F.substring(text, at, F.lit(size)) for at in starts]))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> CrossParser:
    """A parser from a bounded sample of the labelled rows (doc_id, text, lang)."""
    labelled = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        F.col("lang"), spread_sample(F.col("text"), sample_chars).alias("piece"), F.xxhash64("doc_id").alias("at"))
    order = Window.partitionBy("lang").orderBy("at", "piece")
    chosen = labelled.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample_docs)
    samples: dict[str, list[str]] = {}
    for row in chosen.orderBy("lang", "rank").collect():  # bounded: sample_docs * sample_chars a language
        samples.setdefault(row["lang"], []).append(row["piece"])
    return CrossParser.learn({lang: " ".join(pieces) for lang, pieces in samples.items()})


def identify(docs: DataFrame, parser: CrossParser, keep: list[str]) -> DataFrame:
    """lang_pred, score and phrase_rate of every row's ``text``, with the columns ``keep`` as the
    struct ``kept``, whose names can't clash with them.

    Rows stream through in Arrow batches; kept columns pass through untouched.
    """
    small_batches(docs.sparkSession)
    names = {"lang_pred": pa.string(), "score": pa.float64(), "phrase_rate": pa.float64()}
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = parser.predict(batch.column("text").to_pylist())
            columns = [pa.array(v, type=t) for v, t in zip(values, names.values())]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), *columns], names=["kept", *names])

    kept = packed.schema["kept"].dataType.simpleString()
    return packed.mapInArrow(run, f"kept {kept}, lang_pred string, score double, phrase_rate double")


def in_known_language(docs: DataFrame, parser: CrossParser) -> DataFrame:
    """The rows, with all their columns, whose text has letters and reads as a learned language."""
    judged = identify(docs, parser, docs.columns)
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("phrase_rate") < REJECT_AT)).select("kept.*")
