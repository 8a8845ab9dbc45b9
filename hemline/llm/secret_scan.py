"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds to them.

The patterns (``base_spans``) give spans of three kinds, ``assign``, ``access`` and ``hex``: the
whole matches, leftmost and without overlap per kind, in code points, end exclusive. Matches that
are too short are dropped, and what they cover isn't searched again.

The field tags tokens as outside a secret, its begin or inside it. Tokens are runs of letters and
digits, and single other characters. A token is described by its shape (length, kinds of
characters, share of digits), its own word, the words before and after it and the spaces between
them, and features of the whole file; features are numbers of rows in one weight table. Tagged spans
of ``SHORTEST`` characters and more that lie in no pattern's span are added as kind ``crf``.

1. Learning needs no labels but the patterns: what they call a secret is begin and inside. Of the
   texts with and without a pattern, ``SAMPLE_TEXTS`` each with the smallest digests are cut into
   windows of ``WINDOW`` tokens, and ``SAMPLE_WINDOWS`` each with and without a secret reach the
   driver, which fits the weights by the gradient of the exact likelihood. At every step features
   are left out at random, so that shape and neighbours are each learned to suffice.
2. All rows are tagged by Viterbi over whole texts: texts stand one after the other, with a token
   between them that is outside by definition, and the chain is cut into blocks whose max-plus
   products are computed together. That is exact, whatever the blocks.

NULL and empty texts have no spans. Repeated rows are scanned one by one. Without any secret to
learn from, nothing is added. An empty table gives an empty table; columns other than the named ones
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemline.llm.common import keep, small_batches

SAMPLE_TEXTS = 1_000
SAMPLE_WINDOWS = 1_000
WINDOW = 48
STEPS = 60
LEFT_OUT = 0.3
SHORTEST = 6
#: Characters of texts tagged as one chain, and tokens whose features are held at once.
CHAIN_CHARS, FEATURE_TOKENS = 1 << 20, 1 << 18
BLOCK = 128

KINDS = ("assign", "access", "hex", "crf")
# The patterns that the base spans follow.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, ACCESS_CHARS = "AKIA[A-Z0-9]+", 20
HEX, HEX_CHARS = "[0-9a-f]+", 24
ASSIGN_CHARS = 6

_ASSIGN = re.compile(ASSIGN, re.I | re.A)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(f"{ACCESS[:-1]}{{{ACCESS_CHARS - 4},}}")
_HEX = re.compile(f"{HEX[:-1]}{{{HEX_CHARS},}}")
#: Texts that any pattern may match, for the choice of the sample.
_ANY = rf"(?i:{ASSIGN})|{_ACCESS.pattern}|{_HEX.pattern}"

OUTSIDE, BEGIN, INSIDE = range(3)
NEVER = -1e6


def base_matches(text: str) -> Iterator[tuple[str, int, int, int, int]]:
    """(kind, start, end, start of the secret itself, its end) of every match that is long enough."""
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_CHARS:
                yield "assign", *m.span(), *m.span(2)
    # the shortest length in the pattern is the same as dropping short matches: these are runs of one class
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            yield "access", *m.span(), *m.span()
    for m in _HEX.finditer(text):
        yield "hex", *m.span(), *m.span()


def by_place(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def as_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


# Kinds of characters; code points from 128 on are letters, 129 in the table is the token between texts.
_SPACE, _HEX_LETTER, _SMALL, _CAPITAL, _DIGIT, _FAR, _SYMBOL, _BORDER = range(8)
_KIND = np.full(130, _SYMBOL, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[0x61:0x7B], _KIND[0x61:0x67], _KIND[0x41:0x5B], _KIND[0x30:0x3A] = _SMALL, _HEX_LETTER, _CAPITAL, _DIGIT
_KIND[128], _KIND[129] = _FAR, _BORDER
_BORDER_CODE = 0x110000
_LENGTHS = np.array([2, 4, 6, 8, 12, 16, 20, 24, 32, 40, 48])
_POWERS = np.cumprod(np.full(64, 1_000_003, np.uint64))
#: Numbers of words, and where each group of features begins in the weight table.
WORDS = 8_192
_WORD_CODES = WORDS + 129
_SIZES = (12 * 32 + 130, 12 * 5 + 1, _WORD_CODES, _WORD_CODES, _WORD_CODES, _WORD_CODES * 5, _WORD_CODES, 4, 9 * 16)
_BEGINS = np.concatenate(([0], np.cumsum(_SIZES)[:-1]))
FEATURES = int(sum(_SIZES))


@dataclass
class Tokens:
    """Tokens of texts one after the other; a border token stands before, between and after them."""

    start: np.ndarray  # code points, over all texts and borders
    end: np.ndarray
    counts: np.ndarray  # characters of each kind
    word: np.ndarray  # number of the word, or of the character
    text: np.ndarray  # number of the text; borders have that of the text before

    @property
    def border(self) -> np.ndarray:
        return self.counts[:, _BORDER] > 0


def _tokens_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, counts, word) of the tokens of a run of code points."""
    small = np.minimum(codes, 128)
    small[codes == _BORDER_CODE] = 129
    kind = _KIND[small]
    in_word = (kind >= _HEX_LETTER) & (kind <= _FAR)
    begins = kind != _SPACE
    begins[1:] &= ~(in_word[1:] & in_word[:-1])
    start = np.flatnonzero(begins)
    if not len(start):
        return start, start, np.zeros((0, 8), np.int32), start
    token = np.cumsum(begins) - 1
    token[:start[0]] = 0  # blanks before the first token; they are counted as blanks only
    counts = np.bincount(token * 8 + kind, minlength=8 * len(start)).reshape(-1, 8).astype(np.int32)
    length = counts[:, _HEX_LETTER:].sum(axis=1)
    at = np.minimum(np.arange(len(codes)) - start[token], 63)
    lowered = np.where(kind == _CAPITAL, codes + 32, np.where(kind == _SPACE, 0, codes)).astype(np.uint64)
    digest = np.add.reduceat(lowered * _POWERS[at], start)
    word = ((digest ^ digest >> np.uint64(29)) % np.uint64(WORDS)).astype(np.int32)
    alone = ~in_word[start]
    word[alone] = WORDS + np.minimum(codes[start[alone]], 128)
    return start, start + length, counts, word


def tokenise(texts: list[str]) -> Tokens:
    """Tokens of all texts; long texts are taken in pieces that end between two tokens."""
    parts, owner, at = [], [], 0
    border = np.array([_BORDER_CODE], np.uint32)
    for number, text in enumerate(texts):
        codes = np.concatenate((border, np.frombuffer(text.encode("utf-32-le"), np.uint32), border if number == len(texts) - 1 else border[:0]))
        begin = 0
        while begin < len(codes):
            end = min(begin + CHAIN_CHARS, len(codes))
            while end < len(codes) and not _splits(codes[end - 1]):
                end += 1
            start, stop, counts, word = _tokens_of(codes[begin:end])
            parts.append((start + at + begin, stop + at + begin, counts, word))
            owner.append(np.full(len(start), number, np.int32))
            begin = end
        at += len(codes)
    return Tokens(*map(np.concatenate, zip(*parts)), np.concatenate(owner))


def _splits(code: int) -> bool:
    return code < 128 and _KIND[code] in (_SPACE, _SYMBOL)


def _shifted(values: np.ndarray, by: int, fill: int) -> np.ndarray:
    out = np.full_like(values, fill)
    if by > 0:
        out[by:] = values[:-by]
    else:
        out[:by] = values[-by:]
    return out


def features(tokens: Tokens) -> Iterator[np.ndarray]:
    """Row numbers in the weight table, features by tokens, for successive slices of the tokens."""
    c, n = tokens.counts, len(tokens.word)
    letters = c[:, _HEX_LETTER:_FAR + 1].sum(axis=1)
    in_word = letters > 0
    size = np.searchsorted(_LENGTHS, letters, "right").astype(np.int32)
    kinds = sum((c[:, k] > 0).astype(np.int32) << i for i, k in enumerate((_HEX_LETTER, _SMALL, _CAPITAL, _DIGIT, _FAR)))
    shape = np.where(in_word, size * 32 + kinds, 12 * 32 + np.clip(tokens.word - WORDS, 0, 129))
    digits = np.where(in_word, size * 5 + np.minimum(4, 4 * c[:, _DIGIT] // np.maximum(letters, 1)), 12 * 5)
    # the last word or border before a token, beyond other characters, and how many stand between
    last = _shifted(np.maximum.accumulate(np.where(in_word | tokens.border, np.arange(n), 0)), 1, 0)
    word_before = tokens.word[last] * 5 + np.clip(np.arange(n) - last - 1, 0, 4)
    second = np.where(_shifted(tokens.border, 1, True), WORDS + 128, _shifted(tokens.word, 2, WORDS + 128))
    glued = np.zeros(n, np.int32)
    glued[1:] += tokens.start[1:] == tokens.end[:-1]
    glued[:-1] += 2 * (tokens.start[1:] == tokens.end[:-1])
    per_text = np.stack([np.bincount(tokens.text, c[:, k]) for k in (_DIGIT, _SYMBOL)])
    all_chars = np.maximum(np.bincount(tokens.text, c.sum(axis=1)), 1)
    of_file = sum(np.searchsorted((0.02, 0.08, 0.3), x / all_chars) * 4**i for i, x in enumerate(per_text)).astype(np.int32)
    coarse = np.where(in_word, np.searchsorted((6, 16, 32), letters, "right") * 2 + (c[:, _DIGIT] > 0), 8)
    columns = (
        shape, digits, tokens.word, _shifted(tokens.word, 1, WORDS + 128), second, word_before,
        _shifted(tokens.word, -1, WORDS + 128), glued, of_file[tokens.text] * 9 + coarse)
    for at in range(0, n, FEATURE_TOKENS):
        yield np.stack([x[at:at + FEATURE_TOKENS] + b for x, b in zip(columns, _BEGINS)]).astype(np.int32)


@dataclass
class Field:
    """Weights of features by tag, and of a tag after another; inside never follows outside."""

    weights: np.ndarray
    moves: np.ndarray

    @classmethod
    def start(cls) -> "Field":
        moves = np.zeros((3, 3))
        moves[OUTSIDE, INSIDE] = NEVER
        return cls(np.zeros((FEATURES, 3)), moves)

    def emissions(self, tokens: Tokens) -> np.ndarray:
        by_tag = np.concatenate([[sum(w[f] for f in part) for w in self.weights.T] for part in features(tokens)], axis=1)
        by_tag[BEGIN:, tokens.border] = NEVER
        return by_tag

    def spans(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """(start, end) of the tagged spans of every text."""
        tokens = tokenise(texts)
        tags = viterbi(self.emissions(tokens), self.moves)
        offset = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))) + 1
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        for b in np.flatnonzero(tags == BEGIN):
            last = b
            while tags[last + 1] == INSIDE:  # a border follows every text
                last += 1
            number = tokens.text[b]
            out[number].append((int(tokens.start[b] - offset[number]), int(tokens.end[last] - offset[number])))
        return out


def viterbi(scores: np.ndarray, moves: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The best tags of a chain, scores by tag and place, after an outside tag; the smaller tag on a tie.

    Blocks of the chain are reduced together to their best scores from any tag before to any last
    tag; a short chain over the blocks then fixes the tag at each border.
    """
    tags, n = scores.shape
    n_blocks = -(-n // block)
    gap = n_blocks * block - n  # filled with outside tags before the first
    padded = np.zeros((tags, n_blocks * block))
    padded[:, gap:], padded[BEGIN:, :gap] = scores, -np.inf
    steps = np.ascontiguousarray(padded.reshape(tags, n_blocks, block).transpose(2, 0, 1))  # place, tag, block

    def step(state: list[np.ndarray], own: np.ndarray, back: np.ndarray | None = None) -> list[np.ndarray]:
        """The best score of every tag after every state; ``back`` takes the tags they come from."""
        after = []
        for j in range(tags):
            best = state[0] + moves[0, j]
            for i in range(1, tags):
                through = state[i] + moves[i, j]
                if back is not None:
                    back[j][through > best] = i
                np.maximum(best, through, out=best)
            after.append(best + own[j])
        return after

    inner = []  # first tag, last tag, block
    for first in range(tags):
        state = [np.full(n_blocks, 0.0 if first == i else -np.inf) for i in range(tags)]
        for own in steps:
            state = step(state, own)
        inner.append(state)
    by_block = np.array(inner).transpose(2, 0, 1)
    before = np.full((n_blocks + 1, tags), -np.inf)
    before[0, OUTSIDE] = 0.0
    for b in range(n_blocks):
        before[b + 1] = (before[b][:, None] + by_block[b]).max(axis=0)
    back = np.zeros((block, tags, n_blocks), np.int8)
    state = list(np.ascontiguousarray(before[:-1].T))
    for own, came in zip(steps, back):
        state = step(state, own, came)
    # the tag before each block, for each tag at its end
    entry = np.repeat(np.arange(tags)[:, None], n_blocks, axis=1)
    for came in back[::-1]:
        entry = np.take_along_axis(came, entry, axis=0)
    last = np.empty(n_blocks, np.int64)
    tag = int(before[-1].argmax())
    for b in range(n_blocks - 1, -1, -1):
        last[b], tag = tag, int(entry[tag, b])
    out, now, columns = np.empty((block, n_blocks), np.int8), last, np.arange(n_blocks)
    for t in range(block - 1, -1, -1):
        out[t] = now
        now = back[t][now, columns]
    return out.T.reshape(-1)[gap:]


def likelihood(scores: np.ndarray, moves: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(log-likelihood, gradient by scores, gradient by moves) of tagged windows, each after an outside tag."""
    n, length, _ = scores.shape
    top = scores.max(axis=2)
    seen, step = np.exp(scores - top[:, :, None]), np.exp(moves)
    forward, scale, state = np.empty_like(scores), np.empty((n, length)), np.tile([1.0, 0.0, 0.0], (n, 1))
    for t in range(length):
        state = (state @ step) * seen[:, t]
        scale[:, t] = state.sum(axis=1)
        state = state / scale[:, t, None]
        forward[:, t] = state
    backward, both = np.ones((n, 3)), np.zeros((3, 3))
    wanted = np.empty_like(scores)
    for t in range(length - 1, -1, -1):
        wanted[:, t] = forward[:, t] * backward
        ahead = seen[:, t] * backward / scale[:, t, None]
        earlier = forward[:, t - 1] if t else np.tile([1.0, 0.0, 0.0], (n, 1))
        both += step * (earlier.T @ ahead)
        backward = ahead @ step.T
    before = np.concatenate((np.zeros((n, 1), tags.dtype), tags[:, :-1]), axis=1)
    rows, places = np.ogrid[:n, :length]
    value = scores[rows, places, tags].sum() + moves[before, tags].sum() - (np.log(scale) + top).sum()
    truth = np.zeros((3, 3))
    np.add.at(truth, (before.ravel(), tags.ravel()), 1)
    return float(value), np.eye(3)[tags] - wanted, truth - both


def fit(codes: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = 7) -> Field:
    """A field learned from windows: codes (feature, window, token) and tags (window, token)."""
    model, random = Field.start(), np.random.default_rng(seed)
    if not (tags == BEGIN).any():
        return model
    used, packed = np.unique(codes, return_inverse=True)
    packed = packed.reshape(codes.shape)
    weights = np.zeros((len(used), 3))
    values = [weights, model.moves]
    firsts, seconds = [np.zeros_like(x) for x in values], [np.zeros_like(x) for x in values]
    free = model.moves > NEVER
    for step in range(1, steps + 1):
        taken = random.random(codes.shape) >= LEFT_OUT
        scores = sum(weights[p] * t[..., None] for p, t in zip(packed, taken))
        _, by_score, by_move = likelihood(scores, model.moves, tags)
        by_weight = sum(
            np.stack([np.bincount(p.ravel(), (by_score[..., k] * t).ravel(), len(used)) for k in range(3)], axis=1) for p, t in zip(packed, taken))
        gradients = [by_weight - 0.02 * weights, np.where(free, by_move - 0.02 * model.moves, 0.0)]
        for x, g, a, b in zip(values, gradients, firsts, seconds):  # a step per weight by its gradients' mean and spread
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x += 0.15 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    model.weights[used] = weights * (1 - LEFT_OUT)
    return model


def tagged(text: str, tokens: Tokens) -> np.ndarray:
    """The tags that the patterns give to the tokens of one text."""
    tags = np.zeros(len(tokens.word), np.int8)
    for *_, start, end in base_matches(text):
        lo = np.searchsorted(tokens.end, start + 1, "right")
        hi = np.searchsorted(tokens.start, end + 1, "left")
        if not tags[lo:hi].any():
            tags[lo:hi], tags[lo] = INSIDE, BEGIN
    return tags


def learn(docs: DataFrame) -> Field:
    """A field learned from a bounded sample of the rows, labelled by the patterns."""
    rows = docs.where("text != ''").select("text", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("digest"), F.col("text").rlike(_ANY).alias("hit"))
    digests = keep(rows.select("digest", "hit"), "secret-digests")
    chosen = F.lit(False)
    for hit in (True, False):
        last = digests.where(F.col("hit") == hit).orderBy("digest").limit(SAMPLE_TEXTS).agg(F.max("digest")).first()[0]
        if last is not None:
            chosen = chosen | ((F.col("hit") == hit) & (F.col("digest") <= last))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, digest in zip(batch.column("text").to_pylist(), batch.column("digest").to_pylist()):
                tokens = tokenise([text])
                tags, out = tagged(text, tokens), []
                at = 0
                for codes in features(tokens):
                    for k in range(0, codes.shape[1], WINDOW):
                        part = codes[:, k:k + WINDOW]
                        own = tags[at + k:at + k + part.shape[1]].copy()
                        own[0] = BEGIN if own[0] == INSIDE else own[0]
                        order = int.from_bytes(hashlib.blake2b(f"{digest}:{at + k}".encode(), digest_size=7).digest(), "big")
                        out.append((order, bool(own.any()), part.tobytes(), own.tobytes()))
                    at += codes.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.bool_(), pa.binary(), pa.binary()))], names=["at", "secret", "codes", "tags"])

    small_batches(docs.sparkSession)
    windows = keep(rows.where(chosen).select("text", "digest").mapInArrow(cut, "at long, secret boolean, codes binary, tags binary"), "secret-windows")
    all_codes, all_tags = [], []
    for secret in (True, False):
        for r in windows.where(F.col("secret") == secret).orderBy("at", "codes", "tags").limit(SAMPLE_WINDOWS).collect():
            own = np.frombuffer(r["tags"], np.int8)
            codes = np.frombuffer(r["codes"], np.int32).reshape(-1, len(own))
            gap = WINDOW - len(own)  # filled up with the last token's features, a border's
            all_codes.append(np.concatenate((codes, np.repeat(codes[:, -1:], gap, axis=1)), axis=1))
            all_tags.append(np.concatenate((own, np.zeros(gap, np.int8))))
    if not all_codes:
        return Field.start()
    return fit(np.stack(all_codes, axis=1), np.stack(all_tags).astype(np.int64))


def scan(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """doc_id and ``spans``, an array of (kind, start, end) by start, of every row.

    Without a ``model`` one is learned from ``docs``.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model or learn(docs))  # FEATURES rows of three weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found: list[list[dict]] = []
            for chain in _chains(texts):
                added = field.spans(chain) if field.weights.any() else [[] for _ in chain]
                for text, tags in zip(chain, added):
                    base = [m[:3] for m in base_matches(text)]
                    new = [("crf", s, e) for s, e in tags if e - s >= SHORTEST and not any(b[1] <= s and e <= b[2] for b in base)]
                    found.append([{"kind": k, "start": s, "end": e} for k, s, e in by_place(base + new)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, _SPANS)], names=["doc_id", "spans"])

    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: int, end: int>>")


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _chains(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about ``CHAIN_CHARS`` characters."""
    chain, held = [], 0
    for text in texts:
        chain.append(text)
        held += len(text)
        if held >= CHAIN_CHARS:
            yield chain
            chain, held = [], 0
    if chain:
        yield chain
