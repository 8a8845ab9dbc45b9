"""Chat formatting at token level.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Header, text and the last line break are encoded
separately by a byte-level BPE whose vocabulary holds no control strings; the two control tokens are
reserved ids spliced between them, so no text can produce one. The loss mask of a turn is the prefix
sum of +1 and -1 at the first token of an assistant's text and after its last.

So that the decoded text can be taken apart as well, ``<|`` inside a role or text gets a backslash
after ``<`` (``<\\|`` gets another one), which is taken out again when reading back; a role's line
breaks and backslashes are escaped too.

Turns are formatted row by row. Reading back goes through conversations in order of turns, one batch
at a time; of an open conversation only its digests and counts are held, so a conversation of any
length needs no more memory. NULL text and NULL role are empty. Equal turns are ordered by role and
text. A NULL conversation id is a conversation of its own. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemline.llm.common import small_batches

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the public splitting pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
#: What the pattern takes for white space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Longer runs of white space overflow the splitter's stack, so they go past it.
LONGEST_BLANK = 10_000

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE_ESCAPED = re.compile(r"\\(\\|n)")
_BLANK = re.compile("[%s]{%d,}" % (WHITE, LONGEST_BLANK))


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _ROLE_ESCAPED.sub(lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


@lru_cache(maxsize=2)
def encoding(folder: str):
    """The tokenizer with two reserved ids after its vocabulary, once per worker."""
    import tiktoken

    with open(os.path.join(folder, VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    top = max(ranks.values()) + 1
    return tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={START: top, END: top + 1})


def encode(enc, text: str) -> list[int]:
    """Token ids of a whole text, as the encoder gives them.

    The pattern takes a run of white space as one piece, but for its last character where a word
    follows. Very long runs are cut out by that rule and merged as the piece they are: equal ids.
    """
    ids, at = [], 0
    for run in _BLANK.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += enc.encode_ordinary(text[at:run.start()]) + enc._encode_single_piece(text[run.start():end])
        at = end
    return ids + enc.encode_ordinary(text[at:])


def turn_tokens(enc, role: str, text: str) -> tuple[list[int], np.ndarray]:
    """Token ids of a turn and its loss mask."""
    start, end = (enc._special_tokens[s] for s in (START, END))
    parts = [[start], encode(enc, escape_role(role) + "\n"), encode(enc, escape(text)), [end], encode(enc, "\n")]
    ends = np.cumsum([len(p) for p in parts])
    change = np.zeros(ends[-1] + 1, dtype=np.int8)
    if role == LOSS_ROLE:
        change[ends[1]] += 1
        change[ends[2]] -= 1
    return [i for p in parts for i in p], np.cumsum(change[:-1], dtype=np.int8)


def format_turns(conversations: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """conv_id, turn, role, text, token_ids and loss_mask of every turn."""
    small_batches(conversations.sparkSession)

    def assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(tokenizers)
        for batch in batches:
            made = [turn_tokens(enc, r, t) for r, t in zip(batch["role"], batch["text"])]
            yield batch.assign(token_ids=[ids for ids, _ in made], loss_mask=[mask for _, mask in made])

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # NULL ids travel as a flag beside them: pandas has no NULL integer of its own
    flagged = rows.select(
        F.col("conv_id").isNull().alias("no_id"), F.coalesce("conv_id", F.lit(0)).alias("conv_id"),
        F.col("turn").isNull().alias("no_turn"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text")
    schema = "no_id boolean, conv_id long, no_turn boolean, turn long, role string, text string, token_ids array<int>, loss_mask array<tinyint>"
    return flagged.mapInPandas(assemble, schema)


class _Reader:
    """Digests of one conversation, fed with its turns."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, enc, ids: np.ndarray, mask: np.ndarray) -> None:
        start, end = (enc._special_tokens[s] for s in (START, END))
        opened, closed = np.flatnonzero(ids == start), np.flatnonzero(ids == end)
        for a, b in zip(opened, closed):  # as read back, one turn lies between two reserved ids
            role, _, text = enc.decode_bytes(ids[a + 1:b].tolist()).decode().partition("\n")
            self.turns.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
            self.n_turns += 1
        loss = unescape(enc.decode_bytes(ids[mask == 1].tolist()).decode())
        self.loss.update(loss.encode())
        self.loss_chars += len(loss)
        self.chars += len(enc.decode_bytes(ids.tolist()).decode())

    def row(self, no_id: bool, conv_id: int) -> tuple:
        return no_id, conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(turns: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """Per conversation, from its tokens: turns, texts under the loss mask, and length of the output."""
    columns = ["no_id", "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, key, reader, done = encoding(tokenizers), None, None, []
        for batch in batches:
            for no_id, conv_id, ids, mask in zip(batch["no_id"], batch["conv_id"], batch["token_ids"], batch["loss_mask"]):
                if (no_id, conv_id) != key:
                    done += [reader.row(*key)] if reader else []
                    key, reader = (no_id, conv_id), _Reader()
                reader.add(enc, np.asarray(ids), np.asarray(mask))
            yield pd.DataFrame(done, columns=columns)
            done = []
        if reader:
            yield pd.DataFrame([reader.row(*key)], columns=columns)

    order = ["no_id", "conv_id", F.col("no_turn").desc(), "turn", "role", "text"]
    sorted_turns = turns.repartition("no_id", "conv_id").sortWithinPartitions(*order)
    out = sorted_turns.select("no_id", "conv_id", "token_ids", "loss_mask").mapInPandas(
        read, "no_id boolean, conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.select(F.when(~F.col("no_id"), F.col("conv_id")).alias("conv_id"), *columns[2:])
