"""Operator 6, token counts: edit-aware counting on a tree of pre-tokens per document.

A text's pre-tokens (matches of the vocabulary's pattern) are encoded one by
one, so a text's count is a sum over them. Each document keeps a tree: its
leaves are blocks of pre-tokens with their lengths and counts, its inner nodes
sums of characters and tokens. An edit finds its place by the sums of
characters, re-encodes from a pre-token before the edit until the new
boundaries meet old ones behind it, and updates the sums above the blocks it
touched. Trees are stored as bytes, so that edits can come in later jobs.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

#: Where the public vocabulary is; a parameter of every function here.
RANKS = os.environ.get("TOKEN_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: The vocabulary's pre-token pattern, a fixed value of its format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens of a block at first, and at most before it is split.
BLOCK = 64
#: A pre-token is decided by its own characters and no more than this many behind it.
CONTEXT = 3
#: Pre-tokens that a Python worker remembers; longer ones are encoded anew each time, so that the memory for them is bounded.
_KNOWN, LONGEST = 500_000, 48


class Counts(dict):
    """Tokens of pre-tokens, encoded when asked for and forgotten when there are too many."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, part: str) -> int:
        if len(part) > LONGEST:
            return len(self.encoding.encode_ordinary(part))
        if len(self) >= _KNOWN:
            self.clear()
        made = self[part] = len(self.encoding.encode_ordinary(part))
        return made


_FIND = regex.compile(PATTERN)


def pre_tokens(text: str) -> list[str]:
    return _FIND.findall(text)


class Tree:
    """Blocks of pre-tokens' lengths and counts under a binary tree of their sums.

    Node k has the nodes 2k and 2k + 1 below it; blocks stand at width + their
    number. Nodes hold [characters, tokens, pre-tokens].
    """

    def __init__(self, blocks: list[np.ndarray]):
        self.blocks = blocks
        self._grow()

    @classmethod
    def of(cls, text: str, counts: Counts) -> Tree:
        parts = pre_tokens(text)
        both = np.array([list(map(len, parts)), list(map(counts.__getitem__, parts))], np.int32).reshape(2, -1)
        return cls([both[:, k : k + BLOCK] for k in range(0, both.shape[1], BLOCK)] or [np.zeros((2, 0), np.int32)])

    def _grow(self) -> None:
        self.width = 1 << max(0, len(self.blocks) - 1).bit_length()
        self.sums = np.zeros((2 * self.width, 3), np.int64)
        for k, x in enumerate(self.blocks):
            self.sums[self.width + k] = *x.sum(axis=1), x.shape[1]
        level = self.width
        while level > 1:
            self.sums[level // 2 : level] = self.sums[level : 2 * level].reshape(level // 2, 2, 3).sum(axis=1)
            level //= 2

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def parts(self) -> int:
        return int(self.sums[1, 2])

    def find(self, char: int) -> tuple[int, int]:
        """The block that holds the pre-token around a character, and where that block begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if begin + self.sums[node, 0] <= char and self.sums[node + 1, 2]:
                begin += int(self.sums[node, 0])
                node += 1
        return node - self.width, begin

    def edit(self, text: str, at: int, removed: int, added: str, counts: Counts) -> tuple[str, int]:
        """The edited text, and how many pre-tokens were encoded for it. Positions beyond the text are its end."""
        at = min(max(at, 0), len(text))
        removed = min(max(removed, 0), len(text) - at)
        new = text[:at] + added + text[at + removed :]
        shift = len(added) - removed
        first, begin = self.find(max(0, at - CONTEXT - 1))
        # Pre-tokens that end in front of the context stay.
        ends = begin + np.cumsum(self.blocks[first][0])
        stay = int(np.searchsorted(ends, at - CONTEXT, side="left"))
        start = int(ends[stay - 1]) if stay else begin
        last, end_first = self.find(at + removed)
        end_first += int(self.sums[self.width + last, 0])
        old_ends = np.cumsum(np.concatenate([x[0] for x in self.blocks[first : last + 1]])) + begin
        lengths: list[int] = []
        tokens: list[int] = []
        pos, resume = start, None
        stop = at + len(added)
        for m in _FIND.finditer(new, start):
            piece = m.group()
            lengths.append(len(piece))
            tokens.append(counts[piece])
            pos = m.end()
            if pos >= stop:
                # A boundary that the old text had as well: all that follows is as it was.
                while last < len(self.blocks) - 1 and old_ends[-1] < pos - shift:
                    last += 1
                    old_ends = np.concatenate((old_ends, old_ends[-1] + np.cumsum(self.blocks[last][0])))
                k = int(np.searchsorted(old_ends, pos - shift))
                if k < len(old_ends) and old_ends[k] == pos - shift:
                    resume = k + 1
                    break
        if resume is None:
            last = len(self.blocks) - 1
        old = np.concatenate(self.blocks[first : last + 1], axis=1)
        tail = old[:, resume:] if resume is not None else old[:, :0]
        fresh = np.concatenate((old[:, :stay], np.array([lengths, tokens], np.int32).reshape(2, -1), tail), axis=1)
        self._replace(first, last, fresh)
        return new, len(lengths)

    def _replace(self, first: int, last: int, fresh: np.ndarray) -> None:
        n = last - first + 1
        size = -(-fresh.shape[1] // n)
        if 0 < size <= 2 * BLOCK:
            for k in range(n):
                self.blocks[first + k] = fresh[:, k * size : (k + 1) * size]
                node = self.width + first + k
                self.sums[node] = *self.blocks[first + k].sum(axis=1), self.blocks[first + k].shape[1]
            # Only the sums above the blocks that changed.
            lo, hi = (self.width + first) // 2, (self.width + last) // 2
            while lo:
                for node in range(lo, hi + 1):
                    self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]
                lo, hi = lo // 2, hi // 2
        else:
            self.blocks[first : last + 1] = [fresh[:, k : k + BLOCK] for k in range(0, fresh.shape[1], BLOCK)]
            if not self.blocks:
                self.blocks = [np.zeros((2, 0), np.int32)]
            self._grow()

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.blocks), *(x.shape[1] for x in self.blocks)], np.int32)
        return b"".join([sizes.tobytes(), *(np.ascontiguousarray(x).tobytes() for x in self.blocks)])

    @classmethod
    def from_bytes(cls, blob: bytes) -> Tree:
        n = int(np.frombuffer(blob, np.int32, 1)[0])
        at, blocks = 4 * (n + 1), []
        for size in np.frombuffer(blob, np.int32, n, 4).tolist():
            blocks.append(np.frombuffer(blob, np.int32, 2 * size, at).reshape(2, size))
            at += 8 * size
        return cls(blocks)


@lru_cache(maxsize=4)
def read_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


#: Python workers are used again; the counts of pre-tokens are kept in each.
_counts: dict[str, Counts] = {}


def _known(path: str, sent) -> Counts:
    if path not in _counts:
        _counts.clear()
        _counts[path] = Counts(sent.value)
    return _counts[path]


def token_trees(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """docs(text, ...) with n_tokens and tree. Null texts are empty; columns of those names are replaced; rows that repeat have a tree each; no rows give none."""
    docs = docs.drop("n_tokens", "tree")
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _known(path, sent)
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                trees = [Tree.of(t or "", counts) for t in part.column("text").to_pylist()]
                cols = [pa.array([t.tokens for t in trees], pa.int64()), pa.array([t.to_bytes() for t in trees], pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], [*part.schema.names, "n_tokens", "tree"])

    kinds = [f"`{c}` {t}" for c, t in docs.dtypes]
    return docs.mapInArrow(run, ", ".join([*kinds, "n_tokens bigint", "tree binary"]))


def apply_edits(trees: DataFrame, path: str = RANKS) -> DataFrame:
    """trees(text, tree, edits, ...) after its edits: text, tree, n_tokens and n_encoded are those of the edited text.

    edits is a list of (at, removed, added), applied one after the other: removed
    characters at a position give way to added. Positions beyond the text are its
    end, nulls are 0 and empty, and so are null texts; null edits leave the text.
    A null tree is made from the text. n_encoded counts the pre-tokens that were
    encoded, by the edits or for a missing tree; the others' counts come from the
    tree. Columns of the names given are replaced; no rows give none.
    """
    sent = trees.sparkSession.sparkContext.broadcast(read_ranks(path))
    rest = [c for c in trees.columns if c not in ("text", "tree", "edits", "n_tokens", "n_encoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _known(path, sent)
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part, rows = b.slice(k, 500), []
                for text, blob, edits in zip(*(part.column(c).to_pylist() for c in ("text", "tree", "edits")), strict=True):
                    text = text or ""
                    tree = Tree.of(text, counts) if blob is None else Tree.from_bytes(blob)
                    n = tree.parts if blob is None else 0
                    for e in edits or ():
                        text, fresh = tree.edit(text, e["at"] or 0, e["removed"] or 0, e["added"] or "", counts)
                        n += fresh
                    rows.append((text, tree.to_bytes(), tree.tokens, n))
                kinds = [pa.string(), pa.binary(), pa.int64(), pa.int64()]
                cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), *cols], [*rest, "text", "tree", "n_tokens", "n_encoded"])

    kinds = [f"`{c}` {t}" for c, t in trees.dtypes if c in rest]
    return trees.mapInArrow(run, ", ".join([*kinds, "text string", "tree binary", "n_tokens bigint", "n_encoded bigint"]))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text, and after three edits of it: a heading before it, a cut in its middle, a replaced last line end."""
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    trees = token_trees(docs).withColumnRenamed("n_tokens", "n_tokens_before")
    n = F.length("text")
    edit = lambda at, removed, added: F.struct(at.cast("int").alias("at"), removed.cast("int").alias("removed"), added.alias("added"))
    edits = F.array(
        edit(F.lit(0), F.lit(0), F.concat(F.lit("Document "), F.col("doc_id").cast("string"), F.lit("\n\n"))),
        edit(F.floor(n / 2), F.floor(n / 20), F.lit("")),
        edit(n, F.lit(5), F.substring("text", 1, 40)),
    )
    after = apply_edits(trees.withColumn("edits", edits))
    return after.select("doc_id", "n_tokens_before", F.col("n_tokens").alias("n_tokens_after"), "n_encoded", F.sha2("text", 256).alias("edited_sha256"))
