"""Operator 7, SentencePiece encoding and decoding: an Aho-Corasick automaton drives a single-pass Viterbi.

The automaton over all pieces reads a text once; at every position its output
links name the pieces that end there, each of which relaxes the position's best
sum of scores. For unigram models that is all. The public vocabulary is a BPE
model, whose encoding is not the best sum over all ways to cut a text: there
only those pieces relax a position which merging would leave beside the last
piece of the position they start from, so that the best sum is taken over what
merges can make and the pass yields the library's own ids. No piece holds a space mark behind another character, so that texts fall into chunks that
are encoded apart and remembered.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

#: Where the public vocabularies are; a parameter of every function here.
MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
MARK = "▁"
#: Chunks, parts of chunks and pairs that a Python worker remembers; longer chunks and parts are encoded anew each time, so that the memory for them is bounded.
CHUNKS, PAIRS, LONGEST = 250_000, 200_000, 48


def read_model(path: str = MODEL) -> dict:
    """A model file as plain data: pieces, scores, ids by byte, the unknown's id, and whether it merges (BPE).

    Models that change texts before they cut them (normalisation, no space in
    front, spaces removed) are refused, as encoding here does none of that.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    if sp.decode(sp.encode(PROBE)) != PROBE or sp.id_to_piece(sp.encode("a")[0])[:1] != MARK:
        raise ValueError(f"{path} normalises texts, removes spaces or puts none in front")
    n = sp.get_piece_size()
    normal = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
    pieces = [sp.id_to_piece(i) for i in range(n)]
    return {
        "pieces": pieces,
        "scores": [sp.get_score(i) for i in range(n)],
        "normal": normal,
        "bytes": {int(pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)},
        "unknown": sp.unk_id(),
        # Scores of a BPE model count its merges down from zero; those of a unigram model are fractions.
        "merges": all(float(sp.get_score(i)).is_integer() for i in range(n)),
    }


#: The score of what is no piece.
_NONE = float("-inf")


#: What a model that changes texts would change: spaces, cases, ligatures, wide and composed characters, line ends.
PROBE = "  a  B\n\tﬁ Ａ e\u0301 ①  "


class Chunks(dict):
    """Ids of chunks as bytes of 32-bit numbers, made when asked for and forgotten when there are too many."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) > LONGEST:
            return self.encode(chunk)
        if len(self) >= CHUNKS:
            self.clear()
        made = self[chunk] = self.encode(chunk)
        return made


class Encoder:
    def __init__(self, model: dict):
        self.pieces, self.scores, self.bytes, self.unknown = model["pieces"], model["scores"], model["bytes"], model["unknown"]
        self.ids = {p: i for i, (p, ok) in enumerate(zip(self.pieces, model["normal"], strict=True)) if ok}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces hold a space mark behind another character")
        self.by_piece = {p: self.scores[i] for p, i in self.ids.items()}
        self.merges, self.allowed = model["merges"], {}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.inside = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        if any(len(p) > 1 and not all(c in self.ids for c in p) for p in self.ids):
            raise ValueError("pieces hold characters that are no pieces")
        self.chunks, self.parts = Chunks(self._encode_chunk), Chunks(self._encode_part)
        text = [p.replace(MARK, " ").encode() for p in self.pieces]
        for value, i in self.bytes.items():
            text[i] = bytes([value])
        for i, ok in enumerate(model["normal"]):
            if not ok and i not in self.bytes.values():
                text[i] = " ⁇ ".encode() if i == self.unknown else b""
        self.text = text

    def stays(self, a: int, b: int) -> bool:
        """Whether merging the characters of two neighbouring pieces ends with just these two."""
        if len(self.allowed) >= PAIRS:
            self.allowed.clear()
        x, y = self.pieces[a], self.pieces[b]
        got = self.allowed[a << 32 | b] = x + y not in self.ids and self._merged(x + y) == [x, y]
        return got

    def _merged(self, text: str) -> list[str]:
        """BPE by its definition: the best-scored pair, leftmost first, until no pair is a piece."""
        parts, score = list(text), self.score
        ranks = [score(x + y) for x, y in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = max(ranks)
            if best == _NONE:
                break
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = score(parts[k - 1] + parts[k])
            if k < len(ranks):
                ranks[k] = score(parts[k] + parts[k + 1])
        return parts

    def score(self, piece: str) -> float:
        return self.by_piece.get(piece, _NONE)

    def _encode_chunk(self, chunk: str) -> bytes:
        """A chunk's parts, cut where no piece holds the two characters side by side, encoded apart."""
        out, start, inside = [], 0, self.inside
        for k in range(1, len(chunk)):
            if chunk[k - 1 : k + 1] not in inside:
                out.append(self.parts[chunk[start:k]])
                start = k
        out.append(self.parts[chunk[start:]])
        return b"".join(out)

    def _encode_part(self, part: str) -> bytes:
        ids = self._viterbi(part) if part[0] in self.ids else self._fallback(part)
        return array("i", ids).tobytes()

    def _fallback(self, c: str) -> list[int]:
        """Ids of one character that is no piece."""
        return [self.bytes[x] for x in c.encode("utf-8", "surrogatepass")] if self.bytes else [self.unknown]

    def _viterbi(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces."""
        n = len(text)
        last, size, best = [-1] * (n + 1), [0] * (n + 1), [0.0] + [_NONE] * n
        merges, allowed, stays, scores = self.merges, self.allowed, self.stays, self.scores
        for end, (piece, length) in self.automaton.iter(text):
            start = end + 1 - length
            score = best[start] + scores[piece]
            if score > best[end + 1]:
                before = last[start]
                if merges and start and not ((ok := allowed.get(before << 32 | piece)) or (ok is None and stays(before, piece))):
                    continue
                best[end + 1], last[end + 1], size[end + 1] = score, piece, length
        out, at = [], n
        while at:
            out.append(last[at])
            at -= size[at]
        return out[::-1]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text; a space goes before its first character, as the models were trained."""
        if not text:
            return np.empty(0, np.int32)
        marked = MARK + text.replace(" ", MARK)
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, _CHUNK.findall(marked))), np.int32)

    def decode(self, ids: np.ndarray | list[int]) -> str:
        raw = b"".join(map(self.text.__getitem__, ids if isinstance(ids, list) else ids.tolist()))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Python workers are used again; an encoder is made once in each.
_encoders: dict[int, Encoder] = {}


def _encoder(sent) -> Encoder:
    key = sent.value["key"]
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(sent.value)
    return _encoders[key]


@lru_cache(maxsize=4)
def _model(path: str) -> dict:
    model = read_model(path)
    return model | {"key": (path, len(model["pieces"]))}


def encode(docs: DataFrame, path: str = MODEL, decoded: bool = False) -> DataFrame:
    """docs(text, ...) with token_ids array<int> and n_tokens; where asked for, also decoded, what the ids give back.

    Null and empty texts have no tokens. Whole texts are encoded; characters
    outside the vocabulary become the pieces of their bytes. Columns of docs with
    the names of new ones are replaced; an empty table gives none. The vocabulary
    is read on the driver and sent to the executors: its size does not depend on
    the data. Decoding in the same pass takes one Python worker a task, not two.
    """
    docs = docs.drop("token_ids", "n_tokens", *["decoded"] * decoded)
    sent = docs.sparkSession.sparkContext.broadcast(_model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(sent)
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                ids = [enc.encode(t) for t in part.column("text").to_pylist()]
                ends = np.cumsum([0, *(len(x) for x in ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)))
                cols, names = [*part.columns, lists, pa.array(np.diff(ends), pa.int64())], [*part.schema.names, "token_ids", "n_tokens"]
                if decoded:
                    cols, names = [*cols, pa.array(map(enc.decode, ids), pa.string())], [*names, "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)

    kinds = [f"`{c}` {t}" for c, t in docs.dtypes]
    return docs.mapInArrow(run, ", ".join([*kinds, "token_ids array<int>", "n_tokens bigint", *["decoded string"] * decoded]))


def decode(tokens: DataFrame, path: str = MODEL) -> DataFrame:
    """tokens(token_ids, ...) with decoded, the text that the ids stand for; null lists are empty, null ids the unknown."""
    tokens = tokens.drop("decoded")
    sent = tokens.sparkSession.sparkContext.broadcast(_model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(sent)
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                lists = part.column("token_ids")
                ends = np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)).tolist()
                ids = lists.flatten().fill_null(enc.unknown).to_numpy(zero_copy_only=False).tolist()
                texts = [enc.decode(ids[i:j]) for i, j in zip([0, *ends], ends, strict=False)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])

    kinds = [f"`{c}` {t}" for c, t in tokens.dtypes]
    return tokens.mapInArrow(run, ", ".join([*kinds, "decoded string"]))


def tokenized(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """The columns of docs but its text, with token_ids and n_tokens; null texts have none, rows that repeat are encoded each, no rows give none."""
    return encode(docs, path).drop("text")


def op7_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = encode(documents(spark, sf_dir).select("doc_id", "text"), decoded=True)
    ids = F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return made.select("doc_id", "n_tokens", ids.alias("token_ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), same.alias("round_trip"))
