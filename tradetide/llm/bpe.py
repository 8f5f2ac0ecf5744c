"""Exact byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece of text there is exactly one token its encoding can
end with.  It is found among the vocabulary entries that are suffixes of the
prefix (an automaton over the vocabulary yields them) by testing whether the
token may stand after the unique last token of the shorter prefix.  Following
the stored tokens backwards gives the ids; no merge loop runs, and the work is
linear in the text even for a single very long word.

Defined results: a null text counts as empty; an empty text has no ids; rows
are handled one by one, so repeated rows give repeated results and columns the
operator does not need are carried along untouched.  Input columns that have
the name of a result column are replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CACHED_PIECES = 400_000
CACHED_STEPS = 1_000_000
NEVER = 1 << 60


def splitting(letters: str, numbers: str, space: str) -> re.Pattern:
    """The split before the merges: contractions, letters, numbers, other signs, white space.

    Letters stand first as the most frequent; no text can start two of the
    first three kinds, so their order doesn't matter.
    """
    # The contractions.
    contractions = "'(?:s|t|re|ve|m|ll|d)"
    return re.compile(
        f" ?[{letters}]+|{contractions}| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+")


@lru_cache(1)
def split_any():
    """For any text: letters and numbers are Unicode's L and N, white space is White_Space."""
    kinds = {"L": [], "N": []}
    for code in range(sys.maxunicode + 1):
        ranges = kinds.get(unicodedata.category(chr(code))[0])
        if ranges is not None:
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    letters, numbers = (
        "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) for ranges in kinds.values())
    # The white space characters.
    space = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
    return splitting(letters, numbers, space).findall


# Small character sets are several times faster; they do for most Latin text.
SMALL = "A-Za-zÀ-ÖØ-öø-ɏ"
beyond_small = re.compile(f"[^\x00-\x7f{SMALL}]").search
split_small = splitting(SMALL, "0-9", "\\t-\\r ").findall


def split(text: str) -> list[str]:
    return split_any()(text) if beyond_small(text) else split_small(text)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens as bytes, the merge that makes each, and the suffix automaton."""

    def __init__(self, definition: str):
        data = json.loads(definition)
        alphabet = byte_alphabet()
        ids = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = 1 + max([*ids.values(), *self.special.values()])
        self.token_bytes = [b""] * size
        for text, i in ids.items():
            if text not in self.special:
                self.token_bytes[i] = bytes(alphabet[c] for c in text)
        for text, i in self.special.items():
            self.token_bytes[i] = text.encode()
        self.rank = [-1] * size
        self.halves: list[tuple[int, int] | None] = [None] * size
        self.merge_rank: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, made = ids[left], ids[right], ids[left + right]
            self.merge_rank.setdefault((a, b), rank)
            if self.halves[made] is None:
                self.halves[made], self.rank[made] = (a, b), rank
        self._build_automaton([i for text, i in ids.items() if text not in self.special])
        self.borders: dict[int, bool] = {}
        self.pieces = Pieces(self)
        self.cut = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.as_objects = np.array(self.token_bytes, object)

    def _build_automaton(self, tokens: list[int]) -> None:
        """States are the prefixes of tokens.  ``token`` is the one a state spells, if
        any; ``shorter`` leads to the next shorter suffix that is a token."""
        self.step: dict[int, int] = {}
        self.token, self.depth = [-1], [0]
        inner = [[]]
        for i in tokens:
            state = 0
            for byte in self.token_bytes[i]:
                key = state << 8 | byte
                after = self.step.get(key)
                if after is None:
                    after = self.step[key] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(self.depth[state] + 1)
                    inner.append([])
                    inner[state].append((byte, after))
                state = after
            self.token[state] = i
        self.fail = [0] * len(self.token)
        self.shorter = [0] * len(self.token)
        queue = [0]
        for state in queue:
            for byte, after in inner[state]:
                if state:
                    self.fail[after] = self._advance(self.fail[state], byte)
                back = self.fail[after]
                self.shorter[after] = back if self.token[back] >= 0 else self.shorter[back]
                queue.append(after)

    def _advance(self, state: int, byte: int) -> int:
        """The longest suffix of the state's text plus the byte that is a state."""
        while True:
            after = self.step.get(state << 8 | byte)
            if after is not None:
                return after
            if not state:
                return 0
            state = self.fail[state]

    def compatible(self, a: int, b: int) -> bool:
        """Whether encoding both tokens' bytes as one piece gives exactly a, b.

        Goes back in time over the two tokens that meet at the border.  A pair
        of neighbours that would merge before one of them was used up in its
        own token makes the border impossible.  Equal merges run from left to
        right: the left part's first, then the border's, then the right part's.
        """
        a_until = b_until = NEVER
        while True:
            rank = self.merge_rank.get((a, b))
            if rank is not None and rank < a_until and rank <= b_until:
                return False
            if self.rank[a] > self.rank[b]:
                a_until, a = self.rank[a], self.halves[a][1]
            elif self.halves[b] is not None:
                b_until, b = self.rank[b], self.halves[b][0]
            else:
                return True

    def encode_piece(self, raw: bytes) -> list[int]:
        """Ids of one piece: unique last token of every prefix, then backwards."""
        last = [-1] * (len(raw) + 1)
        step, token_of, depth, shorter = self.step, self.token, self.depth, self.shorter
        borders = self.borders
        state = end = 0
        for byte in raw:
            end += 1
            after = step.get(state << 8 | byte)
            if after is None:
                after = self._advance(state, byte)
                if len(step) < CACHED_STEPS:
                    step[state << 8 | byte] = after
            state = suffix = after
            if token_of[suffix] < 0:
                suffix = shorter[suffix]
            while suffix:
                token = token_of[suffix]
                start = end - depth[suffix]
                if not start:
                    last[end] = token
                    break
                before = last[start]
                if before >= 0:
                    key = before << 32 | token
                    fits = borders.get(key)
                    if fits is None:
                        if len(borders) >= CACHED_STEPS:
                            borders.clear()
                        fits = borders[key] = self.compatible(before, token)
                    if fits:
                        last[end] = token
                        break
                suffix = shorter[suffix]
        ids = []
        at = len(raw)
        while at:
            token = last[at]
            ids.append(token)
            at -= len(self.token_bytes[token])
        return ids[::-1]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers.

        Special tokens written out in the text become their ids.
        """
        if self.cut is None:
            return b"".join(map(self.pieces.__getitem__, split(text)))
        parts, at = [], 0
        for found in self.cut.finditer(text):
            parts += map(self.pieces.__getitem__, split(text[at:found.start()]))
            parts.append(self.special[found[0]].to_bytes(4, "little"))
            at = found.end()
        parts += map(self.pieces.__getitem__, split(text[at:] if at else text))
        return b"".join(parts)

    def encode_ordinary(self, text: str) -> bytes:
        """As encode, but special tokens in the text are plain text."""
        return b"".join(map(self.pieces.__getitem__, split(text)))

    def decode(self, ids: bytes) -> bytes:
        """The bytes the ids stand for, special tokens included."""
        return b"".join(self.as_objects[np.frombuffer(ids, "<u4")].tolist())


class Pieces(dict):
    """Ids of pieces seen before; emptied when it holds CACHED_PIECES."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        ids = np.array(self.vocabulary.encode_piece(raw), "<u4").tobytes()
        if len(raw) <= 64:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(definition: str) -> Vocabulary:
    """The vocabulary of a definition, built once in each Python process."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(definition)
    return _LOADED[key]


def read_definition(path: str) -> str:
    """A tokenizer's JSON file: a few MB, whatever the size of the corpus."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def per_batch(frame: DataFrame, convert, replaced: list[str], added: list[T.StructField]) -> DataFrame:
    """Rows of the frame with columns ``added`` that ``convert(batch)`` returns as arrays.

    Columns listed in ``replaced``, and those with the name of an added one, go.
    """
    gone = {*replaced, *(f.name for f in added)}
    keep = [f for f in frame.schema.fields if f.name not in gone]
    names = [f.name for f in [*keep, *added]]

    def run(batches):
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in keep]
            yield pa.RecordBatch.from_arrays([*columns, *convert(batch)], names=names)

    return frame.mapInArrow(run, T.StructType([*keep, *added]))


def texts_of(batch: pa.RecordBatch, column: str):
    """The column's values one by one, nulls as empty text."""
    for value in batch.column(batch.schema.get_field_index(column)):
        yield value.as_py() or ""


def encode(docs: DataFrame, definition: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (binary, little-endian 32-bit) in place of the text, and ``n_tokens``."""

    def convert(batch):
        words = vocabulary(definition)
        ids = [words.encode(t) for t in texts_of(batch, text)]
        return [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]

    return per_batch(docs, convert, [text], [
        T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())])


def decode(encoded: DataFrame, definition: str) -> DataFrame:
    """``encoded`` with ``text`` read back in place of ``ids``."""

    def convert(batch):
        words = vocabulary(definition)
        column = batch.column(batch.schema.get_field_index("ids"))
        texts = [words.decode(x.as_py() or b"").decode("utf-8", "replace") for x in column]
        return [pa.array(texts, pa.string())]

    return per_batch(encoded, convert, ["ids"], [T.StructField("text", T.StringType())])


def encode_and_decode(docs: DataFrame, definition: str, text: str = "text") -> DataFrame:
    """Both directions in one pass: ``ids``, ``n_tokens`` and ``decoded`` (binary UTF-8)."""

    def convert(batch):
        words = vocabulary(definition)
        ids = [words.encode(t) for t in texts_of(batch, text)]
        return [
            pa.array(ids, pa.binary()),
            pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array([words.decode(x) for x in ids], pa.binary()),
        ]

    return per_batch(docs, convert, [text], [
        T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("decoded", T.BinaryType())])


def digests(docs: DataFrame, definition: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded text."""
    done = encode_and_decode(docs.select("doc_id", "text"), definition)
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
