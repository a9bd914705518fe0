"""Byte-level BPE encoding and decoding by backtracking over longest matches.

Bytes are mapped to Latin-1 characters, so one Aho-Corasick automaton over the vocabulary finds
every token inside a piece in one pass. The encoder always tries the longest token that starts
at its position. Two adjacent tokens are kept only if the merge rules, applied to their joined
bytes, would leave exactly these two tokens (``Merges.fit``, memoised); a sequence all of whose
neighbours fit is the one that the merges produce. If a token does not fit it is replaced by its
next shorter prefix, and if none fits the previous token is withdrawn and its end is marked dead,
so no position is left twice: the work is linear in the length of the piece.

The pattern's Unicode classes are those of the library whose splits are to be matched: code points
that the local ``regex`` module already counts as letters or numbers but that library does not
(``later_code_points``) are split as the unassigned characters they are to it.

Edge rows: a null text counts as empty; an empty text has no ids and the digests of no bytes;
repeated rows, repeated or null ids give one output row each; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from tillstream.llm.recent import LONG_TEXT, Recent
from tillstream.llm.texts import steps, strings

_MEMO_ROOM = 1_000_000


class Merges:
    """A vocabulary of byte strings by rank, with what encoding needs of it."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._ranks = ranks
        self._memo: dict[tuple[int, int], bool] = {}
        self._merged: dict[tuple[int, int], int] = {}
        self._halves = {rank: (rank, rank) for rank in self.tokens}
        self._shorter: dict[int, int] = {}
        self._trie = ahocorasick.Automaton()
        for token, rank in ranks.items():
            prefixes = (ranks.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            self._shorter[rank] = next((p for p in prefixes if p is not None), -1)
        for rank in sorted(self.tokens):
            self._take_apart(rank)
        for token, rank in ranks.items():
            # A token that no merge yields can only be a whole piece; encode() looks there first.
            if len(token) == 1 or self._halves[rank][0] != rank:
                self._trie.add_word(token.decode("latin-1"), rank)
        self._trie.make_automaton()
        self._length = {rank: len(token) for rank, token in self.tokens.items()}

    def _take_apart(self, rank: int) -> None:
        """Record which two earlier tokens the merges join last to form this one."""
        token, left = self.tokens[rank], self._shorter[rank]
        while left >= 0:
            right = self._ranks.get(token[len(self.tokens[left]):], rank)
            if left < rank and right < rank and self._holds(left, right):
                self._halves[rank] = (left, right)
                self._merged[left, right] = rank
                return
            left = self._shorter[left]

    def _holds(self, left: int, right: int) -> bool:
        """Would the merges leave the boundary between these two tokens alone?

        The younger token is undone first, as it was formed last. While a half at the boundary is
        undone, a merge across the boundary that is older than what was undone would have come
        before it, and the boundary would be gone."""
        undone = len(self._halves) + 1
        while True:
            across = self._merged.get((left, right))
            if across is not None and across < undone:
                return False
            inner_left, inner_right = self._halves[left][1], self._halves[right][0]
            if inner_left == left and inner_right == right:
                return True
            if inner_right == right or (inner_left != left and left > right):
                undone, left = left, inner_left
            else:
                # Equal ranks merge left to right, so an equal merge across comes first here.
                undone, right = right + 1, inner_right

    def fit(self, left: int, right: int) -> bool:
        """``_holds``, remembered."""
        known = self._memo.get((left, right))
        if known is None:
            if len(self._memo) >= _MEMO_ROOM:
                self._memo.clear()
            known = self._memo[left, right] = self._holds(left, right)
        return known

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece of text, as its merges in rank order produce them."""
        whole = self._ranks.get(piece)
        if whole is not None:
            return [whole]
        size, length, shorter, memo = len(piece), self._length, self._shorter, self._memo
        longest = [-1] * (size + 1)
        for end, token in self._trie.iter(piece.decode("latin-1")):
            longest[end + 1 - length[token]] = token  # later, longer matches replace shorter ones
        dead, ids, at, token = bytearray(size + 1), [], 0, longest[0]
        while at < size:
            while token >= 0:
                end = at + length[token]
                if not dead[end]:
                    if not ids:
                        break
                    pair = ids[-1], token
                    fits = memo.get(pair)
                    if self.fit(*pair) if fits is None else fits:
                        break
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                at, token = end, longest[end]
            else:
                dead[at] = 1
                token = ids.pop()
                at -= length[token]
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def merges_of(rank_file: str) -> Merges:
    """The vocabulary of a file of base64 tokens and ranks; built once per worker."""
    with open(rank_file, "rb") as lines:
        return Merges({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


@lru_cache(maxsize=4)
def _memo_of(rank_file: str) -> Recent:
    merges = merges_of(rank_file)
    return Recent(lambda pieces: [struct.pack(f"<{len(ids)}I", *ids) for ids in
                                  (merges.encode(piece.encode()) for piece in pieces)])


@lru_cache(maxsize=1)
def later_code_points() -> tuple[regex.Pattern, dict[int, str]]:
    """Letters and numbers known to ``regex`` but not to the target's engine, whose Unicode
    version is older: a pattern that finds one, and a table turning them into a noncharacter."""
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    engine = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]+", special_tokens={},
                               mergeable_ranks={bytes([b]): b for b in range(256)})
    known = engine.decode_bytes(engine.encode_ordinary(everything)).decode()
    later = set(regex.findall(r"[\p{L}\p{N}]", everything)) - set(known)
    opens = sorted(c for c in later if chr(ord(c) - 1) not in later)
    closes = sorted(c for c in later if chr(ord(c) + 1) not in later)
    spans = "".join(f"{a}-{z}" for a, z in zip(opens, closes))
    return regex.compile(f"[{spans}]" if spans else r"(?!)"), {ord(c): "\uffff" for c in later}


def split(text: str, splitter: regex.Pattern) -> Iterable[str]:
    """The pieces whose bytes are merged; those of a long text one by one."""
    try:
        text.encode("latin-1")  # a quick way to see that nothing later is in it
    except UnicodeEncodeError:
        later, table = later_code_points()
        if later.search(text):
            masked = text.translate(table)
            return (text[m.start():m.end()] for m in splitter.finditer(masked))
    if len(text) >= LONG_TEXT:
        return (m[0] for m in splitter.finditer(text))
    return splitter.findall(text)


def encode_texts(texts: list[str], rank_file: str, splitter: regex.Pattern) -> list[bytes]:
    """Ids of whole texts, packed as little-endian unsigned 32-bit integers."""
    memo = _memo_of(rank_file)
    if any(len(text) >= LONG_TEXT for text in texts):
        return [b"".join(map(b"".join, memo.parts(split(text, splitter)))) for text in texts]
    return list(map(b"".join, memo.rows([list(split(text, splitter)) for text in texts])))


def encode(docs: DataFrame, rank_file: str, pattern: str, id_column: str = "doc_id",
           text_column: str = "text", with_ids: bool = True) -> DataFrame:
    """Id, ``n_tokens``, digests of the packed ids and of the decoded bytes, and (with
    ``with_ids``) ``ids``: array<int>, of every text. ``rank_file`` must be readable at the same
    path on every executor."""
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, splitter = merges_of(rank_file), regex.compile(pattern)
        for step in steps(batches, "text"):
            packed = encode_texts(strings(step["text"]), rank_file, splitter)
            ids = [np.frombuffer(p, "<u4") for p in packed]
            columns = {
                "id": step["id"],
                "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                "decoded_sha256": pa.array(
                    [hashlib.sha256(merges.decode(i.tolist())).hexdigest() for i in ids]),
            }
            if with_ids:
                lengths = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
                flat = np.concatenate([np.empty(0, np.uint32), *ids]).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), flat)
            yield pa.RecordBatch.from_pydict(columns)

    out = f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    slim = docs.selectExpr(f"`{id_column}` AS id", f"`{text_column}` AS text")
    return (slim.mapInArrow(run, out + (", ids array<int>" if with_ids else ""))
            .withColumnRenamed("id", id_column))
