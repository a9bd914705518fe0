"""Token counts of a sentence-piece BPE vocabulary by rank-synchronous merging of numpy arrays.

The normaliser of the model prefixes a text with a blank and turns blanks into U+2581. No piece of
the vocabulary has U+2581 behind another character (checked when it is loaded), so merges never
cross from a character to a following U+2581, and a text falls apart there into pre-tokens. The
pre-tokens not seen before are held as one ragged array of symbols. In each round every sequence
looks up the rank of each of its adjacent pairs and joins its own lowest-ranked pair; all
sequences do so at once, and those without a pair left drop out. What survives is counted: a
symbol of the vocabulary is one token, any other character as many as it has UTF-8 bytes.

A boundary between two symbols is dead when no piece holds the two side by side: no merge can cross it
any more. A long sequence is cut at its dead boundaries in every round, so the pieces of an unbroken run
get their lowest pairs joined at the same time, and a run costs little more than words of its length.

All places of a lowest pair are joined in one round (from the left where they overlap), unless the
new symbol has a better-ranked continuation than itself; then only the leftmost is, as the
library's queue would take the continuation first.

Edge rows: null counts as empty; an empty text has 0 bytes and 0 tokens; repeated rows, repeated
or null ids give one output row each; other columns are ignored. A very long text is cut into its
pre-tokens one by one and these are counted in bounded parts; one unbroken run is merged whole, for some
150 bytes of memory per character.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tillstream.llm.recent import LONG_TEXT, Recent
from tillstream.llm.texts import steps, strings, utf8

BLANK = "▁"
_NONE = np.int64(1) << 40
# Symbols from which a sequence is searched for dead boundaries.
LONG_RUN = 64


class RankMerges:
    """Pair ranks of a vocabulary, and counting by them."""

    def __init__(self, pieces: list[tuple[str, float]], add_prefix: bool = True):
        """``pieces``: strings that merges may form, with scores (higher merges first)."""
        self.add_prefix = add_prefix
        self._known = known = {piece for piece, _ in pieces}
        if any(re.search(f"[^{BLANK}]{BLANK}", piece) for piece in known):
            raise ValueError("a piece runs across a word start; pre-tokens would cut it")
        joined = {c for piece in known if len(piece) > 1 for c in piece}
        alone = "".join(c for c in "\t\n\r" if c not in joined)  # merges with nothing
        self._split = re.compile(f"{BLANK}*[^{BLANK}{alone}]+|{BLANK}+"
                                 + (f"|[{alone}]+" if alone else ""))
        parts = sorted({c for piece in known for c in piece} | known)
        self._number = number = {part: i for i, part in enumerate(parts)}
        ordered = sorted(pieces, key=lambda p: -p[1])
        rank = {piece: i for i, (piece, _) in enumerate(ordered)}
        keys, ranks, merged = [], [], []
        better_on: set[str] = set()
        for piece, r in rank.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in number and right in number:
                    keys.append(number[left] * len(parts) + number[right])
                    ranks.append(r)
                    merged.append(number[piece])
                    better_on |= {x for x in (left, right) if len(x) > 1 and rank[x] > r}
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self._keys = np.append(np.array(keys, np.int64)[order], _NONE << 20)
        self._ranks = np.append(np.array(ranks, np.int64)[order], _NONE)
        self._merged = np.append(np.array(merged, np.int64)[order], -1)
        self._one_by_one = np.zeros(len(parts) + 1, bool)
        self._one_by_one[[number[x] for x in better_on]] = True
        self._base = len(parts)
        chars = sorted(c for c in number if len(c) == 1)
        self._chars = np.array([ord(c) for c in chars] + [0x110000], np.int64)
        self._char_number = np.array([number[c] for c in chars] + [-1], np.int64)
        self._char_known = np.array([c in known for c in chars] + [False])

    def _symbols(self, sequences: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbol of each character (negative: in no piece) and the tokens it is on its own."""
        points = np.frombuffer("".join(sequences).encode("utf-32-le", "surrogatepass"),
                               "<u4").astype(np.int64)
        at = np.searchsorted(self._chars, points)
        same = self._chars[at] == points
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        return (np.where(same, self._char_number[at], -1),
                np.where(same & self._char_known[at], 1, width))

    @cached_property
    def _living(self) -> np.ndarray:
        """Keys of all pairs of symbols that stand side by side somewhere in a piece, sorted."""
        number, keys = self._number, set()
        for piece in self._known:
            for cut in range(1, len(piece)):
                lefts = [number[x] for x in (piece[a:cut] for a in range(cut)) if x in number]
                rights = [number[x] for x in (piece[cut:z] for z in range(cut + 1, len(piece) + 1))
                          if x in number]
                keys.update(left * self._base + right for left in lefts for right in rights)
        return np.append(np.sort(np.fromiter(keys, np.int64, len(keys))), _NONE << 20)

    def _cut(self, symbols: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Sequence numbers after a cut at every dead boundary."""
        keys = symbols[:-1] * self._base + symbols[1:]
        at = np.searchsorted(self._living, keys)
        joined = (self._living[at] == keys) & (symbols[:-1] >= 0) & (symbols[1:] >= 0)
        return np.cumsum(np.r_[False, ~joined | (group[1:] != group[:-1])])

    def count(self, sequences: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        counts = np.zeros(len(sequences), np.int64)
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        symbols, weights = self._symbols(sequences)
        owner = group = np.repeat(np.arange(len(sequences)), lengths)
        while len(symbols):
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            if np.diff(np.r_[first, len(symbols)]).max() > LONG_RUN:
                group = self._cut(symbols, group)
                first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            joint = np.full(len(symbols), _NONE)
            pairs = np.flatnonzero((group[1:] == group[:-1])
                                   & (symbols[1:] >= 0) & (symbols[:-1] >= 0))
            keys = symbols[pairs] * self._base + symbols[pairs + 1]
            entry = np.searchsorted(self._keys, keys)
            hit = self._keys[entry] == keys
            pairs, entry = pairs[hit], entry[hit]
            joint[pairs] = self._ranks[entry]
            best = np.minimum.reduceat(joint, first)
            sizes = np.diff(np.r_[first, len(symbols)])
            lowest = np.repeat(best, sizes)
            open_ = lowest < _NONE
            np.add.at(counts, owner[~open_], weights[~open_])
            chosen = joint[pairs] == lowest[pairs]
            at, into = pairs[chosen], self._merged[entry[chosen]]
            # Of a run of overlapping places, every other one; of cautious symbols, the leftmost.
            fresh = np.r_[True, np.diff(at) != 1][:len(at)]
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            take = (np.arange(len(at)) - run) % 2 == 0
            leads = np.r_[True, group[at[1:]] != group[at[:-1]]][:len(at)]
            take &= leads | ~self._one_by_one[into]
            at, into = at[take], into[take]
            symbols[at], weights[at] = into, 1
            open_[at + 1] = False
            symbols, weights, owner, group = symbols[open_], weights[open_], owner[open_], group[open_]
        return counts

    def pre_tokens(self, text: str) -> Iterable[str]:
        """The pre-tokens of a text; those of a long one come one by one."""
        marked = text.replace(" ", BLANK)
        if self.add_prefix and marked:
            marked = BLANK + marked
        if len(text) >= LONG_TEXT:
            return (m[0] for m in self._split.finditer(marked))
        return self._split.findall(marked)


@lru_cache(maxsize=4)
def merges_of(model_file: str) -> RankMerges:
    """The mergeable pieces of a sentence-piece BPE model; built once per worker."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    special = (model.is_control, model.is_unknown, model.is_byte)
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
              if not any(test(i) for test in special)]
    return RankMerges(pieces)


@lru_cache(maxsize=4)
def _memo_of(model_file: str) -> Recent:
    return Recent(lambda pieces: merges_of(model_file).count(pieces).tolist())


def count_texts(texts: list[str], model_file: str) -> list[int]:
    """Tokens of each text."""
    memo, cut = _memo_of(model_file), merges_of(model_file).pre_tokens
    if any(len(text) >= LONG_TEXT for text in texts):
        return [sum(map(sum, memo.parts(cut(text)))) for text in texts]
    return list(map(sum, memo.rows(list(map(cut, texts)))))


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """Id, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of each text."""
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            counts = count_texts(strings(step["text"]), model_file)
            yield pa.RecordBatch.from_pydict({
                "id": step["id"],
                "n_bytes": pa.array(np.diff(utf8(step["text"])[1]), pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()),
                "over_limit": pa.array([n > limit for n in counts], pa.bool_()),
            })

    return (docs.selectExpr(f"`{id_column}` AS id", f"`{text_column}` AS text")
            .mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
            .withColumnRenamed("id", id_column))
