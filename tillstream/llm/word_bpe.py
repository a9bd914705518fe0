"""Word-level BPE encoding and decoding over an index of pair occurrences.

A tokenizer file of the kind read here composes and lower-cases a text, cuts words and single signs
out of it, and merges the bytes of each word, the last one marked by a suffix. The words of a
partition's batch that were not seen before lie side by side as one array of symbols, linked to
their neighbours inside the word. An index maps every pair that has a rank to all its positions.
The active ranks are applied in ascending order: a rank's positions are joined from the left, and the
pairs that the new symbol forms with its neighbours are filed under their own ranks. Every symbol is
made by one merge only and before it is used (checked when the file is loaded), so what is filed always
has a later rank and each word goes through the merges that the library would take.

Lower-casing and the classes of the pattern are the library's: texts with a code point that Python
normalises otherwise go through the library's normaliser, code points that ``regex`` classes
otherwise are stood in for while the text is cut.

Edge rows: a null text counts as empty; an empty text has no ids and decodes to an empty string;
repeated rows, repeated or null ids give one output row each; other columns are ignored. A very long
text is cut word by word and its words are merged in bounded parts; one unbroken word is merged
whole, for some 24 bytes of memory per byte, in time linear in its length.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, pre_tokenizers

from tillstream.llm.recent import LONG_TEXT, Recent
from tillstream.llm.texts import steps, strings

# Pairs that are filed at once while an index is built.
FILED_AT_ONCE = 1 << 20
# The pattern's classes, each under a member that can stand in for the others.
_CLASSES = {"a": r"\p{L}", "0": r"\p{N}", " ": r"\s"}
# ASCII characters that are white space to some libraries and not to others.
_SEPARATORS = re.compile("[\x1c-\x1f]")


def _any_of(points: Iterable[str]) -> re.Pattern:
    """A pattern that finds one of the given characters, or any beyond the basic plane."""
    numbers = sorted(map(ord, points))
    opens = [c for c, low in zip(numbers, [-2, *numbers]) if c != low + 1]
    closes = [c for c, high in zip(numbers, [*numbers[1:], -2]) if c + 1 != high]
    spans = "".join(f"\\u{a:04x}-\\u{z:04x}" for a, z in zip(opens, closes))
    return re.compile(f"[{spans}\U00010000-\U0010ffff]")


class _StandIns(dict):
    """Code points to what stands in for them while a text is cut: themselves where ``regex`` and
    the library agree on their class, else a member of the library's class."""

    def __missing__(self, point: int) -> int:
        kinds = set()
        for member, spelt in _CLASSES.items():
            cut = pre_tokenizers.Split(Regex(spelt), "removed", invert=True)
            kinds.add((bool(regex.match(spelt, chr(point))),
                       bool(cut.pre_tokenize_str(chr(point))), ord(member)))
        differs = any(own != theirs for own, theirs, _ in kinds)
        member = next((m for _, theirs, m in kinds if theirs), 0xFFFF)
        self[point] = found = member if differs else point
        return found


def byte_signs() -> dict[int, str]:
    """How byte-level vocabularies write each byte: printable Latin-1 as itself, others from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + n) for n, b in enumerate(hidden)}}


class PairMerges:
    """A vocabulary with its merges in rank order."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.tokens = {number: token for token, number in vocabulary.items()}
        self._base = base = max(self.tokens) + 1
        self._merges = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]
        made = {into: rank for rank, (_, _, into) in enumerate(self._merges)}
        if len(made) < len(merges) or any(made.get(part, -1) >= rank for rank, (a, b, _) in
                                          enumerate(self._merges) for part in (a, b)):
            raise ValueError("a symbol is made twice, or used before it is made")
        self._ranks = {a * base + b: rank for rank, (a, b, _) in enumerate(self._merges)}
        keys = np.array(list(self._ranks), np.int64)
        order = np.argsort(keys)
        self._keys, self._key_ranks = np.append(keys[order], np.int64(1) << 62), np.append(order, 0)
        signs = byte_signs()
        self._inner = np.array([vocabulary[signs[b]] for b in range(256)], np.int32)
        self._final = np.array([vocabulary[signs[b] + suffix] for b in range(256)], np.int32)

    def _filed(self, symbols: np.ndarray, last: np.ndarray) -> dict[int, array]:
        """Positions of every pair with a rank, by rank; ``last`` marks the ends of words."""
        places: dict[int, array] = {}
        for low in range(0, len(symbols) - 1, FILED_AT_ONCE):
            part = symbols[low:low + FILED_AT_ONCE + 1].astype(np.int64)
            keys = part[:-1] * self._base + part[1:]
            entry = np.searchsorted(self._keys, keys)
            at = np.flatnonzero((self._keys[entry] == keys) & ~last[low:low + len(keys)])
            ranks = self._key_ranks[entry[at]]
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], (at[order] + low).astype(np.int32)
            first = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]][:len(ranks)])
            for rank, begin, end in zip(ranks[first].tolist(), first, [*first[1:], len(at)]):
                places.setdefault(rank, array("i")).frombytes(at[begin:end].tobytes())
        return places

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (at least a byte long), packed as 32-bit integers."""
        ends = np.cumsum([len(word) for word in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        ids = self._inner[flat]
        ids[ends - 1] = self._final[flat[ends - 1]]
        starts = np.r_[0, ends[:-1]]
        last = np.zeros(len(flat), bool)
        last[ends - 1] = True
        places = self._filed(ids, last)
        follow, before = (np.arange(step, len(flat) + step, dtype=np.int32) for step in (1, -1))
        follow[ends - 1], before[starts] = -1, -1
        symbols, follow, before = (array("i", a.tobytes()) for a in (ids, follow, before))
        ranks, base, active = self._ranks, self._base, sorted(places)
        while active:
            rank = heappop(active)
            left, right, into = self._merges[rank]
            for at in sorted(places.pop(rank)):
                then = follow[at]
                # An occurrence whose symbols an earlier merge has taken is passed over.
                if symbols[at] != left or then < 0 or symbols[then] != right:
                    continue
                symbols[at], symbols[then] = into, -1
                beyond = follow[at] = follow[then]
                prior = before[at]
                formed = []
                if prior >= 0:
                    formed.append((ranks.get(symbols[prior] * base + into), prior))
                if beyond >= 0:
                    before[beyond] = at
                    formed.append((ranks.get(into * base + symbols[beyond]), at))
                for later, where in formed:
                    if later is not None:
                        spots = places.get(later)
                        if spots is None:
                            spots = places[later] = array("i")
                            heappush(active, later)
                        spots.append(where)
        left = np.frombuffer(symbols, np.int32)
        packed = left[left >= 0].tobytes()
        bounds = np.r_[0, np.cumsum(left >= 0)[ends - 1]] * 4
        return [packed[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' own spelling, joined by blanks, as a file without a decoder gives it."""
        return " ".join(map(self.tokens.__getitem__, ids))


class WordBpe:
    """A tokenizer file: special strings, words of a text, and ids of words."""

    def __init__(self, tokenizer_file: str):
        with open(tokenizer_file, encoding="utf-8") as file:
            spec = json.load(file)
        model, norm, cut = spec["model"], spec["normalizer"], spec["pre_tokenizer"]
        kinds = [part["type"] for part in norm["normalizers"] + cut["pretokenizers"]]
        split = cut["pretokenizers"][0]
        plain = not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]
                        for t in spec["added_tokens"])
        if (kinds != ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"] or model["type"] != "BPE"
                or split["behavior"] != "Removed" or not split["invert"] or not plain
                or spec["decoder"] or spec["post_processor"] or model["ignore_merges"]):
            raise ValueError(f"not a tokenizer of the kind this operator reads: {tokenizer_file}")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self._special = re.compile(f"({'|'.join(map(re.escape, names))})" if names else "((?!))")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = PairMerges(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.merges.tokens.update({number: token for token, number in self.special.items()})
        self._pattern = regex.compile(split["pattern"]["Regex"])
        self._normalizer = Tokenizer.from_file(tokenizer_file).normalizer
        self._memo = Recent(self._compute)

    @cached_property
    def _differences(self) -> tuple[re.Pattern, re.Pattern, dict[int, int]]:
        """What Python normalises otherwise than the library or does not know; what ``regex`` puts in
        another class, and stand-ins for that. Beyond the basic plane every character counts as odd."""
        points = [chr(c) for c in chain(range(1, 0xD800), range(0xE000, 0x10000))]
        everything = "".join(points)
        ours, theirs = {}, {}
        for name, spelt in _CLASSES.items():
            cut = pre_tokenizers.Split(Regex(f"{spelt}+"), "removed", invert=True)
            theirs[name] = set("".join(piece for piece, _ in cut.pre_tokenize_str(everything)))
            ours[name] = set("".join(regex.findall(f"{spelt}+", everything)))
        agreed = {ord(c): ord(c) for c in points}
        other = set().union(*(ours[name] ^ theirs[name] for name in _CLASSES))
        table = _StandIns(agreed | {ord(c): next((ord(n) for n in _CLASSES if c in theirs[n]), 0xFFFF)
                                    for c in other} | {0: 0})
        odd = {c for c in points if unicodedata.category(c) == "Cn"}
        # Marks are also tried in front of one of the highest and behind one of the lowest class.
        marks = [c for c in points if unicodedata.combining(c)]
        for form in ("{}", "\u0345{}", "{}\u0334"):
            tried = points if form == "{}" else marks
            apart = "\0".join(map(form.format, tried))
            odd |= {c for c, low, own in
                    zip(tried, self._normalizer.normalize_str(apart).split("\0"),
                        self._lowered(apart).split("\0"), strict=True)
                    if low != own and c not in theirs[" "]}
        return _any_of(odd), _any_of(other), table

    @staticmethod
    def _lowered(text: str) -> str:
        # Character by character: Python alone lower-cases a sigma by its place in the word.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _plain_words(self, text: str) -> Iterable[str]:
        lowered = masked = text.lower()
        if not text.isascii() or _SEPARATORS.search(text):
            odd, other, table = self._differences
            lowered = masked = (self._normalizer.normalize_str(text) if odd.search(text)
                                else self._lowered(text))
            if other.search(lowered):
                masked = lowered.translate(table)
                masked = lowered if masked == lowered else masked
        if masked is not lowered:
            return (lowered[m.start():m.end()] for m in self._pattern.finditer(masked))
        if len(text) >= LONG_TEXT:
            return (m[0] for m in self._pattern.finditer(lowered))
        return self._pattern.findall(lowered)

    def words(self, text: str) -> Iterable[str]:
        """The words of a text; a special string is a word behind a blank."""
        if not self._special.search(text):
            return self._plain_words(text)
        return chain.from_iterable(
            [f" {part}"] if n % 2 else self._plain_words(part)
            for n, part in enumerate(self._special.split(text)))

    def _compute(self, words: list[str]) -> list[tuple[bytes, str]]:
        plain = [word for word in words if word[0] != " "]
        packed = iter(self.merges.encode([word.encode() for word in plain]) if plain else [])
        found = [next(packed) if word[0] != " " else
                 np.array([self.special[word[1:]]], np.int32).tobytes() for word in words]
        return [(ids, self.merges.decode(np.frombuffer(ids, np.int32).tolist())) for ids in found]

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Packed ids, and what they decode to, of every text."""
        if any(len(text) >= LONG_TEXT for text in texts):
            return [self._joined(chain.from_iterable(self._memo.parts(self.words(text))))
                    for text in texts]
        return list(map(self._joined, self._memo.rows([list(self.words(t)) for t in texts])))

    @staticmethod
    def _joined(words: Iterable[tuple[bytes, str]]) -> tuple[bytes, str]:
        words = list(words)
        return b"".join([ids for ids, _ in words]), " ".join([spelt for _, spelt in words])


@lru_cache(maxsize=2)
def tokenizer_of(tokenizer_file: str) -> WordBpe:
    """The tokenizer of a file; built once per worker."""
    return WordBpe(tokenizer_file)


def encode(docs: DataFrame, tokenizer_file: str, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """Id, ``ids``: array<int>, and ``decoded``, the text these ids stand for, of every text.
    ``tokenizer_file`` must be readable at the same path on every executor."""
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(tokenizer_file)
        for step in steps(batches, "text"):
            found = tokenizer.encode(strings(step["text"]))
            bounds = np.r_[0, np.cumsum([len(ids) // 4 for ids, _ in found])]
            flat = np.frombuffer(b"".join([ids for ids, _ in found]), np.int32)
            yield pa.RecordBatch.from_pydict({
                "id": step["id"],
                "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat)),
                "decoded": pa.array([spelt for _, spelt in found], pa.string())})

    return (docs.selectExpr(f"`{id_column}` AS id", f"`{text_column}` AS text")
            .mapInArrow(run, f"id {id_type}, ids array<int>, decoded string")
            .withColumnRenamed("id", id_column))
