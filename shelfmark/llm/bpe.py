"""BPE encoding and decoding with a vocabulary file whose tokens end words with a suffix.

Method: a short word is a contiguous array of part boundaries with the ranks of
adjacent parts beside it. The smallest rank is found by a scan, its boundary is
deleted, and the two neighbouring ranks are refreshed, until no pair has a rank.
Words repeat, so each worker keeps the results of the words that it has seen, up
to a fixed number. Long words use a heap over linked parts; the result is the same.

The file's steps are followed as its own library runs them: special tokens are cut
out of the raw text, then NFC, white space, lower case, the split into letters,
single digits and other marks, and the mapping of UTF-8 bytes to letters.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import TextFunction, map_texts

# Parts of a word up to which the array is scanned; above it, a heap finds the next pair.
SHORT_WORD = 256
# Words whose results a worker keeps; a full store is emptied. It bounds memory only.
KEPT_WORDS = 250_000
# Longer words are not kept.
KEPT_LENGTH = 48


# Capitals that Python's Unicode tables do not know yet and the library does, with their small letters.
ADDED_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
               0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
ADDED_LOWER |= {c: c + 32 for c in range(0x10D50, 0x10D66)} | {c: c + 27 for c in range(0x16EA0, 0x16EB9)}

# Blocks of letters and digits that the library's pattern engine knows and Python's Unicode tables do not.
ADDED_BLOCKS = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D85), (0x10EC2, 0x10EC4),
                (0x11380, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x16139),
                (0x16D40, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5FA))

# Texts below this code point are split by a pattern with plain ranges, which is faster.
LATIN_END = 0x250


def latin_pattern(pattern: str) -> str:
    """The split pattern with the classes of letters, numbers and white space written out up to ``LATIN_END``."""
    own = [chr(i) for i in range(LATIN_END)]
    written = {kind: "".join(re.escape(c) for c in own if unicodedata.category(c)[0] == kind) for kind in "LN"}
    for name, chars in ((r"\p{L}", written["L"]), (r"\p{N}", written["N"]), (r"\s", r" \t-\r\x85\xa0")):
        pattern = pattern.replace(name, chars)
    return pattern


def assigned_pattern(pattern: str) -> str:
    """The split pattern without letters and numbers that are newer than the library's pattern engine."""
    late = [chr(i) for i in range(LATIN_END, sys.maxunicode + 1)
            if unicodedata.category(chr(i)) == "Cn" and not any(a <= i <= b for a, b in ADDED_BLOCKS)
            and regex.match(r"[\p{L}\p{N}]", chr(i))]
    late = "".join(late)
    return pattern.replace(r"[\p{L}]", rf"[\p{{L}}--[{late}]]").replace(r"[\p{N}]", rf"[\p{{N}}--[{late}]]").replace(
        r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]{late}]") if late else pattern


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1 stands for itself, the rest moves above 255."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    moved = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(moved)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, number in [*vocab.items(), *self.special.items()]:
            self.tokens[number] = token
        # A part pair is one number; its value packs the rank and the id of the merged part.
        self.width = len(self.tokens)
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.merges.setdefault(vocab[left] * self.width + vocab[right], (rank, vocab[left + right]))
        letters = byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.final = [vocab[x + suffix] for x in letters]
        patterns = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.latin = re.compile(latin_pattern(patterns[0])).findall
        self.beyond_latin = re.compile(f"[^\\x00-{chr(LATIN_END - 1)}]").search
        self.pattern = patterns[0]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        self.known: dict[str, bytes] = {}

    @cached_property
    def split(self):
        return regex.compile(assigned_pattern(self.pattern), regex.V1).findall

    def merge_short(self, ids: list[int]) -> list[int]:
        """Repeatedly merge the leftmost pair of the smallest rank, scanning the array of ranks."""
        merges, width, none = self.merges, self.width, (1 << 62, -1)
        pairs = [merges.get(a * width + b, none) for a, b in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best is none:
                break
            at = pairs.index(best)
            ids[at] = best[1]
            del ids[at + 1], pairs[at]
            if at:
                pairs[at - 1] = merges.get(ids[at - 1] * width + ids[at], none)
            if at < len(pairs):
                pairs[at] = merges.get(ids[at] * width + ids[at + 1], none)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same merges in n log n: a heap of (rank, place), stale entries skipped."""
        merges, width, n = self.merges, self.width, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found[0], i, ids[i], ids[i + 1], found[1]) for i in range(n - 1)
                if (found := merges.get(ids[i] * width + ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = merged, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := merges.get(merged * width + ids[k]):
                    heapq.heappush(heap, (found[0], i, merged, ids[k], found[1]))
            if (h := before[i]) >= 0 and (found := merges.get(ids[h] * width + merged)):
                heapq.heappush(heap, (found[0], h, ids[h], merged, found[1]))
        return [x for x in ids if x >= 0]

    def word(self, word: str) -> bytes:
        """The ids of one word as packed 32-bit numbers."""
        data = word.encode()
        inner = self.inner
        ids = [inner[b] for b in data]
        ids[-1] = self.final[data[-1]]
        ids = self.merge_short(ids) if len(ids) <= SHORT_WORD else self.merge_long(ids)
        packed = np.array(ids, np.int32).tobytes()
        if len(word) <= KEPT_LENGTH:
            if len(self.known) >= KEPT_WORDS:
                self.known.clear()
            self.known[word] = packed
        return packed

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case goes letter by letter
        text = text.lower()
        split = self.latin
        if self.beyond_latin(text):
            text, split = text.translate(ADDED_LOWER), self.split
        known, word = self.known.get, self.word
        return b"".join([known(w) or word(w) for w in split(text)])

    def encode(self, text: str) -> bytes:
        if self.cut is None or "<|" not in text and not any(s in text for s in self.special):
            return self.plain(text)
        parts = [np.int32(self.special[p]).tobytes() if i % 2 else self.plain(p) for i, p in enumerate(self.cut(text))]
        return b"".join(parts)

    def decode(self, ids: np.ndarray) -> str:
        """The file names no decoder: tokens are joined by one space, special ones included."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids.tolist()])


@lru_cache(maxsize=2)
def codec(content: str) -> Codec:
    return Codec(content)


def _vocabulary(df: DataFrame, path: str):
    """The file, read once by the driver and sent to the workers: its size is that of one vocabulary."""
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode_decode(df: DataFrame, vocabulary: str, text_col: str = "text", keep: list[str] | None = None,
                  ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Adds the token ids of each whole text and the text that they decode to.

    A null or empty text has no ids and decodes to the empty text. ``keep`` names
    the input columns to carry (default: all). No shuffle: each row is its own task's work.
    """
    content = _vocabulary(df, vocabulary)

    def make() -> TextFunction:
        own = codec(content.value)

        def run(texts: list[str]) -> list[pa.Array]:
            packed = [own.encode(t) for t in texts]
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            decoded = pa.array([own.decode(np.frombuffer(p, np.int32)) for p in packed], pa.string())
            ids = np.frombuffer(b"".join(packed), np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)), decoded]

        return run

    return map_texts(df, text_col, keep or df.columns, f"`{ids_col}` array<int>, `{decoded_col}` string", make)


def digests(coded: DataFrame, keep: list[str], ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``n_tokens``, and the SHA-256 of the decimal ids joined by spaces and of the decoded text."""
    ids = F.col(ids_col)
    return coded.select(*keep, F.size(ids).cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(ids.cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col(decoded_col).cast("binary"), 256).alias("decoded_sha256"))
