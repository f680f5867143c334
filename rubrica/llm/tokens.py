"""Token counts of a byte-level BPE, by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from .common import batches_of, texts

#: The pattern that byte-level BPE splits text by before its merges (fixed values).  No two
#: of its branches begin alike but for spaces, so the commonest comes first.
PATTERN = r" ?{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?{N}+| ?{O}+|{S}+(?!{T})|{S}+"

#: All characters up to here are in every Unicode version that the libraries know.
STABLE = "ͷ"

#: Pre-tokens that a worker remembers.
REMEMBERED = 1_000_000


@lru_cache
def letters() -> str:
    """The class of letters as the tokenizer library has it.

    `regex` may know letters of a later Unicode version.  Only characters that this
    Python does not know can differ, and the library's own splitter says which.
    """
    known, split = regex.compile(r"\p{L}"), ByteLevel(add_prefix_space=False, use_regex=True)
    new = [c for c in range(0x378, 0x110000)
           if unicodedata.category(chr(c)) == "Cn" and known.match(chr(c))
           and len(split.pre_tokenize_str("x" + chr(c))) > 1]
    ranges, start = [], None
    for c, after in zip(new, [*new[1:], None]):
        start = c if start is None else start
        if after != c + 1:
            ranges.append(rf"\U{start:08x}-\U{c:08x}")
            start = None
    return rf"(?:(?![{''.join(ranges)}])\p{{L}})" if ranges else r"\p{L}"


@lru_cache
def stable_split(pattern: str) -> re.Pattern:
    """The pattern for texts without characters beyond STABLE, with its classes spelled out."""
    chars = [chr(c) for c in range(ord(STABLE) + 1)]
    kinds = {k: "".join(map(re.escape, (c for c in chars if unicodedata.category(c)[0] == k))) for k in "LN"}
    space = "\\t-\\r\x20\x85\xa0"
    return re.compile(pattern.format(
        L=f"[{kinds['L']}]", N=f"[{kinds['N']}]", O=f"[^{space}{kinds['L']}{kinds['N']}]",
        S=f"[{space}]", T=f"[^{space}]"))


@lru_cache
def exact_split(pattern: str) -> regex.Pattern:
    """The pattern for all texts."""
    return regex.compile(pattern.format(
        L=letters(), N=r"\p{N}", O=rf"(?:(?!{letters()})[^\s\p{{N}}])", S=r"\s", T=r"\S"))


def is_stable(text: str) -> bool:
    return text.isascii() or max(text) <= STABLE


@lru_cache
def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Ranks of a vocabulary's merges, as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab = file["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]]
        left, right, made = (np.array([vocab[t] for t in side], np.int64)
                             for side in zip(*[(a, b, a + b) for a, b in pairs]))
        self.width = max(vocab.values()) + 1
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, made[order]
        self.first = np.zeros(256, np.int64)
        for symbol, byte in byte_symbols().items():
            self.first[byte] = vocab[symbol]
        specials = [t["content"] for t in file["added_tokens"]]
        self.specials = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True))))


def surviving(merges: Merges, words: list[bytes]) -> np.ndarray:
    """How many symbols each pre-token keeps when all merges are done.

    All pre-tokens lie in one array, `owner` says which one a symbol is of.  Each round
    looks up the ranks of all neighbours, and applies in every pre-token at once the pair
    of lowest rank, at all its places from the left.  Pre-tokens without a pair leave.
    """
    counts = np.array([len(w) for w in words], np.int64)
    symbols = merges.first[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), counts)
    none = len(merges.keys)
    while len(symbols) > 1:
        key = symbols[:-1] * merges.width + symbols[1:]
        at = np.minimum(np.searchsorted(merges.keys, key), none - 1)
        found = (merges.keys[at] == key) & (owner[:-1] == owner[1:])
        rank = np.where(found, merges.ranks[at], none)
        rank = np.append(rank, none)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        lowest = np.minimum.reduceat(rank, starts)
        live = np.repeat(lowest, np.diff(np.append(starts, len(owner))))
        chosen = (rank == live) & (live < none)
        # Of overlapping places, as in "aaa", every second one from the left.
        runs = np.flatnonzero(chosen)
        if len(runs) == 0:
            break
        head = np.append(True, np.diff(runs) > 1)
        place = np.arange(len(runs)) - np.maximum.accumulate(np.where(head, np.arange(len(runs)), 0))
        merged = runs[place % 2 == 0]
        symbols[merged] = merges.made[at[merged]]
        np.subtract.at(counts, owner[merged], 1)
        stay = live < none
        stay[merged + 1] = False
        symbols, owner = symbols[stay], owner[stay]
    return counts


class Counter:
    """Counts tokens of texts, with the counts of pre-tokens that it has met."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.seen: dict[str, int] = {}

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens and the number of special strings, which are tokens of their own."""
        split = (stable_split if is_stable(text) else exact_split)(PATTERN)
        parts = self.merges.specials.split(text)
        if len(parts) == 1:
            return split.findall(text), 0
        return [p for part in parts for p in split.findall(part)], len(parts) - 1

    def count(self, batch: list[str]) -> list[int]:
        found = [self.pieces(t) for t in batch]
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        new: set[str] = set()
        for pieces, _ in found:
            new.update(pieces)
        new = [*(new - self.seen.keys())]
        if new:
            self.seen.update(zip(new, surviving(self.merges, [p.encode() for p in new]).tolist()))
        return [sum(map(self.seen.__getitem__, pieces)) + special for pieces, special in found]


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    """One counter for all tasks of a worker."""
    return Counter(path)


def token_counts(
    docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row's whole text, under a byte-level BPE file.

    Special strings inside a text count as one token each, as the tokenizer library has it.
    NULL and empty texts have no bytes and no tokens; NULL and repeated ids, repeated rows
    and an empty table pass through row by row; other columns are not read.  The file is
    read by each worker from `path`.  One scan, no shuffle; a worker holds a batch of
    texts and a bounded cache of pre-token counts.
    """
    batches_of(docs.sparkSession)

    def rows(batches):
        own = counter(path)
        for batch in batches:
            raw = texts(batch.column("t"))
            n = own.count([t.decode("utf-8", "replace") for t in raw])
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), pa.array([len(t) for t in raw], pa.int64()), pa.array(n, pa.int64())],
                ["i", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    counted = (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
               .mapInArrow(rows, f"i {kind}, n_bytes long, n_tokens long"))
    return counted.select(F.col("i").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
