"""Encoding and decoding with a word-end BPE, by a trie of words that shares prefixes."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import batches_of, texts
from .tokens import byte_symbols, exact_split, is_stable, stable_split

#: The pattern whose matches are the words (fixed values), the commonest branch first.
PATTERN = r"{L}+|'s|'t|'re|'ve|'m|'ll|'d|{N}|{O}+"
END = "</w>"

#: Words and pairs of tokens that a worker remembers.
REMEMBERED = 600_000
#: Depths of a trie path at which its state is always worked out.
STRIDE = 32


class Encoder:
    """Words to ids and token strings.

    A word is the string of its byte symbols; its last symbol carries the word end.  Of
    every prefix the merges leave one last token, and a token t may follow the prefix
    before it exactly if the merges of that prefix's last token and t, taken alone, leave
    the two as they are.  So the last tokens of a word's prefixes hold its encoding, and
    words of a trie share those of their common prefixes.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.vocab: dict[str, int] = file["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]]
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(merges)}
        self.table = {b: s for s, b in byte_symbols().items()}
        self.specials = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        self.normalizer = Tokenizer.from_file(path).normalizer
        # Tokens by their symbols from the end: those inside a word, those that end one.
        self.inner: dict = {}
        self.final: dict = {}
        for token in self.vocab:
            ends = token.endswith(END) and token != END
            node = self.final if ends else self.inner
            for symbol in reversed(token[:-len(END)] if ends else token):
                node = node.setdefault(symbol, {})
            node[END] = token
        self.fits: dict[tuple[str, str], bool] = {}
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}

    def merged(self, parts: list[str]) -> list[str]:
        """The merges, one by one, on a few symbols."""
        while len(parts) > 1:
            rank, at = min((self.ranks.get(p, len(self.ranks)), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == len(self.ranks):
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def symbols(self, token: str) -> list[str]:
        if token.endswith(END) and len(token) > len(END):
            return [*token[:-len(END) - 1], token[-len(END) - 1:]]
        return [*token]

    def follows(self, left: str, right: str) -> bool:
        """Whether the merges leave two neighbouring tokens apart and whole; left may be empty."""
        key = left, right
        fit = self.fits.get(key)
        if fit is None:
            if len(self.fits) > REMEMBERED:
                self.fits.clear()
            parts = (self.symbols(left) if left else []) + self.symbols(right)
            fit = self.fits[key] = self.merged(parts) == ([left, right] if left else [right])
        return fit

    def last_token(self, path: list[str], last: list, depth: int, tails: dict) -> str:
        """The last token of the path's first symbols, `depth` of them; last[0] is empty.

        Candidates are the tokens that these symbols end with; exactly one follows the
        prefix before it.  States of prefixes are worked out when first asked for.
        """
        at, node, found = depth, tails, []
        while at and (node := node.get(path[at - 1])):
            at -= 1
            if END in node:
                found.append((at, node[END]))
        for at, token in reversed(found):
            before = last[at]
            if before is None:
                before = last[at] = self.last_token(path, last, at, self.inner)
            if self.follows(before, token):
                return token
        raise ValueError(f"the vocabulary has no token that ends {''.join(path[:depth])[-20:]!r}")

    def learn(self, words) -> None:
        """Encode words by one walk, depth first, over the trie of their symbols."""
        root: dict = {}
        for word in words:
            node = root
            for symbol in word.encode().decode("latin-1").translate(self.table):
                node = node.setdefault(symbol, {})
            node[END] = word
        path: list[str] = []
        last: list[str | None] = [""]
        stack = [(0, "", root)]
        while stack:
            depth, symbol, node = stack.pop()
            if depth:
                del path[depth - 1:], last[depth:]
                path.append(symbol)
                last.append(None)
                if depth % STRIDE == 0:
                    last[depth] = self.last_token(path, last, depth, self.inner)
            word = node.pop(END, None)
            if word is not None:
                self.store(word, path, last)
            stack.extend((depth + 1, step, child) for step, child in node.items())

    def store(self, word: str, path: list[str], last: list) -> None:
        """Keep a word's encoding: its last token, then the states of the prefixes before."""
        tokens = [self.last_token(path, last, len(path), self.final)]
        at = len(path) - (len(tokens[0]) - len(END))
        while at:
            if last[at] is None:
                last[at] = self.last_token(path, last, at, self.inner)
            tokens.append(last[at])
            at -= len(last[at])
        tokens.reverse()
        self.ids[word] = b"".join([self.vocab[t].to_bytes(4, "little") for t in tokens])
        self.decoded[word] = " ".join(tokens)

    def section(self, text: str) -> list[str]:
        """Words of a text without special strings, normalised."""
        if text.isascii():
            return stable_split(PATTERN).findall(text.lower())
        if is_stable(text):
            # NFC and lower case leave this range by no character but those that split alike.
            text = unicodedata.normalize("NFC", text).lower()
        else:
            text = self.normalizer.normalize_str(text)
        return (stable_split if is_stable(text) else exact_split)(PATTERN).findall(text)

    def encode(self, batch: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian 32-bit integers, decoded text) of each text."""
        split = [self.special.split(t) for t in batch]
        found = [[p if i % 2 else self.section(p) for i, p in enumerate(parts)] for parts in split]
        if len(self.ids) > REMEMBERED:
            self.ids.clear()
            self.decoded.clear()
        new: set[str] = set()
        for parts in found:
            for words in parts[::2]:
                new.update(words)
        new -= self.ids.keys()
        if new:
            self.learn(new)
        return [self.joined(parts) for parts in found]

    def joined(self, parts: list) -> tuple[bytes, str]:
        """Sections lie at even places, special strings between them."""
        ids = [self.specials[p].to_bytes(4, "little") if i % 2 else b"".join(map(self.ids.__getitem__, p))
               for i, p in enumerate(parts)]
        decoded = [p if i % 2 else " ".join(map(self.decoded.__getitem__, p)) for i, p in enumerate(parts)]
        return b"".join(ids), " ".join([d for d in decoded if d])


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(path)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of each row's whole text; ids are little-endian 32-bit integers.

    Equals the tokenizer library's encode without added special tokens and without the
    file's truncation and padding, and its decode, which joins tokens by spaces and keeps
    special tokens.  NULL and empty texts have no ids and decode to an empty text; NULL
    and repeated ids and repeated rows pass through; other columns are not read; an empty
    table gives no rows.  One scan, no shuffle; a worker holds a batch of texts, the trie
    of the batch's new words, and bounded caches.
    """
    batches_of(docs.sparkSession)

    def rows(batches):
        own = encoder(path)
        for batch in batches:
            coded = own.encode([t.decode("utf-8", "replace") for t in texts(batch.column("t"))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), pa.array([c[0] for c in coded], pa.binary()), pa.array([c[1] for c in coded], pa.string())],
                ["i", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
            .mapInArrow(rows, f"i {kind}, ids binary, decoded string").withColumnRenamed("i", id_col))
