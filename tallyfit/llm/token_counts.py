"""Token counts of a byte-level BPE tokenizer, by merging ragged arrays of pre-tokens.

Pre-tokens of a batch are told apart once; their symbols lie end to end in one array. In each
round every sequence finds its lowest-ranked pair and merges all of its occurrences, all
sequences at the same time, until no sequence has a pair with a rank. What is left is counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The pattern that splits a text before the merges.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# A blank after white space, in the notation of Arrow's patterns.
WIDE_BLANK = r"[\t-\r\x{85}\pZ] "
LIMIT = 1024
KNOWN = 500_000  # units whose counts a task keeps at hand
KNOWN_LENGTH = 40
NONE = np.iinfo(np.int64).max


def _letters_of_bytes() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class ByteBpe:
    """The merges and special strings of a byte-level BPE file, as arrays."""

    def __init__(self, content: str):
        spec = json.loads(content)
        before = spec["pre_tokenizer"] or {}
        plain = spec["model"]["type"] == "BPE" and before.get("type") == "ByteLevel"
        if not plain or spec["normalizer"] or before.get("add_prefix_space"):
            raise ValueError("not a plain byte-level BPE file")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special strings that take in their surroundings")
        vocabulary = spec["model"]["vocab"]
        byte_of = _letters_of_bytes()
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in byte_of.items():
            self.byte_ids[byte] = vocabulary[letter]
        self.size = max(vocabulary.values()) + 1
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        self.special_strings = [t["content"] for t in spec["added_tokens"]]
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.split = regex.compile(PATTERN)

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and how many special strings stand between them."""
        if self.special is None or not self.special.search(text):
            return self.split.findall(text), 0
        parts = self.special.split(text)
        return [p for part in parts for p in self.split.findall(part)], len(parts) - 1

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.size + right
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[place] == wanted, self.ranks[place], NONE)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece; an empty one has none."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        counts = sizes.copy()
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        rank = self._ranks_at(symbols, owner, np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            done = lowest == NONE
            counts[owner[starts[done]]] = lengths[done]
            picks = np.flatnonzero((rank == np.repeat(lowest, lengths)) & (rank != NONE))
            if not len(picks):
                break
            # In a run such as "aaa" matches overlap: every second one counts, from the left.
            new_run = np.concatenate([[True], np.diff(picks) != 1])
            first = picks[new_run][np.cumsum(new_run) - 1]
            picks = picks[(picks - first) % 2 == 0]
            symbols[picks] = self.merged[rank[picks]]
            keep = np.repeat(~done, lengths)
            keep[picks + 1] = False
            moved = np.cumsum(keep)[picks] - 1
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            changed = np.zeros(len(symbols), bool)
            changed[moved] = changed[np.maximum(moved - 1, 0)] = True
            near = np.flatnonzero(changed)
            rank[near] = self._ranks_at(symbols, owner, near)
        return counts

    def _ranks_at(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at the given places; none at the end of a sequence."""
        rank = np.full(len(at), NONE)
        inner = np.flatnonzero(at < len(symbols) - 1)
        inner = inner[owner[at[inner]] == owner[at[inner] + 1]]
        rank[inner] = self._rank(symbols[at[inner]], symbols[at[inner] + 1])
        return rank

    def count_texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, special strings included."""
        own = [self.pieces(text) for text in texts]
        return self.count_pieces([found for found, _ in own]) + np.array([n for _, n in own])

    def count_pieces(self, lists: list[list[str]]) -> np.ndarray:
        """Tokens of each list of pre-tokens."""
        pieces = list(chain.from_iterable(lists))
        told = pa.array(pieces, pa.large_string()).dictionary_encode()
        each = self.count([piece.encode() for piece in told.dictionary.to_pylist()])
        before = np.concatenate([[0], np.cumsum(each[told.indices.to_numpy()])])
        return np.diff(before[np.cumsum([0, *map(len, lists)])])


class UnitCounts:
    """Token counts of texts, with the counts of units seen lately at hand.

    Every blank that follows another character than white space starts a unit. Texts in which
    a blank follows white space, or with a special string, are one unit each.
    """

    def __init__(self, content: str):
        self.bpe = ByteBpe(content)
        self.known: dict[str, int] = {}

    def _of(self, units: list[str]) -> np.ndarray:
        counts = np.fromiter(map(self.known.get, units, repeat(-1)), np.int64, len(units))
        new = np.flatnonzero(counts < 0).tolist()
        if new:
            fresh = [units[i] for i in new]
            counts[new] = own = self.bpe.count_pieces(list(map(self.bpe.split.findall, fresh)))
            if len(self.known) + len(fresh) > KNOWN:
                self.known.clear()
            self.known.update((u, n) for u, n in zip(fresh, own.tolist())
                              if len(u) <= KNOWN_LENGTH)
        return counts

    def _odd(self, texts: pa.Array) -> np.ndarray:
        found = pc.match_substring_regex(texts, WIDE_BLANK)
        for special in self.bpe.special_strings:
            found = pc.or_(found, pc.match_substring(texts, special))
        return found.to_numpy(zero_copy_only=False)

    def count(self, texts: pa.Array) -> np.ndarray:
        odd = self._odd(texts)
        total = np.zeros(len(texts), np.int64)
        for row in np.flatnonzero(odd).tolist():
            total[row] = self.bpe.count_texts([texts[row].as_py()])[0]
        plain = texts.filter(pa.array(~odd)).cast(pa.large_string())
        if not len(plain):
            return total
        lists = pc.split_pattern(plain, " ")
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        told = lists.flatten().dictionary_encode()
        units, index = told.dictionary.to_pylist(), told.indices.to_numpy()
        numbers = self._of([" " + unit for unit in units])[index]
        heads = offsets[:-1]  # the first unit of a text has no blank before it
        used, place = np.unique(index[heads], return_inverse=True)
        numbers[heads] = self._of([units[i] for i in used])[place]
        before = np.concatenate([[0], np.cumsum(numbers)])
        total[~odd] = before[offsets[1:]] - before[offsets[:-1]]
        return total


def _token_counts(content: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = UnitCounts(content)
        for batch in batches:
            found = pa.array(counts.count(batch.column("_text")), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("n_bytes"), found],
                names=["_key", "n_bytes", "n_tokens"],
            )

    return count


def count_tokens(
    df: DataFrame, content: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit)`` for every row, with the tokenizer whose JSON
    file has the given content.

    Null and empty texts have 0 bytes and 0 tokens. Texts are read whole, whatever their
    length; special strings inside them count as one token each. Rows that repeat get a row
    each; other columns of ``df`` are not read; an empty table gives an empty result. Nothing
    is shuffled.
    """
    narrow = df.select(
        F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text")
    ).withColumn("n_bytes", F.octet_length("_text").cast("long"))
    kind = dict(narrow.dtypes)["_key"]
    counted = narrow.select("_key", "n_bytes", "_text").mapInArrow(
        _token_counts(content), f"_key {kind}, n_bytes long, n_tokens long"
    )
    return counted.select(
        F.col("_key").alias(key), "n_bytes", "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
