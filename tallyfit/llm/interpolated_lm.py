"""Language-model scores by deleted interpolation: bigram, unigram and uniform estimates, mixed
by how often the context was seen.

Documents are encoded in batches: every token is a number into the batch's own list of hashed
words. A batch asks once for each of its distinct words and bigrams, whatever number of times it
holds them. Buckets of hashes add up the counts of all batches and answer each batch in the
order in which it asked, so tokens themselves are never shuffled by key. The mixture weights
come from a deleted part of the training documents, scored with the counts of the rest: those
documents have batches of their own, and what leaves them is a histogram of estimates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from .texts import remainder, shuffled_place, whole

PARTITIONS = 5
DELETED = 10  # one in so many training documents is deleted from the counts of the fit
BATCH_BYTES = 4 << 20
BUCKET_KEYS = 1_000_000
STEPS = 8  # histogram steps for each factor e
ROUNDS = 200
SEED = 42
END = np.uint64(0)  # the end of a document, which also stands before its first word

_KINDS = "batch long, deleted boolean, keys array<{}>, held binary, starts binary, " \
    "tokens binary, hashes binary, n_tokens long, learnt long"


def _encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers of all texts, where each text begins, and the hash of each number."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
    parent, flat = pc.list_parent_indices(lists), lists.flatten()
    full = pc.not_equal(flat, "")
    parent, told = parent.filter(full).to_numpy(), flat.filter(full).dictionary_encode()
    digest = xxhash.xxh64_intdigest
    words = told.dictionary.to_pylist()
    hashes = np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))
    sizes = np.bincount(parent, minlength=len(texts)) + 1
    starts = np.concatenate([[0], np.cumsum(sizes)])
    tokens = np.full(starts[-1], len(words), np.int32)
    tokens[np.arange(len(parent)) + parent] = told.indices.to_numpy()
    return tokens, starts, np.append(hashes, END)


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    waiting: dict[bool, list[pa.RecordBatch]] = {False: [], True: []}
    size = {False: 0, True: 0}

    def settle(deleted: bool) -> pa.RecordBatch:
        nonlocal number
        rows = pa.Table.from_batches(waiting[deleted]).combine_chunks()
        waiting[deleted], size[deleted] = [], 0
        tokens, starts, hashes = _encode(rows.column("text").combine_chunks())
        number += 1
        held = rows.column("held").to_numpy(zero_copy_only=False).astype(np.int8)
        keys = pa.array([rows.column("key").to_pylist()], pa.list_(rows.schema.field("key").type))
        blobs = [held, starts.astype(np.int64), packed(tokens), hashes]
        learnt = int(np.diff(starts)[held == 0].sum())
        pa.default_memory_pool().release_unused()
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([deleted]), keys,
             *[pa.array([bytes(b)], pa.binary()) for b in blobs],
             pa.array([len(tokens)], pa.int64()), pa.array([learnt], pa.int64())],
            names=["batch", "deleted", "keys", "held", "starts", "tokens", "hashes", "n_tokens",
                   "learnt"],
        )

    for batch in batches:
        for deleted in (False, True):
            part = batch.filter(pc.equal(batch.column("deleted"), deleted))
            length = pc.binary_length(part.column("text")).to_numpy(zero_copy_only=False)
            before = 0
            while before < len(part):
                room = BATCH_BYTES - size[deleted]
                upto = np.cumsum(length[before:], dtype=np.int64)
                count = max(1, int(np.searchsorted(upto, room, "right")))
                count = min(count, len(upto))
                waiting[deleted].append(part.slice(before, count))
                size[deleted] += int(upto[count - 1])
                before += count
                if size[deleted] >= BATCH_BYTES or before < len(part):
                    yield settle(deleted)
    for deleted in (False, True):
        if waiting[deleted]:
            yield settle(deleted)


def packed(tokens: np.ndarray) -> bytes:
    """Token numbers are small and mostly frequent ones, so they are compressed before they are
    written and shuffled."""
    return pa.compress(tokens.tobytes(), codec="zstd", asbytes=True)


def unpacked(content: bytes, count: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(content, 4 * count, codec="zstd", asbytes=True), np.int32)


def small_packed(counts: np.ndarray) -> bytes:
    """Counts of 64 bits, most of which are small; a frequent word of a large table has more than
    32 bits hold."""
    return zstandard.compress(np.ascontiguousarray(counts, np.int64).tobytes())


def small_unpacked(content: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(content), np.int64)


class Batch:
    """One encoded batch with its distinct words and bigrams in the order in which it asks."""

    def __init__(self, row, buckets: int):
        self.held = np.frombuffer(row.held, np.int8).astype(bool)
        self.starts = np.frombuffer(row.starts, np.int64)
        self.tokens = unpacked(row.tokens, row.n_tokens)
        hashes = np.frombuffer(row.hashes, np.uint64)
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.starts[:-1]] = len(hashes) - 1
        pair, self.pair_of = np.unique(
            before.astype(np.int64) * len(hashes) + self.tokens, return_inverse=True
        )
        self.first, self.second = pair // len(hashes), pair % len(hashes)
        self.keys = {1: hashes, 2: _joined(hashes[self.first], hashes[self.second])}
        self.bucket = {n: (k >> np.uint64(11)) % np.uint64(buckets) for n, k in self.keys.items()}
        self.order = {n: np.lexsort([self.keys[n], b]) for n, b in self.bucket.items()}

    def number_of(self, gram: int) -> np.ndarray:
        return self.tokens if gram == 1 else self.pair_of

    def counted(self, gram: int, documents: np.ndarray) -> np.ndarray:
        """How often the given documents hold each word or bigram."""
        inside = np.repeat(documents, np.diff(self.starts))
        numbers = self.number_of(gram)[inside]
        return np.bincount(numbers, minlength=len(self.keys[gram])).astype(np.uint32)

    def answers(self, rows: pd.DataFrame, column: str) -> dict[int, np.ndarray]:
        """The counts that all buckets sent back, in the order of the batch's own numbers."""
        found = {}
        for gram in (1, 2):
            own = rows[rows["gram"] == gram].sort_values("bucket")
            sent = np.concatenate([small_unpacked(c) for c in own[column]])
            found[gram] = np.empty(len(self.keys[gram]), np.int64)
            found[gram][self.order[gram]] = sent
        return found


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of two hashes that tells their order apart."""
    mixed = (first ^ (first >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ second) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(31))


def _requests(buckets: int):
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples(index=False):
                batch = Batch(row, buckets)
                learnt = ~batch.held
                rows = []
                for gram in (1, 2):
                    order = batch.order[gram]
                    counts = batch.counted(gram, learnt)[order]
                    keys, bucket = batch.keys[gram][order], batch.bucket[gram][order]
                    starts = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] + np.uint64(1)))
                    small = counts.astype(np.uint8) if counts.max(initial=0) < 256 else counts
                    rows += [
                        (gram, int(bucket[s]), row.batch, row.deleted, keys[s:e].tobytes(),
                         small[s:e].tobytes())
                        for s, e in zip(starts, np.append(starts[1:], len(bucket)))
                    ]
                yield pd.DataFrame(
                    rows, columns=["gram", "bucket", "batch", "deleted", "keys", "counts"]
                )

    return ask


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """Counts of one bucket over all batches, sent back to each batch; and for words how many
    have a count, with all training documents and without the deleted ones."""
    keys = [np.frombuffer(k, np.uint64) for k in rows["keys"]]
    counts = [np.frombuffer(c, np.uint8 if len(c) == len(k) else np.uint32)
              for c, k in zip(rows["counts"], keys)]
    sizes = np.array([len(k) for k in keys])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    number = np.concatenate(counts).astype(np.float64)
    total = np.bincount(place, number, len(distinct)).astype(np.int64)
    gone = np.repeat(rows["deleted"].to_numpy(bool), sizes)
    kept = total - np.bincount(place[gone], number[gone], len(distinct)).astype(np.int64)
    ends = np.cumsum(sizes)
    answers = rows[["gram", "bucket", "batch", "deleted"]].copy()
    own = [place[e - n:e] for e, n in zip(ends, sizes)]
    answers["total"] = [small_packed(total[p]) for p in own]
    answers["kept"] = [small_packed(kept[p]) if d else b"" for p, d in zip(own, rows["deleted"])]
    answers["n_total"] = [int((total > 0).sum())] + [0] * (len(rows) - 1)
    answers["n_kept"] = [int((kept > 0).sum())] + [0] * (len(rows) - 1)
    return answers


def context_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for a context never seen, then one bucket for each doubling of its count."""
    return np.ceil(np.log2(counts + 1.0)).astype(np.int64)


def _estimates(batch: Batch, counts: dict[int, np.ndarray], tokens: int, words: int):
    """Per distinct bigram its context bucket and the maximum-likelihood estimates of its
    second word from the context and without it; the uniform one is the same for all."""
    context = counts[1][batch.first]
    by_pair = counts[2] / np.maximum(1, context)
    by_word = counts[1][batch.second] / max(1, tokens)
    return context_bucket(context), by_pair, by_word, 1 / (words + 1)


def _histogram(buckets: int, tokens: int, words: int):
    def gather(asked: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        batch = Batch(next(asked.itertuples(index=False)), buckets)
        counts = batch.answers(answers, "kept")
        bucket, by_pair, by_word, _ = _estimates(batch, counts, tokens, words)
        held = np.bincount(batch.pair_of, minlength=len(bucket))
        steps = [np.where(p > 0, np.rint(np.log(np.where(p > 0, p, 1)) * STEPS), 1)
                 for p in (by_pair, by_word)]
        cells = pd.DataFrame({"context": bucket, "pair": steps[0].astype(np.int64),
                              "word": steps[1].astype(np.int64), "n": held})
        return cells.groupby(["context", "pair", "word"], as_index=False)["n"].sum()

    return gather


def learn_weights(cells: np.ndarray, uniform: float) -> np.ndarray:
    """Mixture weights ``[bucket] -> (bigram, unigram, uniform)`` by expectation-maximisation
    over rows ``(bucket, step of bigram, step of unigram, tokens)``; a positive step stands for
    an estimate of zero. One token of each kind is added to every bucket, so no weight is zero
    but that of the bigram where the context was never seen. A bucket without tokens takes the
    weights of the nearest one."""
    last = 64
    weights = np.tile([0.0, 0.0, 1.0], (last + 1, 1))
    if not len(cells):
        return weights
    present = np.unique(cells[:, 0])
    for bucket in present:
        own = cells[cells[:, 0] == bucket]
        steps, number = own[:, 1:3], own[:, 3].astype(float)
        parts = np.where(steps > 0, 0.0, np.exp(np.minimum(steps, 0) / STEPS))
        parts = np.hstack([parts, np.full((len(own), 1), uniform)])
        mix = np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            shares = mix * parts
            shares /= shares.sum(1, keepdims=True)
            new = (shares * number[:, None]).sum(0) + 1
            mix = new / new.sum()
        weights[int(bucket)] = mix
    for bucket in range(last + 1):
        if bucket not in present:
            weights[bucket] = weights[int(present[np.abs(present - bucket).argmin()])]
    weights[0, 0] = 0
    weights[0] /= weights[0].sum()
    return weights


def _score(buckets: int, tokens: int, words: int, weights: np.ndarray):
    def score(asked: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = next(asked.itertuples(index=False))
        batch = Batch(row, buckets)
        counts = batch.answers(answers, "total")
        bucket, by_pair, by_word, uniform = _estimates(batch, counts, tokens, words)
        mix = weights[bucket]
        chance = mix[:, 0] * by_pair + mix[:, 1] * by_word + mix[:, 2] * uniform
        base = np.log10((counts[1] + 0.5) / (tokens + 0.5 * (words + 1)))
        starts = batch.starts[:-1]
        known = (counts[1] > 0).astype(np.int64)[batch.tokens]
        return pd.DataFrame({
            "key": list(row.keys), "held_out": batch.held,
            "n_tokens": np.diff(batch.starts), "n_known": np.add.reduceat(known, starts),
            "base_score": np.add.reduceat(base[batch.tokens], starts),
            "score": np.add.reduceat(np.log10(chance)[batch.pair_of], starts),
        })

    return score


def score_documents(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    Documents whose key has CRC-32 remainder 1 are scored but teach nothing. A null or empty
    text is the end token alone. Rows that repeat are counted and scored each; a null key
    counts as an empty one. Other columns are not read; an empty table gives an empty result,
    and without training documents every token has the uniform estimate.

    Counts cover all training documents. Words and bigrams are told apart by 64-bit hashes.

    A task holds one batch of about ``BATCH_BYTES`` of text, or one longer text, and its answers;
    or what all batches ask of one bucket, ``BUCKET_KEYS`` keys at most. Counts have 64 bits.
    """
    part = remainder("key", PARTITIONS)
    rows = df.select(F.col(key).alias("key"), whole(text).alias("text")).select(
        "key", "text", (part == 1).alias("held"),
        ((part != 1) & (F.pmod(shuffled_place(SEED, "key"), F.lit(DELETED)) == 0)).alias(
            "deleted"),
    )
    kind = dict(rows.dtypes)["key"]
    encoded = write_once(
        rows.mapInArrow(_encoded, _KINDS.format(kind)), "encoded", compression="none")
    size = encoded.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = max(4, -(-size // BUCKET_KEYS))
    asked = encoded.drop("keys", "learnt").mapInPandas(
        _requests(buckets),
        "gram int, bucket int, batch long, deleted boolean, keys binary, counts binary",
    )
    answers = write_once(
        asked.groupBy("gram", "bucket").applyInPandas(
            _answer,
            "gram int, bucket int, batch long, deleted boolean, total binary, kept binary, "
            "n_total long, n_kept long",
        ),
        "answers",
    )
    words = answers.where("gram = 1").agg(F.sum("n_total"), F.sum("n_kept")).first()
    all_words, kept_words = int(words[0] or 0), int(words[1] or 0)
    seen = encoded.groupBy("deleted").agg(F.sum("learnt")).collect()
    learnt = {r[0]: int(r[1] or 0) for r in seen}
    all_tokens, kept_tokens = sum(learnt.values()), learnt.get(False, 0)
    gone = encoded.where("deleted").drop("keys", "learnt")
    cells = _cogrouped(gone, answers.where("deleted"), "kept").applyInPandas(
        _histogram(buckets, kept_tokens, kept_words),
        "context long, pair long, word long, n long",
    )
    # At most one row for each cell of the histogram, which does not grow with the documents.
    total = cells.groupBy("context", "pair", "word").agg(F.sum("n")).collect()
    weights = learn_weights(np.array(total, np.int64).reshape(-1, 4), 1 / (kept_words + 1))
    scored = _cogrouped(encoded.drop("learnt"), answers, "total").applyInPandas(
        _score(buckets, all_tokens, all_words, weights),
        f"key {kind}, held_out boolean, n_tokens long, n_known long, base_score double, "
        "score double",
    )
    return scored.select(
        F.col("key").alias(key), "held_out", "n_tokens", "n_known",
        F.lit(all_tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def _cogrouped(encoded: DataFrame, answers: DataFrame, column: str):
    sent = answers.select("batch", "gram", "bucket", column)
    return encoded.groupBy("batch").cogroup(sent.groupBy("batch"))
