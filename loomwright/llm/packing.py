"""Filling fixed-capacity containers with texts.

Everything that decides is the histogram of lengths, which has one entry a length up to the capacity
however many texts there are. On it, dynamic programming places the bucket boundaries that pad least,
and token-budget batches are formed inside each bucket; in a second pass what a batch leaves free is
offered to the shorter buckets. The texts then find their batch by their rank among those of their
length, so no text is moved with its words and none is gathered in one place.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loomwright.session import cut

#: Tokens a container takes.
CAPACITY = 2_048
BUCKETS = 8
#: Where the public vocabulary is; any file of ranks in the same format will do.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of one length that are ranked in one part; a length with more has as many parts as that takes.
RANKED = 500_000

_ENCODERS: dict[str, object] = {}


def encoder(path: str = VOCABULARY):
    """The tokenizer of a rank file, loaded once a process."""
    if path not in _ENCODERS:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def sizes(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, n_tokens)`` of every row; a null or empty text has 0 tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_ordinary
        for batch in batches:
            lengths = [len(encode(t.as_py())) if t.is_valid else 0 for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], names=["doc_id", "n_tokens"])

    return documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string")).mapInArrow(count, "doc_id bigint, n_tokens bigint")


def pieces(sized: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start_token, n_tokens)``: a text whole, or in full containers and a rest if it alone exceeds one.

    Texts of 0 tokens need no container and are left out.
    """
    number = F.ceil(F.col("n_tokens") / F.lit(capacity)).cast("bigint")
    return (
        sized.filter("n_tokens > 0")
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), number - 1)))
        .select("doc_id", "piece", (F.col("piece") * capacity).alias("start_token"), F.least(F.col("n_tokens") - F.col("piece") * capacity, F.lit(capacity).cast("bigint")).alias("n_tokens"))
    )


def boundaries(counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets that pad least when every text is padded to its bucket's.

    ``counts[n]`` texts have length n. Dynamic programming over the lengths that occur: the padding of
    lengths i..j to j is known from prefix sums, so each bucket costs one pass of vector minima.
    """
    lengths = np.flatnonzero(counts)
    lengths = lengths[lengths > 0]
    if not len(lengths):
        return []
    n = counts[lengths].astype(float)
    number, total = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * lengths)])
    size = len(lengths)
    best = lengths * number[1:] - total[1:]  # one bucket up to each length
    choice = []
    for _ in range(1, min(buckets, size)):
        after, back = np.full(size, np.inf), np.zeros(size, int)
        for j in range(size):
            # the bucket ends at j and begins after i
            cost = lengths[j] * (number[j + 1] - number[1 : j + 1]) - (total[j + 1] - total[1 : j + 1]) + best[:j]
            if j and cost.min() < best[j]:
                back[j] = int(cost.argmin()) + 1
                after[j] = cost[back[j] - 1]
            else:
                after[j] = best[j]
        choice.append(back)
        best = after
    ends, j = [], size - 1
    for back in reversed(choice):
        ends.append(int(lengths[j]))
        if not back[j]:
            break
        j = back[j] - 1
    else:
        ends.append(int(lengths[j]))
    return sorted(set(ends))


class Bucket:
    """The texts left of one bucket, by length, and the fullest set of them for a free space."""

    def __init__(self, lengths: list[int], left: np.ndarray) -> None:
        self.lengths, self.left = lengths, left  # lengths ascending

    def fill(self, free: int, first: bool) -> dict[int, int]:
        """How many of each length make the fullest set of at most ``free`` tokens; of equal ones the longer texts.

        With ``first`` the longest text left is in it. The sums that the lengths can reach are bits of
        a number; taking the lengths back from the longest, each takes what leaves a sum in reach.
        """
        self.lengths = [n for n in self.lengths if self.left[n]]
        batch: dict[int, int] = {}
        if first and self.lengths:
            longest = self.lengths[-1]
            batch[longest] = 1
            free -= longest
        fitting = self.lengths[: bisect.bisect_right(self.lengths, free)]
        if not fitting:
            return batch
        full, sums, steps = (1 << (free + 1)) - 1, 1, []
        for length in fitting:
            steps.append(sums)
            many, size = min(int(self.left[length]) - batch.get(length, 0), free // length), 1
            while many > 0:
                take = min(size, many)
                sums |= sums << (take * length) & full
                many -= take
                size *= 2
        at = sums.bit_length() - 1
        for length, before in zip(reversed(fitting), reversed(steps)):
            most = min(int(self.left[length]) - batch.get(length, 0), at // length)
            n = next(n for n in range(most, -1, -1) if before >> (at - n * length) & 1)
            if n:
                batch[length] = batch.get(length, 0) + n
                at -= n * length
        return batch


def plan(counts: np.ndarray, capacity: int = CAPACITY, buckets: int = BUCKETS, shared: bool = True) -> tuple[list[int], pd.DataFrame]:
    """Batches over the histogram: ``(length, rank_from, rank_to, each, container, bucket)``.

    Texts of ``length`` ranked from ``rank_from`` to before ``rank_to`` fill the containers from
    ``container`` on, ``each`` to one. The buckets follow each other from the longest. A batch is
    formed inside its bucket: the longest text left there with the fullest set of others of the bucket.
    In a second pass, unless ``shared`` is off, the tokens that stay free are offered to the shorter
    buckets, one after the other, before those form batches of their own. A batch is repeated while
    the histogram holds it, so there are about as many as lengths, not as texts.
    """
    ends = boundaries(counts, buckets)
    left = counts.astype(np.int64).copy()
    left[0] = 0
    used = np.zeros(len(left), np.int64)
    of = [Bucket([n for n in range(low + 1, high + 1) if left[n]], left) for low, high in zip([0, *ends], ends)]
    rows, container = [], 0
    for bucket in range(len(of) - 1, -1, -1):
        while True:
            batch = of[bucket].fill(capacity, True)
            if not batch:
                break
            free = capacity - sum(n * fit for n, fit in batch.items())
            for shorter in range(bucket - 1, -1, -1) if shared else ():
                if not free:
                    break
                more = of[shorter].fill(free, False)
                free -= sum(n * fit for n, fit in more.items())
                batch |= more
            times = min(int(left[length]) // fit for length, fit in batch.items())
            for length, fit in batch.items():
                rows.append((length, int(used[length]), int(used[length]) + times * fit, fit, container, bucket))
                used[length] += times * fit
                left[length] -= times * fit
            container += times
    return ends, pd.DataFrame(rows, columns=["length", "rank_from", "rank_to", "each", "container", "bucket"])


def pack(sized: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS, ranked: int = RANKED) -> DataFrame:
    """``(doc_id, piece, start_token, n_tokens, bucket, container)``: every piece of every text in one container.

    No container holds more than ``capacity`` tokens, and a text is in pieces only if it alone exceeds
    that. Rows of one ``doc_id`` are taken as texts of their own. Equal lengths are told apart by
    doc_id and piece, so a rerun packs alike. A length is ranked in parts of about ``ranked`` texts, so
    one length may have most of them. An empty table gives no rows.
    """
    spark = sized.sparkSession
    cut_ = pieces(cut(sized), capacity)
    lengths = {int(r[0]): max(1, -(-int(r[1]) // ranked)) for r in cut_.groupBy("n_tokens").count().collect()}  # capacity rows at most
    many = {n: k for n, k in lengths.items() if k > 1}
    salts = F.coalesce(F.create_map(*[F.lit(x) for pair in many.items() for x in pair])[F.col("n_tokens").cast("int")], F.lit(1)) if many else F.lit(1)
    items = cut_.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), salts).cast("int"))
    # a row a length and part: lengths plus texts over ``ranked``
    parts = items.groupBy("n_tokens", "salt").agg(F.count("*").alias("n")).toPandas().sort_values(["n_tokens", "salt"])
    counts = np.zeros(capacity + 1, np.int64)
    np.add.at(counts, parts["n_tokens"].to_numpy(np.int64), parts["n"].to_numpy(np.int64))
    parts["offset"] = parts.groupby("n_tokens")["n"].cumsum() - parts["n"]
    offsets = {(int(a), int(b)): int(c) for a, b, c in zip(parts["n_tokens"], parts["salt"], parts["offset"])}
    _, batches = plan(counts, capacity, buckets)
    table: dict[int, tuple] = {}
    for length, of in batches.groupby("length"):
        of = of.sort_values("rank_from")
        table[int(length)] = tuple(of[c].to_numpy(np.int64) for c in ("rank_from", "each", "container", "bucket"))
    shared = spark.sparkContext.broadcast((offsets, table))  # entries by length and salt: bounded by the capacity

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets, table = shared.value
        for batch in batches:
            frame = batch.to_pandas()
            ranks = frame["rank"].to_numpy(np.int64) + np.array([offsets[k] for k in zip(frame["n_tokens"].tolist(), frame["salt"].tolist())], np.int64)
            containers, of = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            for length, rows in frame.groupby("n_tokens").indices.items():
                start, each, first, bucket = table[int(length)]
                at = np.searchsorted(start, ranks[rows], "right") - 1
                containers[rows] = first[at] + (ranks[rows] - start[at]) // each[at]
                of[rows] = bucket[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(frame[c].to_numpy(np.int64)) for c in ("doc_id", "piece", "start_token", "n_tokens")] + [pa.array(of), pa.array(containers)],
                names=["doc_id", "piece", "start_token", "n_tokens", "bucket", "container"],
            )

    rank = F.row_number().over(W.partitionBy("n_tokens", "salt").orderBy("doc_id", "piece")) - 1
    numbered = items.withColumn("rank", rank.cast("bigint")).select("doc_id", "piece", "start_token", "n_tokens", "salt", "rank")
    return numbered.mapInArrow(place, "doc_id bigint, piece bigint, start_token bigint, n_tokens bigint, bucket bigint, container bigint")
