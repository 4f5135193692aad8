"""Scores of texts by a log-bilinear language model trained with noise-contrastive estimation.

Counts of all words cover every training document and stay a distributed table. The most
frequent words are units of their own; all others fall into classes by their last two
characters, so that the number of units is fixed. The model predicts the next unit from the
two before it: a linear map of their vectors is multiplied with every unit's vector. It is
trained in numpy on the counts of all unit triples of the corpus (a table of at most
UNITS ** 3 rows), by noise-contrastive estimation with the expected noise. Scoring multiplies
all contexts with all units in one batched product and normalises each row, which gives the
log-probabilities of all triples as a table. A word of a class has the probability of the
class times its smoothed share of the class.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.simhash_dedup import word_blocks
from telemetry_lake.llm.tables import id_crc, stored, table, text_bytes

WORDS, CLASSES = 95, 32
#: Words, classes, and the end of a text.
UNITS = WORDS + CLASSES + 1
END = UNITS - 1
VECTOR = 24
NOISE = 16
STEPS = 150
#: Words with a share of at least 1 / KNOWN of all tokens are known in every task; there are
#: never more than KNOWN of them. The counts of the others are joined.
KNOWN = 1_000_000
#: Different words that a task holds before it passes their counts on.
HELD = 400_000


def words_of(data: bytes) -> Iterator[list[bytes]]:
    yield from word_blocks(data.lower())


def word_class(word: bytes) -> int:
    return zlib.crc32(word.decode()[-2:].encode()) % CLASSES


def _training(docs: DataFrame) -> DataFrame:
    return docs.where(id_crc("doc_id") % 7 != 2)


def _tables(batches: Iterator[pa.RecordBatch], counts_of, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Counts of keys over a task, passed on whenever many are held."""
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), kind), pa.array(list(held.values()), pa.int64())], ["key", "n"]
        )

    for batch in batches:
        for text in batch.column("data"):
            for keys in counts_of(text.as_py()):
                held.update(keys)
                if len(held) > HELD:
                    yield out()
                    held.clear()
    if held:
        yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over the training documents of ``docs``; the end of a text is the empty word."""

    def keys(data: bytes) -> Iterator[list[bytes]]:
        yield from words_of(data)
        yield [b""]

    return (
        _training(docs)
        .select(text_bytes("text").alias("data"))
        .mapInArrow(lambda batches: _tables(batches, keys, pa.binary()), "key binary, n bigint")
        .groupBy(F.col("key").cast("string").alias("word"))
        .agg(F.sum("n").alias("c"))
    )


@dataclass
class Model:
    #: Tokens and different tokens in training.
    tokens: int
    distinct: int
    units: dict[bytes, int]
    #: log10 of the number by which counts in a class are divided.
    shares: np.ndarray
    left: np.ndarray
    right: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def log_probabilities(self) -> np.ndarray:
        """log10 of each unit's probability after each pair of units: [before last, last, next]."""
        context = self.left[:, None, :] + self.right[None, :, :]
        scores = context.reshape(-1, context.shape[-1]) @ self.out.T + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
        return (scores / math.log(10)).reshape(UNITS, UNITS, UNITS)

    def unit(self, word: bytes) -> int:
        known = self.units.get(word)
        return WORDS + word_class(word) if known is None else known


class UnitMap(dict):
    """Units of words; those of words not seen before are worked out, up to a number of them."""

    def __init__(self, units: dict[bytes, int]) -> None:
        super().__init__(units)
        self.first = units

    def __missing__(self, word: bytes) -> int:
        unit = WORDS + word_class(word)
        if len(self) > HELD:
            self.clear()
            self.update(self.first)
        self[word] = unit
        return unit


def triples(docs: DataFrame, units: dict[bytes, int]) -> DataFrame:
    """(key, n): how often each three units follow each other in training documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit_of = UnitMap(units)

        def keys(data: bytes) -> Iterator[dict[int, int]]:
            tail = np.array([END, END], dtype=np.int64)
            for last, words in _with_last(words_of(data)):
                more = np.fromiter(map(unit_of.__getitem__, words), np.int64, len(words))
                run = np.concatenate([tail, more, [END]] if last else [tail, more])
                codes, n = np.unique((run[:-2] * UNITS + run[1:-1]) * UNITS + run[2:], return_counts=True)
                yield dict(zip(codes.tolist(), n.tolist(), strict=True))
                tail = run[-2:]

        yield from _tables(batches, keys, pa.int64())

    return (
        _training(docs)
        .select(text_bytes("text").alias("data"))
        .mapInArrow(rows, "key bigint, n bigint")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
    )


def _with_last(lists: Iterator[list[bytes]]) -> Iterator[tuple[bool, list[bytes]]]:
    """Marks the last list; a text without words has one that is empty."""
    held: list[bytes] = []
    for words in lists:
        if held:
            yield False, held
        held = words
    yield True, held


def train_vectors(counts: np.ndarray, steps: int = STEPS, seed: int = 3) -> tuple[np.ndarray, ...]:
    """(left, right, out, bias) from the counts of triples, [before last * UNITS + last, next].

    Every (context, unit) pair weighs as data by its count and as noise by NOISE times the
    unit's share times the count of its context, which is what sampled noise would come to.
    """
    dice = np.random.default_rng(seed)
    total = counts.sum()
    noise = (counts.sum(axis=0) + 1.0) / (total + UNITS)
    contexts = np.flatnonzero(counts.sum(axis=1))
    data = (counts[contexts] / max(total, 1)).astype(np.float32)
    drawn = (data.sum(axis=1, keepdims=True) * (NOISE * noise)[None, :]).astype(np.float32)
    shift = np.log(NOISE * noise).astype(np.float32)
    one, two = contexts // UNITS, contexts % UNITS
    params = [
        dice.normal(0, 0.1, (UNITS, VECTOR)).astype(np.float32),
        dice.normal(0, 0.1, (UNITS, VECTOR)).astype(np.float32),
        dice.normal(0, 0.1, (UNITS, VECTOR)).astype(np.float32),
        np.log(noise).astype(np.float32),
    ]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        left, right, out, bias = params
        hidden = left[one] + right[two]
        belief = 1.0 / (1.0 + np.exp(-np.clip(hidden @ out.T + bias - shift, -30, 30)))
        pull = data - (data + drawn) * belief
        back = pull @ out
        grads = [np.zeros_like(left), np.zeros_like(right), pull.T @ hidden, pull.sum(axis=0)]
        np.add.at(grads[0], one, back)
        np.add.at(grads[1], two, back)
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return tuple(params)


def train(docs: DataFrame, counts: DataFrame) -> Model:
    totals = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()[0]
    top = counts.where("word <> ''").orderBy(F.desc("c"), "word").limit(WORDS).collect()
    units = {row.word.encode(): i for i, row in enumerate(top)} | {b"": END}
    number = (F.crc32(F.substring("word", -2, 2).cast("binary")) % CLASSES).alias("k")
    others = counts.where((F.col("word") != "") & ~F.col("word").isin([row.word for row in top]))
    shares = np.zeros(CLASSES)
    for row in others.groupBy(number).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        shares[row.k] = math.log10(row.n + row.v + 1)
    table_of = np.zeros((UNITS * UNITS, UNITS))
    rows = triples(docs, units).toArrow()
    key = rows.column("key").to_numpy()
    table_of[key // UNITS, key % UNITS] = rows.column("n").to_numpy()
    return Model(totals.n or 0, totals.v, units, shares, *train_vectors(table_of))


def _scored(batches: Iterator[pa.RecordBatch], model: Model, known: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Sums over the words known here, and the other words with how often they occur."""
    logs = model.log_probabilities()
    unit_of = UnitMap(model.units)
    shares = np.concatenate([np.zeros(WORDS), model.shares, [0.0]])
    log_count = {word: math.log10(c + 1) for word, c in known.items()}
    end_log = log_count.get(b"", 0.0)
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("n_tokens", "known_here", "log_counts", "class_logs", "unit_logs", "rare", "times")}
        for text in batch.column("data"):
            tokens, found, base, in_class, by_unit = 0, 0, 0.0, 0.0, 0.0
            rare: Counter = Counter()
            tail = np.array([END, END], dtype=np.int64)
            for last, words in _with_last(words_of(text.as_py())):
                tokens += len(words) + last
                values = [log_count.get(w) for w in words]
                seen = [v for v in values if v is not None]
                found += len(seen)
                base += math.fsum(seen)
                if len(seen) < len(words):
                    rare.update(w for w, v in zip(words, values, strict=True) if v is None)
                units = np.fromiter(map(unit_of.__getitem__, words), np.int64, len(words))
                # A word of a class: its own count over that of the class.
                classed = (units >= WORDS) & (units < END)
                in_class -= float(shares[units[classed]].sum())
                own = [v for v, k in zip(values, classed.tolist(), strict=True) if k and v is not None]
                in_class += math.fsum(own)
                run = np.concatenate([tail, units, [END]] if last else [tail, units])
                by_unit += float(logs[run[:-2], run[1:-1], run[2:]].sum(dtype=np.float64))
                tail = run[-2:]
            out["n_tokens"].append(tokens)
            out["known_here"].append(found + (b"" in log_count))
            out["log_counts"].append(base + end_log)
            out["class_logs"].append(in_class)
            out["unit_logs"].append(by_unit)
            out["rare"].append(list(rare))
            out["times"].append(list(rare.values()))
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *(pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True))],
            [*batch.schema.names[:-1], *out],
        )


def score(docs: DataFrame) -> DataFrame:
    """One row per document: token counts, the unigram score and the model's, both in log10.

    A null text is an empty one: its only token is the end. A null id counts as training.
    Repeated rows are scored one by one, and each is learned from. Without any training
    document all counts are 0 and the model is what it starts from. A long text is read block by
    block, with the same result. Other columns, whatever their names, are left out.
    """
    spark = docs.sparkSession
    counts = stored(word_counts(docs), "word-counts")
    model = train(docs, counts)
    # Units are known too, so that every joined word belongs to a class.
    units = [word.decode() for word in model.units]
    often = counts.where((F.col("c") * KNOWN >= model.tokens) | F.col("word").isin(units))
    known = {row.word.encode(): row.c for row in often.toLocalIterator()}
    shared = spark.sparkContext.broadcast((model, known))
    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        (id_crc("doc_id") % 7 == 2).alias("held_out"),
        text_bytes("text").alias("data"),
    )
    id_type = source.schema["doc_id"].dataType.simpleString()
    # Stored, so that row numbers are the same for both sides of the join below.
    here = stored(
        source.mapInArrow(
            lambda batches: _scored(batches, *shared.value),
            f"row bigint, doc_id {id_type}, held_out boolean, n_tokens bigint, known_here bigint, log_counts double,"
            " class_logs double, unit_logs double, rare array<binary>, times array<bigint>",
        ),
        "scores",
    )
    rare = here.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").cast("string").alias("word"), F.col("x.times").alias("times")
    )
    # Sums of logs are kept in whole parts of 2 ** -32, so that their order does not matter.
    joined = rare.join(counts, "word")
    log_c = F.round(F.log10(F.col("c") + 1) * (1 << 32)).cast("bigint")
    by_row = joined.groupBy("row").agg(
        (F.sum(F.col("times") * log_c) / (1 << 32)).alias("rare_logs"), F.sum("times").alias("rare_known")
    )
    both = here.drop("rare", "times").join(by_row, "row", "left")
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    divisor = math.log10(model.tokens + model.distinct + 1)
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known_here") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") + rare_logs - F.col("n_tokens") * F.lit(divisor)).alias("base_score"),
        (F.col("unit_logs") + F.col("class_logs") + rare_logs).alias("score"),
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
