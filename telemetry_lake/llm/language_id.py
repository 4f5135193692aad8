"""Language identification with error-correcting output codes.

Each language is a codeword of bits. One linear classifier per bit, on counts of byte
n-grams, predicts that bit; a text gets the language whose codeword has the least loss,
each bit's loss weighted by how well its classifier did on training rows it had not seen.
A text whose two best codewords are nearly as good as each other is flagged ambiguous.

Only the classifiers are fitted on a bounded sample: ``PER_LANGUAGE`` training rows of each
language, ``MOST_ROWS`` in all, taken by a hash of id and text. Feature vectors of fixed size,
not texts, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemetry_lake.llm.tables import id_crc, stored, table

BUCKETS = 4096
GRAMS = (1, 2, 3, 4)
PER_LANGUAGE = 600
MOST_ROWS = 6000
UNKNOWN = "und"
#: The best codeword's share of belief under which a text is ambiguous.
CLEAR = 0.55
#: Bytes of a text that are looked at together.
BLOCK = 1 << 20
#: Odd multipliers that spread the n-grams over the buckets.
_MIX = tuple(np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _counts(block: np.ndarray, found: np.ndarray, fresh: int) -> None:
    """Adds the n-grams that end in the last ``fresh`` bytes of a block."""
    codes = block.astype(np.uint64)
    key = np.zeros(len(block), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if n > len(block):
            return
        # An n-gram is its bytes in order, and its length.
        key = codes[n - 1 :] + (key[: len(block) - n + 1] << np.uint64(8))
        if n not in GRAMS:
            continue
        mixed = (key ^ np.uint64(n << 56)) * _MIX[0]
        mixed ^= mixed >> np.uint64(29)
        mixed *= _MIX[1]
        slot = (mixed >> np.uint64(52)).astype(np.int64)
        found += np.bincount(slot[-min(fresh, len(slot)) :], minlength=BUCKETS)


def features(text: str) -> np.ndarray:
    """Square roots of hashed n-gram counts of the lower-cased text, of length one."""
    data = np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8)
    found = np.zeros(BUCKETS, dtype=np.float64)
    for at in range(0, len(data), BLOCK):
        begin = max(0, at - max(GRAMS) + 1)
        block = data[begin : at + BLOCK]
        _counts(block, found, min(len(data), at + BLOCK) - at)
    found = np.sqrt(found)
    return (found / np.linalg.norm(found)).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def code_book(languages: int, seed: int = 7) -> np.ndarray:
    """Codewords of +1 and -1, one row per language; columns split the languages.

    Up to seven languages get every split there is. More get random codes, the best of
    many by the least distance between two codewords.
    """
    if languages == 1:
        return np.ones((1, 1))
    if languages <= 7:
        splits = np.arange(1, 1 << (languages - 1))
        rows = [np.ones(len(splits))] + [1.0 - 2.0 * (splits >> b & 1) for b in range(languages - 1)]
        return np.array(rows)
    dice = np.random.default_rng(seed)
    bits = max(32, 6 * int(np.ceil(np.log2(languages))))
    best, apart = None, -1.0
    for _ in range(50):
        book = dice.choice([-1.0, 1.0], size=(languages, bits))
        distance = (bits - book @ book.T) / 2 + bits * np.eye(languages)
        if distance.min() > apart:
            best, apart = book, distance.min()
    return best


@dataclass
class Model:
    languages: list[str]
    book: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    #: How far each bit is to be trusted.
    trust: np.ndarray

    def beliefs(self, rows: np.ndarray) -> np.ndarray:
        """A share for each language, from the weighted logistic loss of its codeword."""
        margins = rows @ self.weights + self.bias
        loss = np.logaddexp(0.0, -margins[:, None, :] * self.book[None, :, :]) @ self.trust
        low = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return low / low.sum(axis=1, keepdims=True)


def fit(rows: np.ndarray, languages: list[str], steps: int = 150, rate: float = 8.0) -> Model:
    """Logistic regressions for all bits together; every fifth row only weighs the bits."""
    names = sorted(set(languages))
    book = code_book(len(names))
    truth = book[np.searchsorted(names, languages)]
    aside = np.arange(len(rows)) % 5 == 4 if len(rows) >= 50 else np.zeros(len(rows), dtype=bool)
    x, y = rows[~aside].astype(np.float32), truth[~aside].astype(np.float32)
    weights = np.zeros((rows.shape[1], book.shape[1]), dtype=np.float32)
    bias = np.zeros(book.shape[1], dtype=np.float32)
    # Languages count alike, however many rows they have.
    share = {n: languages.count(n) for n in names}
    each = np.array([1.0 / share[n] for n, out in zip(languages, aside, strict=True) if not out])
    each = (each / each.sum())[:, None].astype(np.float32)
    speed = np.zeros_like(weights)
    for _ in range(steps):
        pull = each * y / (1.0 + np.exp(np.clip(y * (x @ weights + bias), -60, 60)))
        speed = 0.9 * speed + x.T @ pull - 1e-5 * weights
        weights += rate * speed
        bias += 0.25 * rate * pull.sum(axis=0)
    seen = (rows[aside] @ weights + bias) * truth[aside] if aside.any() else np.ones((1, book.shape[1]))
    right = np.clip((seen > 0).mean(axis=0), 0.01, 0.995)
    trust = np.maximum(np.log(right / (1 - right)), 0.05)
    return Model(names, book, weights, bias, trust / trust.mean())


def training_sample(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, text, order): training rows of which every language has some more than it needs;
    never a held-out row or one without letters. Rows are drawn by a hash of id and text, at a share that
    follows from the number of rows of their language, so no task gathers a language's rows."""
    usable = docs.where((id_crc("doc_id") % 3 != 1) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    keyed = usable.select("doc_id", "lang", "text", F.xxhash64("doc_id", "text", F.lit(9)).alias("order"))
    # Stored, so that its size is known before the join is planned and the texts need not move.
    rows = stored(keyed.groupBy("lang").agg(F.count("*").alias("rows")), "langid-rows")
    share = F.shiftrightunsigned("order", 11) / float(1 << 53)
    # So many that fewer than PER_LANGUAGE of a larger language are next to impossible.
    drawn = keyed.join(rows, "lang").where(share * F.col("rows") < 1.5 * PER_LANGUAGE + 100)
    return drawn.select("doc_id", "lang", "text", "order")


def train(docs: DataFrame) -> Model | None:
    """The model of the training rows of ``docs``; none if there is no usable row."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py()).astype(np.float16).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("order"), batch.column("lang"), pa.array(rows, pa.binary())], ["order", "lang", "v"]
            )

    sample = stored(training_sample(docs).mapInArrow(vectors, "order bigint, lang string, v binary"), "langid-sample")
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("order", "v"))
    # At most MOST_ROWS rows: fewer of each where there are many languages.
    picked = sample.withColumn("turn", turn).where(F.col("turn") <= PER_LANGUAGE)
    rows = picked.orderBy("turn", "order", "lang", "v").limit(MOST_ROWS).orderBy("lang", "order", "v").collect()
    if not rows:
        return None
    return fit(
        np.array([np.frombuffer(r.v, dtype=np.float16) for r in rows], dtype=np.float32),
        [r.lang for r in rows],
    )


def predictions(texts: list[str | None], model: Model | None) -> tuple[list[str], list[float], list[bool]]:
    """Language, score and ambiguity of each text."""
    names, scores, unclear = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
    known = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
    for part in (known[k : k + 256] for k in range(0, len(known), 256)):
        beliefs = model.beliefs(np.array([features(texts[i]) for i in part]))
        for i, row in zip(part, beliefs, strict=True):
            best = int(row.argmax())
            names[i], scores[i] = model.languages[best], float(row[best])
            unclear[i] = scores[i] < CLEAR
    return names, scores, unclear


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` rows as (doc_id, held_out, lang_pred, score, ambiguous), one per row.

    Null texts, empty ones and those without a letter are ``und`` with score 0, and so is
    everything where there was no row to learn from. A null id counts as not held out.
    Repeated rows get a row each. Only the text is looked at.
    """
    source = docs.select("doc_id", (id_crc("doc_id") % 3 == 1).alias("held_out"), "text")
    id_type = source.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            names, scores, unclear = predictions(batch.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(unclear, pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    return source.mapInArrow(
        of, f"doc_id {id_type}, held_out boolean, lang_pred string, score double, ambiguous boolean"
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are in some language.

    Every row is predicted as in ``identify`` and rejected if the result is ``und``: its text is
    null or has no letter. A low score or ambiguity rejects nothing, as short clean texts have
    them too. Without a model only the letters count. A null ``lang`` is filled with the
    prediction; a given one is left alone.
    """
    model = train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            names, _, _ = predictions(texts, model)
            # Without a model everything is und, which says nothing about a text.
            keep = [has_letter(t) if model is None else n != UNKNOWN for t, n in zip(texts, names, strict=True)]
            langs = [n if lang is None and n != UNKNOWN else lang for lang, n in zip(langs, names, strict=True)]
            at = batch.schema.get_field_index("lang")
            filled = batch.set_column(at, batch.schema.field(at), pa.array(langs, batch.schema.field(at).type))
            yield filled.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(named, docs.schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))
