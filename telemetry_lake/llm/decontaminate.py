"""Benchmark decontamination by spaced-seed hashing. DataFrame operations only.

A text is a list of lower-case tokens (runs of letters and digits). Fixed masks pick some
tokens of a short window and ignore the rest, so a seed still hits where an ignored token was
replaced. Seeds of documents and benchmark items are joined; around each hit the document and
the item are laid on each other and tokens are compared. A document overlaps an item if some
``WINDOW`` aligned tokens agree in all but ``REPLACED`` places. The two masks together hit
every such window wherever the replaced places are, so no overlap is missed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.tables import table, text_key

WINDOW = 13
REPLACED = 2
#: Token places that a seed looks at.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
#: The benchmark is sent to every executor only up to this many tokens (about 64 MB with its
#: seeds); beyond it the same joins are shuffled.
BROADCAST_TOKENS = 1_000_000


def tokens(text: str) -> Column:
    """Hashes of the lower-case letter and digit runs of a text; none where it is null."""
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seeds(words: Column, at: Column, size: Column) -> Column:
    """(mask, seed) of every mask that fits in at a place."""
    return F.array(
        *[
            F.struct(
                F.lit(n).alias("mask"),
                F.when(
                    at + mask[-1] < size,
                    F.xxhash64(F.lit(n), *[F.get(words, at + m) for m in mask]),
                ).alias("seed"),
            )
            for n, mask in enumerate(MASKS)
        ]
    )


def _places(df: DataFrame, words: str, at: str) -> DataFrame:
    """A row for each place where a window can start."""
    last = F.size(words) - min(mask[-1] for mask in MASKS) - 1
    return df.where(last >= 0).withColumn(at, F.explode(F.sequence(F.lit(0), last)))


def _seed_rows(df: DataFrame, words: str, at: str) -> DataFrame:
    placed = _places(df, words, at)
    seeds = _seeds(F.col(words), F.col(at), F.size(words))
    return (
        placed.withColumn("hit", F.explode(seeds))
        .select(*placed.columns, F.col("hit.mask").alias("mask"), F.col("hit.seed").alias("seed"))
        .where("seed is not null")
    )


def _laid_here(words: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, item_key, equal): which tokens of an item agree, for each alignment with a hit.

    The items are sent to every executor, so documents stay where they are read.
    """
    seeds = _seed_rows(texts, "item", "q").select("item_key", "q", "mask", "seed").distinct()
    hits = _seed_rows(words, "words", "p").join(F.broadcast(seeds), ["mask", "seed"])
    hits = hits.select("doc_id", "words", "p", "q", "mask", "item_key").join(F.broadcast(texts), "item_key")
    # Of neighbouring hits of a mask on one alignment, the first is enough.
    again = [
        reduce(
            Column.__and__,
            [F.get("words", F.col("p") + (m - 1)) == F.get("item", F.col("q") + (m - 1)) for m in mask],
        )
        for mask in MASKS
    ]
    follows = reduce(
        lambda rest, n: F.when(F.col("mask") == n, again[n]).otherwise(rest), range(len(MASKS)), F.lit(False)
    )
    first = hits.where((F.col("p") == 0) | (F.col("q") == 0) | ~follows)
    shift = F.col("p") - F.col("q")
    equal = F.transform(
        "item", lambda w, k: F.coalesce((F.get(F.col("words"), k + shift) == w).cast("int"), F.lit(0))
    )
    return first.select("doc_id", "item_key", equal.alias("equal"))


def _laid_apart(words: DataFrame, texts: DataFrame) -> DataFrame:
    """The same by shuffled joins: only seeds and, for hits, as many tokens as the item has move."""
    seeds = _seed_rows(texts, "item", "q").select("item_key", F.size("item").alias("length"), "q", "mask", "seed")
    placed = _seed_rows(words, "words", "p").select("doc_id", "text_key", "p", "mask", "seed")
    hits = (
        placed.join(seeds.distinct(), ["mask", "seed"])
        .select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "item_key", "length", (F.col("p") - F.col("q")).alias("shift"))
        .distinct()
    )
    match = words["doc_id"].eqNullSafe(hits["hit_id"]) & (words["text_key"] == hits["hit_key"])
    part = F.transform(
        F.sequence(F.lit(0), F.col("length") - 1), lambda k: F.get(F.col("words"), k + F.col("shift"))
    )
    cut = words.join(hits, match).select("doc_id", "item_key", part.alias("part"))
    equal = F.zip_with("part", "item", lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))
    return cut.join(texts, "item_key").select("doc_id", "item_key", equal.alias("equal"))


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, window_matches, item_matches, item_tokens) per overlapping pair.

    ``docs`` has doc_id and text, ``items`` has item_id and text; other columns are not read.
    ``window_matches``: the most equal tokens in any window of the best alignment;
    ``item_matches``: all equal tokens of that alignment. Null and empty texts, and items
    shorter than a window, overlap nothing. Repeated documents or items give one row;
    null ids are kept as ids of their own.
    """
    items = items.select("item_id", tokens("text").alias("item")).where(F.size("item") >= WINDOW)
    total = items.agg(F.sum(F.size("item")).alias("n")).collect()[0]["n"] or 0
    # Items by their tokens: repeated item texts are searched once.
    keyed = items.withColumn("item_key", F.xxhash64("item"))
    texts = keyed.groupBy("item_key").agg(F.first("item").alias("item"))
    words = docs.select("doc_id", text_key("text").alias("text_key"), tokens("text").alias("words"))
    words = words.where(F.size("words") >= WINDOW)
    small = total <= BROADCAST_TOKENS
    laid = _laid_here(words, texts) if small else _laid_apart(words, texts)
    starts = F.sequence(F.lit(0), F.size("equal") - WINDOW)
    best = F.array_max(
        F.transform(
            starts,
            lambda s: reduce(Column.__add__, [F.get(F.col("equal"), s + k) for k in range(WINDOW)]),
        )
    )
    scored = laid.select(
        "doc_id",
        "item_key",
        best.alias("window_matches"),
        F.aggregate("equal", F.lit(0), lambda a, x: a + x).alias("item_matches"),
        F.size("equal").alias("item_tokens"),
    ).where(F.col("window_matches") >= WINDOW - REPLACED)
    named = keyed.select("item_key", "item_id").distinct()
    best_row = F.max(F.struct("window_matches", "item_matches", "item_tokens")).alias("best")
    # One row per document and item text before item ids are put in.
    return (
        scored.groupBy("doc_id", "item_key")
        .agg(best_row)
        .join(F.broadcast(named) if small else named, "item_key")
        .groupBy("doc_id", "item_id")
        .agg(F.max("best").alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.window_matches").cast("bigint").alias("window_matches"),
            F.col("best.item_matches").cast("bigint").alias("item_matches"),
            F.col("best.item_tokens").cast("bigint").alias("item_tokens"),
        )
    )


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id has no overlap with any item."""
    found = overlaps(docs, items).select(F.col("doc_id").alias("leak")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["leak"]), "left_anti")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _oracle() -> str:
    def leads(name: str, key: str, at: str) -> str:
        masks = " union all ".join(
            f"select {key}, {at}, {n} as mask, "
            + " || ' ' || ".join(f"lead(w, {m}) over (partition by {key} order by {at})" for m in mask)
            + f" as seed from {name}"
            for n, mask in enumerate(MASKS)
        )
        return f"select * from ({masks}) where seed is not null"

    def words(name: str, key: str, at: str) -> str:
        return (
            f"select {key}, unnest(ws) as w, unnest(range(len(ws))) as {at} from (select {key}, "
            "list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') as ws "
            f"from {name}) where len(ws) >= {WINDOW}"
        )

    return f"""with dw as materialized ({words("documents", "doc_id", "p")}),
iw as materialized ({words("benchmark", "item_id", "q")}),
ds as ({leads("dw", "doc_id", "p")}), si as ({leads("iw", "item_id", "q")}),
diag as (select distinct doc_id, item_id, p - q as shift from ds join si using (mask, seed)),
laid as (select d.doc_id, d.item_id, d.shift, i.q, coalesce((x.w = i.w)::int, 0) as eq
         from diag d join iw i using (item_id) left join dw x on x.doc_id = d.doc_id and x.p = i.q + d.shift),
win as (select *, sum(eq) over (partition by doc_id, item_id, shift order by q
          rows between {WINDOW - 1} preceding and current row) as m from laid),
scored as (select doc_id, item_id, shift, max(m) filter (q >= {WINDOW - 1}) as m, sum(eq) as e, count(*) as n
           from win group by all),
ranked as (select *, row_number() over (partition by doc_id, item_id order by m desc, e desc, n desc) as r
           from scored where m >= {WINDOW - REPLACED})
select doc_id, item_id, m::bigint as window_matches, e::bigint as item_matches, n::bigint as item_tokens
from ranked where r = 1"""


ORACLE_SQL = _oracle()
