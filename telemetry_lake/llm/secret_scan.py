"""Secret scans with a trigram inverted index. DataFrame operations only.

The Boolean trigram query of each rule is derived from its expression. Postings
(gram, document) are made for the grams that the queries name, are intersected per document,
and give the candidate rules of each document. Only candidates are verified with the
expression itself. A rule without a mandatory trigram scans every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.tables import fresh_name, table, text_key
from telemetry_lake.llm.trigram_queries import Query, trigram_query


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: The group whose length counts, and its least length.
    group: int = 0
    least: int = 1


def any_case(word: str) -> str:
    """A literal in either case, without folding letters beyond ASCII."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
# A run that the least length would drop is left out by the expression itself where it can be:
# for `access` and `hex` a shorter match never hides a longer one.
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("repo_token", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
BASE_KINDS = ("assign", "access", "hex")
MASK = "[SECRET]"
#: Gram numbers that one posting mask holds.
WIDTH = 62
_HIT = "array<struct<start:bigint,end:bigint,kind:int>>"


def _grams(queries: list[Query]) -> list[str]:
    return sorted({g for q in queries for clause in q for alternative in clause for g in alternative})


def _shifted(number: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", number, bits.cast("int"))


def postings(docs: DataFrame, grams: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index: (gram, doc_id, text_key), for the given lower-case grams."""
    lowered = docs.select(
        F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.lower(text).alias("lowered")
    )
    held = [F.when(F.contains("lowered", F.lit(g)), F.lit(n)) for n, g in enumerate(grams)]
    return lowered.select(F.explode(F.array_compact(F.array(*held))).alias("gram"), "doc_id", "text_key")


def candidates(
    index: DataFrame, queries: dict[int, Query], grams: list[str]
) -> DataFrame:
    """(doc_id, text_key, rules): the rules whose query the postings of a document satisfy."""
    words = range(0, len(grams), WIDTH)
    merged = index.groupBy("doc_id", "text_key").agg(
        *[
            F.bit_or(
                F.when(F.col("gram").between(w, w + WIDTH - 1), _shifted(F.lit(1).cast("bigint"), F.col("gram") - w)).otherwise(0)
            ).alias(f"held_{w}")
            for w in words
        ]
    )
    number = {g: n for n, g in enumerate(grams)}

    def has(alternative: frozenset[str]) -> Column:
        masks = {w: sum(1 << (number[g] - w) for g in alternative if w <= number[g] < w + WIDTH) for w in words}
        tests = [F.col(f"held_{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in masks.items() if m]
        return reduce(Column.__and__, tests)

    def holds(query: Query) -> Column:
        return reduce(Column.__and__, [reduce(Column.__or__, map(has, clause)) for clause in query])

    rules = F.array_compact(F.array(*[F.when(holds(q), F.lit(n)) for n, q in queries.items()]))
    return merged.select("doc_id", "text_key", rules.alias("rules")).where(F.size("rules") > 0)


def running_sum(numbers: Column) -> Column:
    """Sums of the first 1, 2, ... numbers of an array, by doubling steps."""
    steps = F.sequence(F.lit(0), F.length(F.bin(F.size(numbers).cast("bigint"))) - 1)

    def step(sums: Column, k: Column) -> Column:
        back = _shifted(F.lit(1), k)
        return F.transform(
            sums, lambda x, i: x + F.when(i >= back, F.get(sums, i - back)).otherwise(F.lit(0))
        )

    return F.aggregate(steps, numbers, step)


def _with_hits(df: DataFrame, text: str, rule: Rule, number: int, active: Column | None, out: str) -> DataFrame:
    """Adds the spans of one rule as an array; ``active``: rows in which to look."""
    empty = F.expr("cast(array() as array<string>)")
    hits, pieces, ends = (fresh_name(df, f"{n}_{rule.kind}") for n in ("hits", "pieces", "ends"))
    source = F.coalesce(F.col(text), F.lit(""))

    def looked(column: Column) -> Column:
        return column if active is None else F.when(active, column).otherwise(empty)

    df = df.withColumn(hits, looked(F.regexp_extract_all(source, F.lit(rule.pattern), F.lit(0))))
    found = F.size(hits) > 0
    df = df.withColumn(pieces, F.when(found, F.split(source, rule.pattern, -1)).otherwise(empty))
    widths = F.transform(hits, lambda h, i: (F.length(h) + F.length(F.get(F.col(pieces), i))).cast("bigint"))
    df = df.withColumn(ends, widths).withColumn(ends, F.when(found, running_sum(F.col(ends))).otherwise(F.expr("cast(array() as array<bigint>)")))
    tested = hits
    if rule.group:
        tested = fresh_name(df, f"tested_{rule.kind}")
        df = df.withColumn(
            tested,
            F.when(found, F.regexp_extract_all(source, F.lit(rule.pattern), F.lit(rule.group))).otherwise(empty),
        )
    spans = F.transform(
        hits,
        lambda h, i: F.when(
            F.length(F.get(F.col(tested), i)) >= rule.least,
            F.struct(
                (F.get(F.col(ends), i) - F.length(h)).alias("start"),
                F.get(F.col(ends), i).alias("end"),
                F.lit(number).alias("kind"),
            ),
        ),
    )
    df = df.withColumn(out, F.array_compact(spans).cast(_HIT))
    return df.drop(hits, pieces, ends, tested)


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, str]:
    """``docs`` with one more column, whose name is returned too: all spans by start, then rule.

    A span is (start, end, kind): code points, end exclusive, and the number of the rule. Rows
    are kept as they are, repeated ones and null ids included; a null text has no span.
    Spans of a rule don't overlap; those of different rules may.
    """
    queries = {n: q for n, rule in enumerate(rules) if (q := trigram_query(rule.pattern))}
    grams = _grams(list(queries.values()))
    names = [fresh_name(docs, f"spans_{rule.kind}") for rule in rules]
    out, key, wanted = (fresh_name(docs, n) for n in ("spans_all", "text_key", "rules"))
    df = docs
    if queries:
        picked = candidates(postings(docs, grams, doc_id, text), queries, grams).withColumnsRenamed({"rules": wanted})
        keyed = docs.withColumn(key, text_key(text))
        match = keyed[doc_id].eqNullSafe(picked["doc_id"]) & (keyed[key] == picked["text_key"])
        df = keyed.join(picked, match, "left").select(*[keyed[c] for c in docs.columns], picked[wanted])
    for n, (rule, name) in enumerate(zip(rules, names, strict=True)):
        active = F.array_contains(F.col(wanted), n) if n in queries else None
        df = _with_hits(df, text, rule, n, F.coalesce(active, F.lit(False)) if active is not None else None, name)
    df = df.withColumn(out, F.array_sort(F.concat(*names), _by_start))
    return df.select(*docs.columns, out), out


def _by_start(a: Column, b: Column) -> Column:
    order = lambda x, y: F.when(x < y, -1).when(x > y, 1)
    return F.coalesce(order(a["start"], b["start"]), order(a["kind"], b["kind"]), F.lit(0))


def digest_text(spans: Column, rules: tuple[Rule, ...], kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of the spans, joined by commas."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    if kinds is not None:
        listed = [n for n, r in enumerate(rules) if r.kind in kinds]
        spans = F.filter(spans, lambda s: s["kind"].isin(listed))
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.concat_ws(",", parts)


def secret_scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: counts of the base kinds, their digest, and all spans as text."""
    found, spans = scan(docs.select("doc_id", "text"), rules)

    def count(number: int) -> Column:
        return F.size(F.filter(F.col(spans), lambda s: s["kind"] == number)).cast("bigint")

    counts = [
        count(n).alias(f"n_{rule.kind}") for n, rule in enumerate(rules) if rule.kind in BASE_KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(digest_text(F.col(spans), rules, BASE_KINDS), 256).alias("base_sha256"),
        digest_text(F.col(spans), rules).alias("spans"),
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret replaced by a mask; ``n_chars`` follows the new text.

    Overlapping spans get one mask. Texts without secrets stay as they are.
    """
    found, spans = scan(docs, rules)
    reach, source = F.col(spans), F.col("text")
    # Pieces between spans, walking in order of start: (end so far, text so far).
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))

    def walk(acc: Column, span: Column) -> Column:
        apart = span["start"] >= acc["at"]
        gap = F.substring(source, (acc["at"] + 1).cast("int"), (span["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.greatest(acc["at"], span["end"]).alias("at"),
            F.when(apart, F.concat(acc["parts"], F.array(gap, F.lit(MASK)))).otherwise(acc["parts"]).alias("parts"),
        )

    masked = F.aggregate(
        reach,
        state,
        walk,
        lambda acc: F.concat(
            F.array_join(acc["parts"], ""), F.substring(source, (acc["at"] + 1).cast("int"), F.length(source))
        ),
    )
    out = found.withColumn("text", F.when(F.size(reach) > 0, masked).otherwise(source))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(reach) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    parts, unions = [], []
    for n, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""k{n} as (
  select doc_id, {n} as k, '{rule.kind}' as kind, i,
         list_sum(list_transform(pieces[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) as s,
         hits[i] as hit, tested[i] as tested
  from (select doc_id, string_split_regex(t, '{pattern}') as pieces,
               regexp_extract_all(t, '{pattern}') as hits,
               regexp_extract_all(t, '{pattern}', {rule.group}) as tested
        from d where regexp_matches(t, '{pattern}')) x,
       unnest(range(1, len(hits) + 1)) as u(i)
  where length(tested[i]) >= {rule.least})""")
        unions.append(f"select doc_id, k, kind, s::bigint as s, (s + length(hit))::bigint as e from k{n}")
    base = ", ".join(f"'{k}'" for k in BASE_KINDS)
    counts = ",\n       ".join(f"count(*) filter (kind = '{k}')::bigint as n_{k}" for k in BASE_KINDS)
    return f"""with d as (select doc_id, coalesce(text, '') as t from documents),
{", ".join(parts)},
a as ({" union all ".join(unions)})
select d.doc_id, {counts.replace("count(*)", "count(kind)")},
       sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, k) filter (kind in ({base})), '')) as base_sha256,
       coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, k), '') as spans
from d left join a using (doc_id) group by d.doc_id"""


ORACLE_SQL = _oracle()
