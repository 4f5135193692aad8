"""Personal data by weak supervision.

Candidates are spans that look like an address or a number. Labelers vote on each: strict
forms (regular expressions with checks), gazetteers (top-level domains, card prefixes,
calling codes, reserved networks) and the words before the span. Votes are not labels; their
patterns are counted over the whole corpus, and expectation-maximisation estimates how
reliable each labeler is and how likely each pattern is personal data. Those estimates train
the final span classifier, a logistic regression on the votes and on the span's form.

What the strict forms accept is always reported; the classifier adds the candidates that it
believes in and that clearly more labelers vote for than against, of other forms and of those that
the strict forms refuse (as ``card_other`` and so on, so that base kinds keep their meaning). None
of them overlaps a span of a base kind. Both counts and training data are tables of patterns, whose number is fixed.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.tables import stored, table

KINDS = ("email", "ip", "card", "phone")
#: Besides other forms, the candidates of base kinds that their strict form refuses.
ADDED = ("phone_local", "email_masked", "national_id", "ip_other", "card_other", "phone_other")
ALL_KINDS = KINDS + ADDED
#: Kinds whose strict form has said no already, which counts as a vote against.
REFUSED = ("ip_other", "card_other", "phone_other")
#: How many more labelers must vote for an added span than against it.
LEAD = 2
#: Belief from which the classifier adds a span.
SURE = 0.9
#: Share of candidates that EM takes as personal before it has seen any vote.
PRIOR = 0.5
#: Weight of the starting rates next to what is counted, as a share of it: the same for any size.
HOLD = 0.2
BEFORE = 40

LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried from its start only: what fails there fails further on as well.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){2}\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_PHONE_LOCAL = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
_EMAIL_MASKED = re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9._-]{1,64} ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z]{2,24})+")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGITS = re.compile(r"[^0-9]+")

# Public top-level domains, card prefixes, calling codes, words that announce data.
_DOMAINS = frozenset("com org net edu gov int info biz io co uk de fr es it nl eu us ca au jp cn in br ru ch at be se no dk fi pl pt".split())
_CARDS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|30[0-5]|36|38|6011|65|35")
_CALLING = re.compile(r"\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-69]\d|3[578]\d|42\d|5[09]\d|6[789]\d|8[058]\d|9[679]\d)")
_WORDS = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write|correo|courriel)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|host|server|address|client|login)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|carte|karte|tarjeta)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|telephone|mobile|cell|call|fax|telefon|teléfono|téléphone)\b"),
    "national_id": re.compile(r"(?i)\b(?:ssn|social security|national id|tax id)\b"),
}
_NOT = re.compile(r"(?i)\b(?:version|release|section|isbn|chapter|order|invoice|page|doi|sku|part)\b[ .:#]{0,3}$")
_TOPIC = {"phone_local": "phone", "email_masked": "email", "ip_other": "ip", "card_other": "card", "phone_other": "phone"}
# Forms of the added kinds: what the numbering plans allow, and how such data is written.
_FORMS = {
    "phone_local": re.compile(r"\(?[2-9](?!11)[0-9]{2}\)?[ .-][2-9](?!11)[0-9]{2}[ .-][0-9]{4}"),
    "email_masked": re.compile(r"(?i)[a-z0-9]+(?:[._-][a-z0-9]+)* ?(?:\[at\]|\(at\)) ?[a-z0-9]+(?:-[a-z0-9]+)*(?: ?(?:\[dot\]|\(dot\)|\.) ?[a-z]{2,24})+"),
    "national_id": re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}"),
    "ip_other": re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    "card_other": re.compile(r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}|[0-9]{13,16}"),
    "phone_other": re.compile(r"\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,4}\)?)+"),
}
# Area codes that no person has: kept for expansion, free or paid services.
_SERVICES = re.compile(r"[0-9]9[0-9]|37[0-9]|96[0-9]|8(?:00|22|33|44|55|66|77|88)|900|[01]|[0-9]11")
# Numbers that are known from advertisements and examples, and those of one digit.
_SPECIMENS = re.compile(r"078-05-1120|219-09-9999|123-45-6789|987-65-432[0-9]|([0-9])\1\1-\1\1-\1{4}")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    #: Accepted by the strict form of a base kind.
    base: bool
    #: Votes of the labelers: 1 personal, -1 not, 0 no vote.
    votes: tuple[int, int, int]
    #: Of the form: length, digits, what stands next to it.
    form: tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards; a run before it is read only once."""
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and ord(text[begin - 1]) < 128 and ord(text[begin - 1]) in LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            done = found.end()
            yield begin, done
        at = text.find("@", max(at + 1, done))


def _candidates(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, strict): each kind leftmost and without overlap."""
    for s, e in emails(text):
        yield "email", s, e, True
    if "at]" in text or "at)" in text:
        for m in _EMAIL_MASKED.finditer(text):
            yield "email_masked", m.start(), m.end(), False
    for m in _IP.finditer(text):
        strict = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))
        yield "ip" if strict else "ip_other", m.start(), m.end(), strict
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19:
            strict = luhn(digits)
            yield "card" if strict else "card_other", m.start(), m.end(), strict
    for m in _PHONE.finditer(text):
        strict = 9 <= len(_DIGITS.sub("", m.group())) <= 15
        yield "phone" if strict else "phone_other", m.start(), m.end(), strict
    for m in _PHONE_LOCAL.finditer(text):
        yield "phone_local", m.start(), m.end(), False
    for m in _NATIONAL.finditer(text):
        yield "national_id", m.start(), m.end(), False


def _gazetteer(kind: str, found: str) -> int:
    if kind in ("email", "email_masked"):
        last = re.split(r"[^A-Za-z]+", found)[-1].lower()
        # Every two letters may be a country's.
        return 1 if last in _DOMAINS else (-1 if kind == "email_masked" and len(last) > 2 else 0)
    if kind in ("ip", "ip_other"):
        return -1 if found.startswith(("0.", "127.", "255.")) else int(kind == "ip_other" and found[0] in "123456789")
    if kind in ("card", "card_other"):
        return 1 if _CARDS.match(found) else -1
    if kind in ("phone", "phone_other"):
        return 1 if _CALLING.match(found) else -1
    if kind == "phone_local":
        return -1 if _SERVICES.match(found.lstrip("(")) else 1
    # 772 is the last area that was given out in order; later ones are drawn.
    return -1 if _SPECIMENS.fullmatch(found) else int("001" <= found[:3] <= "772")


def _context(kind: str, before: str) -> int:
    if _NOT.search(before):
        return -1
    words = _WORDS.get(_TOPIC.get(kind, kind))
    return 1 if words and words.search(before) else 0


def spans(text: str) -> list[Span]:
    out = []
    for kind, start, end, strict in _candidates(text):
        found, before = text[start:end], text[max(0, start - BEFORE) : start]
        form = 1 if strict or _FORMS[kind].fullmatch(found) else -1
        after = text[end : end + 1]
        joined = (bool(before) and before[-1].isalnum()) + 2 * after.isalnum()
        digits = sum(c.isdigit() for c in found)
        out.append(
            Span(
                kind, start, end, strict and kind in KINDS,
                (form, _gazetteer(kind, found), _context(kind, before)),
                (min(len(found) // 4, 9), min(digits // 3, 7), int(joined)),
            )
        )
    out.sort(key=lambda s: (s.start, ALL_KINDS.index(s.kind)))
    return _outside_of_base(out)


def _outside_of_base(found: list[Span]) -> list[Span]:
    """Spans in order without the added kinds' that share characters with a span of a base kind: part
    of what is reported already, or glued to it."""
    starts, ends = [], []
    for s in found:
        if not s.base:
            continue
        if ends and s.start <= ends[-1]:
            ends[-1] = max(ends[-1], s.end)
        else:
            starts.append(s.start)
            ends.append(s.end)
    kept = []
    for s in found:
        before = bisect_left(starts, s.end) - 1
        if s.base or before < 0 or ends[before] <= s.start:
            kept.append(s)
    return kept


_SPAN = "array<struct<kind:int,start:bigint,end:bigint,base:boolean,pattern:int>>"
_LEVELS = (len(ALL_KINDS), 2, 3, 3, 3, 10, 8, 4)


def pattern_number(span: Span) -> int:
    """Votes and form as one number."""
    parts = (ALL_KINDS.index(span.kind), int(span.base), *(v + 1 for v in span.votes), *span.form)
    number = 0
    for part, levels in zip(parts, _LEVELS, strict=True):
        number = number * levels + part
    return number


def pattern_parts(numbers: np.ndarray) -> np.ndarray:
    out = []
    for levels in reversed(_LEVELS):
        out.append(numbers % levels)
        numbers = numbers // levels
    return np.stack(out[::-1], axis=1)


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, found): the candidates of every row, by start, then kind."""
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("pattern", pa.int32())]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [(ALL_KINDS.index(s.kind), s.start, s.end, s.base, pattern_number(s)) for s in spans(t.as_py())]
                for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "found"])

    return source.mapInArrow(of, f"doc_id {id_type}, found {_SPAN}")


def estimate(parts: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Belief that the spans of each pattern are personal data, by EM per kind.

    Each labeler has a rate for every vote on personal and on other spans; both start from
    votes that are right more often than not.
    """
    beliefs = np.full(len(parts), PRIOR)
    for kind in np.unique(parts[:, 0]):
        rows = np.flatnonzero(parts[:, 0] == kind)
        votes, n = parts[rows, 2:5], counts[rows] / counts[rows].sum()
        share = PRIOR
        rates = np.tile([[0.1, 0.3, 0.6], [0.6, 0.3, 0.1]], (votes.shape[1], 1, 1))
        for _ in range(rounds):
            yes, no = (np.prod([rates[j, k][votes[:, j]] for j in range(votes.shape[1])], axis=0) for k in (0, 1))
            belief = share * yes / (share * yes + (1 - share) * no)
            share = (n @ belief + HOLD * PRIOR) / (1 + HOLD)
            for j in range(votes.shape[1]):
                for k, weight in ((0, n * belief), (1, n * (1 - belief))):
                    # The starting rates stay as a share, so that no labeler is turned round.
                    start = np.array([0.1, 0.3, 0.6] if k == 0 else [0.6, 0.3, 0.1])
                    seen = np.bincount(votes[:, j], weights=weight, minlength=3)
                    rates[j, k] = (seen + HOLD * start) / (seen.sum() + HOLD)
        beliefs[rows] = belief
    return beliefs


def _features(parts: np.ndarray) -> np.ndarray:
    """One-hot votes and form, within each kind, and the kind itself."""
    width = sum(_LEVELS[2:]) + 1
    out = np.zeros((len(parts), width * _LEVELS[0]), dtype=np.float64)
    rows = np.arange(len(parts))
    base = parts[:, 0] * width
    out[rows, base] = 1
    at = 1
    for column, levels in enumerate(_LEVELS[2:], 2):
        out[rows, base + at + parts[:, column]] = 1
        at += levels
    return out


def train_classifier(parts: np.ndarray, counts: np.ndarray, beliefs: np.ndarray, steps: int = 300) -> np.ndarray:
    """Weights of a logistic regression on the patterns, with beliefs as soft labels."""
    x = _features(parts)
    # Shares of all, so that a repeated corpus gives the same weights to the last bit.
    weight = np.sqrt(counts / counts.sum())[:, None]
    weight = weight / weight.sum()
    w = np.zeros((x.shape[1], 1))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - beliefs[:, None])) + 1e-4 * w
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return w[:, 0]


def accepted_patterns(found: DataFrame) -> tuple[list[int], dict[int, float]]:
    """Patterns that the classifier adds, and its belief in every pattern of the corpus.

    The patterns of a corpus are few, whatever its size: at most the product of ``_LEVELS``.
    """
    rows = found.select(F.explode("found.pattern").alias("p")).groupBy("p").count().orderBy("p").collect()
    if not rows:
        return [], {}
    numbers, counts = np.array([r.p for r in rows]), np.array([r["count"] for r in rows])
    sure, beliefs = judged(numbers, counts)
    return numbers[sure].tolist(), dict(zip(numbers.tolist(), beliefs.tolist(), strict=True))


def judged(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which patterns of the added kinds the classifier adds, and its belief in each pattern.

    Only the shares of the patterns matter, not how large the corpus is.
    """
    parts = pattern_parts(numbers)
    weights = train_classifier(parts, counts, estimate(parts, counts))
    beliefs = 1 / (1 + np.exp(-_features(parts) @ weights))
    # EM can take a labeler that says yes to nearly all of a kind for the truth. So the votes must agree as well.
    refused = np.isin(parts[:, 0], [ALL_KINDS.index(k) for k in REFUSED])
    agreed = (parts[:, 2:5] - 1).sum(axis=1) - refused >= LEAD
    return (beliefs >= SURE) & (parts[:, 0] >= len(KINDS)) & agreed, beliefs


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, their digest, and all spans as text.

    Null and empty texts have no spans. Repeated rows and null ids are kept. Spans of
    different base kinds may overlap. Very long texts are read as a whole; an empty table gives no
    rows, and columns besides doc_id and text play no part, whatever their names.
    """
    found = stored(find_spans(docs), "pii")
    added, _ = accepted_patterns(found)
    names = F.array(*[F.lit(k) for k in ALL_KINDS])
    wanted = F.filter("found", lambda s: s["base"] | s["pattern"].isin(added) if added else s["base"])
    kept = found.select("doc_id", wanted.alias("found"), F.filter("found", lambda s: s["base"]).alias("base"))

    def joined(column: str):
        return F.concat_ws(
            ",",
            F.transform(
                column,
                lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
            ),
        )

    def count(number: int):
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("bigint").alias(f"n_{KINDS[number]}")

    return kept.select(
        "doc_id",
        *[count(n) for n in range(len(KINDS))],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("found").alias("spans"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
