"""Operator 8: secret scans with character Markov models, all in SQL functions.

Fixed patterns give the base spans.  On top of them two first-order character
models -- of random strings and of ordinary identifiers -- score every long
token by its log-likelihood ratio; tokens that are far likelier random become
spans of the kind ``markov``, unless they touch a base span.

Both models are counted from labelled samples in the corpus itself: values that
the patterns matched are random strings, other words are ordinary identifiers.
The counts are at most 128 x 128 character pairs a label, whatever the input;
their log ratios travel as one array literal.

Positions come from matches and the pieces between them (one running sum over
both), in code points.  No Python runs on the executors.

Defined results: null text is empty; a text without spans has counts 0, the digest of
the empty string and empty spans; without labelled samples every ratio is 0 and
nothing is added; repeated rows give equal rows; an empty table gives no rows;
columns other than the key and the text are not read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.llm.common import text_or_empty

# The base kinds in their order, with pattern, value group and least length.
KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
# A match that fails its least length hides nothing but itself in the last two
# kinds, so the length can stand in the pattern there.
_SCAN = {"assign": KINDS[0][1], "access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
WORD = r"[A-Za-z0-9+/_=-]{8,}"
CODES = 128
_SPAN = "array<struct<start: long, kind: int, end: long>>"
#: Matches whose spans are gathered in one growing array; texts with more go block by block.
SPAN_BLOCK = 256


def _spans(text: Column, pattern: str, kind: int, keep, value_group: int = 0) -> Column:
    """Spans of all matches that ``keep(value, match)`` accepts, in order."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else whole
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["gap"])
        end = start + F.coalesce(F.length(p["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(p["whole"].isNotNull() & keep(p["value"], p["whole"]),
                                                F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def spans(some: Column, at: Column) -> Column:
        first = F.struct(at.cast("long").alias("at"), F.array().cast(_SPAN).alias("out"))
        return F.aggregate(some, first, step, lambda acc: acc["out"])

    def length(some: Column) -> Column:
        return F.aggregate(some, F.lit(0).cast("long"),
                           lambda n, p: n + F.length(p["gap"]) + F.coalesce(F.length(p["whole"]), F.lit(0)))

    def by_blocks(all_: Column) -> Column:
        last = F.floor((F.size(all_) - 1) / SPAN_BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_, i * SPAN_BLOCK + 1, F.lit(SPAN_BLOCK)))
        return _bound(blocks, lambda bs: F.flatten(F.zip_with(bs, _starts(F.transform(bs, length)), spans)))

    found = _bound(parts, lambda p: F.when(F.size(p) <= SPAN_BLOCK, spans(p, F.lit(0))).otherwise(by_blocks(p)))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _starts(lengths: Column) -> Column:
    """Where each of consecutive pieces starts."""
    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("out"))
    return F.aggregate(lengths, first, lambda acc, n: F.struct(
        (acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])


def base_spans(text: Column) -> list[Column]:
    """Arrays of spans, one for each of ``KINDS``."""
    return [_spans(text, _SCAN[name], i, lambda v, m, least=least: F.length(v) >= least, group)
            for i, (name, _, group, least) in enumerate(KINDS)]


def _codes(token: Column) -> Column:
    """Character codes (0..127) of an ASCII token."""
    return F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.ascii(c))


def _pairs(token: Column) -> Column:
    codes = _codes(token)
    return F.zip_with(codes, F.slice(codes, 2, F.greatest(F.size(codes), F.lit(1))),
                      lambda a, b: a * CODES + b)


def train_markov(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 random_docs: int = 200_000, ordinary_docs: int = 10_000) -> list[float]:
    """Log-likelihood ratios (random over ordinary) of all character pairs.

    ``random_docs`` / ``ordinary_docs``: about so many documents, chosen by hash of
    their key, give the labelled samples of either model."""
    n = max(1, docs.count())
    slot = F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string")), 32)

    def sample(size: int) -> DataFrame:
        return docs.where(slot < F.lit(int(min(1.0, size / n) * (1 << 32)))).select(text_or_empty(text).alias("t"))

    t = F.col("t")

    def matched(name: str, group: int, least: int) -> Column:
        return F.filter(F.regexp_extract_all(t, F.lit(_SCAN[name]), F.lit(group)), lambda v: F.length(v) >= least)

    values = F.concat(*[matched(name, group, least) for name, _, group, least in KINDS])
    some = t.rlike("|".join(_SCAN[name] for name, *_ in KINDS))
    random = sample(random_docs).where(some).select(F.explode(values).alias("w"), F.lit(1).alias("random"))
    bare = t
    for name, *_ in KINDS:
        bare = F.regexp_replace(bare, _SCAN[name], " ")
    ordinary = (sample(ordinary_docs).select(F.explode(F.array_distinct(F.regexp_extract_all(bare, F.lit(WORD), F.lit(0)))).alias("w"),
                                             F.lit(0).alias("random")))
    counts = (random.unionAll(ordinary).select("random", F.explode(_pairs(F.col("w"))).alias("pair"))
              .where("pair is not null").groupBy("random", "pair").count().collect())
    return log_ratios({(r[0], r[1]): r[2] for r in counts})


def log_ratios(counts: dict[tuple[int, int], int]) -> list[float]:
    """``ln P(b|a, random) - ln P(b|a, ordinary)`` at index ``128 a + b``, each with half a
    count added for each of the 66 token characters; 0 throughout if a label has no pairs."""
    if not all(any(label == r for r, _ in counts) for label in (0, 1)):
        return [0.0] * (CODES * CODES)
    letters = 66
    out = []
    row = {(r, a): sum(counts.get((r, a * CODES + b), 0) for b in range(CODES)) for r in (0, 1) for a in range(CODES)}
    for a in range(CODES):
        for b in range(CODES):
            p, q = ((counts.get((r, a * CODES + b), 0) + 0.5) / (row[r, a] + 0.5 * letters) for r in (1, 0))
            out.append(round(math.log(p / q), 4))
    return out


def llr(token: Column, ratios: list[float]) -> Column:
    """Sum of the token's transition log ratios."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    first = F.struct(F.lit(-1).alias("p"), F.lit(0.0).alias("s"))

    def step(acc: Column, c: Column) -> Column:
        gain = F.when(acc["p"] < 0, F.lit(0.0)).otherwise(F.get(table, acc["p"] * CODES + c))
        return F.struct(c.alias("p"), (acc["s"] + gain).alias("s"))

    return F.aggregate(_codes(token), first, step, lambda acc: acc["s"])


def scan_secrets(docs: DataFrame, ratios: list[float], key: str = "doc_id", text: str = "text",
                 least_ratio: float = 10.0, least_mean: float = 0.7) -> DataFrame:
    """``key, base, added``: arrays of spans ``(start, kind, end)``, sorted; kind is the
    index in ``KINDS``, of added spans the next one.  A token is added if its ratio
    is at least ``least_ratio`` and ``least_mean`` a character."""
    found = docs.select(F.col(key), text_or_empty(text).alias("__t")).select(
        key, "__t", F.array_sort(F.concat(*base_spans(F.col("__t")))).alias("base"))

    def likely(v: Column, m: Column) -> Column:
        ratio = llr(m, ratios)
        return (ratio >= least_ratio) & (ratio >= least_mean * F.length(m))

    added = _spans(F.col("__t"), TOKEN, len(KINDS), likely)
    apart = F.filter(added, lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return found.select(key, "base", apart.alias("added"))


def secret_digests(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    names = F.array(*[F.lit(name) for name, *_ in KINDS], F.lit("markov"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    count = [number(i).alias(f"n_{name}") for i, (name, *_) in enumerate(KINDS)]
    return scanned.select(key, *count, F.sha2(F.encode(joined(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
                          joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
                          F.size("added").cast("long").alias("n_markov"))
