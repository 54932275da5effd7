"""Operator 9: secret scans over a trigram inverted index, with DataFrame functions only.

From each rule's regex the trigrams that any match must hold are derived, as alternatives of sets. The index has one
posting for each of those trigrams and each distinct text (by hash) that holds it; intersecting postings gives the
texts that may match, and only those are verified with the regex. A rule without mandatory trigrams scans every text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from re import _constants as op
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage, unused


@dataclass(frozen=True)
class Rule:
    """``kind`` names the spans; a match counts if ``group`` has ``least`` characters; ``base`` rules are the fixed ones."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


GAP, BASE64 = r"(?:[ \t\r\n]|\\[nr])", "[A-Za-z0-9+/=]"
LINE_END = r"(?=[ \t]*+(?![^\r\n]))"
#: What follows the first line of a private key: all up to its last line, before which no five dashes stand; where that
#: is missing, the key's headers and its base64, of which the last line may be short.
KEY_BODY = (
    r"(?:[^-]*+(?:-{1,4}+[^-]++)*+-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{GAP}++(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+(?:{GAP}++{BASE64}{{24,}}+)++(?:{GAP}++(?:{BASE64}++{LINE_END}|[A-Za-z0-9+/]++={{1,2}}))?)?"
)

#: The base kinds in their order, then the kinds that this scan adds.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----" + KEY_BODY),
)
SMALL_CLASS = 8
#: Trigrams of one alternative that are looked up; fewer leave a wider, never a smaller, set of candidates.
MOST_PER_WAY = 2
MASK_BITS = 62


def _runs(parsed: Iterable, states: set[tuple[tuple[str, ...], str]]) -> set[tuple[tuple[str, ...], str]]:
    """Literal runs of every way through a parsed regex: ended runs and the one that goes on."""
    broken = lambda found: {((*done, run), "") for done, run in found}
    for kind, value in parsed:
        if kind is op.LITERAL:
            states = {(done, run + chr(value)) for done, run in states}
        elif kind is op.SUBPATTERN:
            states = _runs(value[-1], states)
        elif kind is op.BRANCH:
            states = set().union(*(_runs(branch, states) for branch in value[1]))
        elif kind is op.IN and len(value) <= SMALL_CLASS and all(k is op.LITERAL for k, _ in value):
            states = {(done, run + chr(c)) for done, run in states for _, c in value}
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, inner = value
            if (low, high) == (0, 1) and all(k is op.LITERAL for k, _ in inner):
                states = states | _runs(inner, states)
            else:
                for _ in range(min(low, 3)):
                    states = _runs(inner, states)
                states = states if low == high <= 3 else broken(states)
        elif kind is not op.AT:
            states = broken(states)
    return states


def trigram_query(pattern: str) -> frozenset[frozenset[str]] | None:
    """Alternatives of trigrams (case folded), one of which any matching text holds in full; None if there is no such bound."""
    ways = {frozenset(run.lower()[i : i + 3] for run in (*done, last) for i in range(len(run) - 2)) for done, last in _runs(_parser.parse(pattern), {((), "")})}
    if frozenset() in ways:
        return None
    return frozenset(w for w in ways if not any(v < w for v in ways))


def vocabulary(queries: list[frozenset[frozenset[str]]]) -> tuple[list[str], list[frozenset[frozenset[str]]]]:
    """The trigrams to index, and the queries cut down to them: of each way those that most ways share, at most
    ``MOST_PER_WAY``. Fewer trigrams leave more candidates to verify and never lose one."""
    shared = Counter(t for query in queries for way in query for t in way)
    cut = [frozenset(frozenset(sorted(way, key=lambda t: (-shared[t], t))[:MOST_PER_WAY]) for way in query) for query in queries]
    return sorted({t for query in cut for way in query for t in way}), cut


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _running(xs: Column) -> Column:
    """Running sums of an array of integers, in blocks, so that long arrays aren't copied for each element."""
    block, none = 128, F.array().cast("array<int>")
    add = lambda acc, x: F.array_append(acc, F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x)
    blocks = _let(xs, lambda xs: F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int")), lambda b: F.aggregate(F.slice(xs, b * block + 1, F.lit(block)), none, add)))
    return _let(blocks, lambda own: _let(F.aggregate(F.transform(own, lambda b: F.element_at(b, -1)), F.array(F.lit(0)), add), lambda before: F.flatten(F.transform(own, lambda b, i: F.transform(b, lambda x: x + F.get(before, i))))))


SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of the leftmost non-overlapping matches of a rule that are long enough, in code points."""
    pattern = F.lit(rule.pattern)
    none = F.array().cast(SPAN)

    def found(matches: Column) -> Column:
        gaps = F.split(text, rule.pattern, -1)
        ends = _let(gaps, lambda g: _running(F.transform(matches, lambda m, i: F.length(F.get(g, i)) + F.length(m))))
        spans = _let(ends, lambda e: F.transform(matches, lambda m, i: F.struct((F.get(e, i) - F.length(m)).alias("start"), F.lit(rank).alias("rank"), F.get(e, i).alias("end"), F.lit(rule.kind).alias("kind"))))
        if rule.least:
            long = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda g: F.length(g) >= rule.least)
            spans = _let(spans, lambda s: _let(long, lambda ok: F.filter(s, lambda _, i: F.get(ok, i))))
        return F.when(F.size(matches) == 0, none).otherwise(spans)

    return _let(F.regexp_extract_all(text, pattern, F.lit(0)), found).cast(SPAN)


def postings(docs: DataFrame, trigrams: list[str], text: str = "text") -> DataFrame:
    """The inverted index: a row (trigram_id, text_key) for each trigram of the vocabulary and each text that holds it."""
    own = F.col(text).cast("string")
    low = docs.select(F.xxhash64(own).alias("text_key"), F.lower(own).alias("low"))
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams))))
    return low.select("text_key", F.explode(held).alias("trigram_id"))


def candidates(index: DataFrame, trigrams: list[str], queries: list[frozenset[frozenset[str]]]) -> DataFrame:
    """Intersects postings: text_key and, in ``fits``, which of the queries the text may match; texts with none are left out."""
    place, masks = {t: i for i, t in enumerate(trigrams)}, range(len(trigrams) // MASK_BITS + 1)
    have = index.groupBy("text_key").agg(*(F.bit_or(F.expr(f"if(trigram_id div {MASK_BITS} = {m}, shiftleft(1L, trigram_id % {MASK_BITS}), 0L)")).alias(f"have{m}") for m in masks))

    def holds(way: frozenset[str]) -> Column:
        """Whether a text has all trigrams of one way, mask by mask."""
        bits = {m: sum(1 << place[t] % MASK_BITS for t in way if place[t] // MASK_BITS == m) for m in masks}
        return reduce(lambda a, b: a & b, (F.col(f"have{m}").bitwiseAND(F.lit(b).cast("long")) == b for m, b in bits.items() if b))

    fits = [reduce(lambda a, b: a | b, (holds(way) for way in sorted(query, key=sorted))) for query in queries]
    return have.select("text_key", F.array(*fits).alias("fits")).where(F.exists("fits", lambda f: f))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", into: str = "secret_spans") -> DataFrame:
    """All columns of ``docs`` and, in ``into``, the spans of all rules, by start and then rule order.

    A null text has none. Rows that repeat are all answered; texts that are equal share their postings. Spans that start
    at one place stand in the order of the rules. ``into`` must be a new column, so that none of the table's is lost.
    """
    if into.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the table has a column {into} of its own; name another for the spans")
    asked = {n: query for n, rule in enumerate(rules) if (query := trigram_query(rule.pattern)) is not None}
    trigrams, cut = vocabulary(list(asked.values()))
    key, fits = unused(docs, "_key"), unused(docs, "_fits")
    rows = docs.withColumn(key, F.xxhash64(F.col(text).cast("string")))
    if asked:
        found = stage(candidates(postings(docs, trigrams, text), trigrams, cut), "secret-candidates")
        rows = rows.join(found.withColumnRenamed("text_key", key).withColumnRenamed("fits", fits), key, "left")
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    order = {n: i for i, n in enumerate(asked)}
    spans = []
    for n, rule in enumerate(rules):
        found_here = rule_spans(own, rule, n)
        spans.append(F.when(F.coalesce(F.get(F.col(fits), F.lit(order[n])), F.lit(False)), found_here).otherwise(F.array().cast(SPAN)) if n in order else found_here)
    return rows.withColumn(into, F.array_sort(F.concat(*spans))).select(*docs.columns, into)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def secret_digest(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of the base spans and all spans as text."""
    scanned = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), rules)
    spans = F.col("secret_spans")
    base = [r.kind for r in rules if r.base]
    of = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return scanned.select("doc_id", *(of(k).alias(f"n_{k}") for k in base), F.sha2(joined(F.filter(spans, lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"), joined(spans).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, overlapping ones merged, replaced by ``[kind]``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        parts = F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), s["kind"], F.lit("]"))))
        return F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["parts"].alias("parts"))).otherwise(F.struct(s["end"].alias("at"), parts.alias("parts")))

    whole = F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
