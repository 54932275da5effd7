"""Operator 5: URL filters with rules, and for URLs without a rule host word segmentation and naive Bayes.

Host names often run words together. A unigram model, counted over the words of all pages, splits each run of letters of
a host or path by Viterbi into its likeliest words. Multinomial naive Bayes then scores the words of the host and of the
path. It learns from a table of labelled hosts (1 unwanted, 0 wanted) and the pages they have; hosts without a label
teach nothing. Where no labels are given, a host is taken to be unwanted if its words hold a seed word, else wanted,
so what else stands in the names of such hosts is learned (``seed_labels``). The rules are no labels, as they allow and
block whole domains whatever is on them. Both classes have the same prior, as labels name only a part of the unwanted
hosts. ``held_out_agreement`` tells how well a third of the labels is found again from the rest.

Hosts and path shapes (paths with numbers folded together) are few against pages, so all work on words is done once
for each distinct host and shape, and joined back. Nothing that grows with the corpus is broadcast by this code.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed values.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)
#: Words that mark a host as unwanted; the classifier learns the rest from the URLs that hold them.
SEEDS = (
    "ads", "adult", "bet", "bets", "betting", "casino", "cheap", "escort", "gambling", "jackpot", "loan", "loans", "malware", "pill", "pills", "poker", "porn", "sex", "slots",
    "spam", "track", "viagra", "warez", "xxx",
)
SEED_COUNT = 1000
#: Letters of a word of the model; a longer run is made of several.
LONGEST_WORD = 20
#: Letters that are split at once; the parts of a longer run are split each by itself.
SPLIT_AT_ONCE = 250
#: Words, dealt as in all URLs, that each class gets on top of its own; so a word that is rare in all speaks for neither.
SMOOTHING = 100.0
SALTS = 8
RUNS = r"(\p{L}+|[0-9]+)"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path; both empty without ``://``."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(after, F.length(host) + 1, F.length(after)), r"(?s)^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        name, verdict = F.when(fits, rule.text).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def path_shape(path: Column) -> Column:
    return F.regexp_replace(F.lower(path), "[0-9]+", "0")


def word_counts(pages: DataFrame, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """Rows (word, n): how often each word of 2 to ``LONGEST_WORD`` letters stands in the texts of all pages; seeds count
    ``SEED_COUNT`` times more, so that a name that holds one is split there."""
    plain = F.regexp_replace(F.lower(F.coalesce(F.col("html").cast("string"), F.lit(""))), "(?s)<script.*?</script>|<style.*?</style>|<[^>]*>", " ")
    words = pages.select(F.explode(F.split(F.translate(plain, ".,;:!?\"'()", "          "), r"\s+")).alias("word")).where(F.col("word").rlike(rf"^\p{{L}}{{2,{LONGEST_WORD}}}$"))
    seeded = pages.sparkSession.createDataFrame([(s, SEED_COUNT) for s in seeds] or [("", 0)], "word string, n long")
    return words.groupBy("word").agg(F.count("*").alias("n")).unionByName(seeded).groupBy("word").agg(F.sum("n").alias("n"))


def segment(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest split of a label into words; an unknown run of letters costs more the longer it is."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        found = None
        for start in range(max(0, end - LONGEST_WORD), end):
            word = label[start:end]
            n = counts.get(word)
            cost = math.log(total / n) if n else math.log(total) + 5 + 2.5 * (end - start)
            if found is None or best[start][0] + cost < found[0]:
                found = (best[start][0] + cost, start)
        best.append(found)
    words, end = [], len(label)
    while end:
        words.append(label[best[end][1] : end])
        end = best[end][1]
    return words[::-1]


def runs_of(text: Column) -> Column:
    """The runs of letters and of digits of a text; digits are folded to 0, long runs are cut into parts."""
    cut = lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.length(x) - 1) / SPLIT_AT_ONCE).cast("int")), lambda i: F.substring(x, i * SPLIT_AT_ONCE + 1, F.lit(SPLIT_AT_ONCE)))
    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(RUNS)), lambda x: F.when(x.rlike("^[0-9]"), F.array(F.lit("0"))).otherwise(cut(x))))


def split_words(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows (label, words) for the distinct labels: their likeliest words, in order."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    each = labels.select("label").distinct()
    lengths = F.sequence(F.lit(1), F.length("label"))
    every = F.flatten(F.transform(lengths, lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("label") - i + 1)), lambda k: F.substring("label", i, k))))
    pieces = each.select("label", F.explode(F.array_distinct(every)).alias("word"))
    known = pieces.join(counts, "word").groupBy("label").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(label, segment(label, {r["word"]: r["n"] for r in (known if known is not None else [])}, total)) for label, known in zip(frame.label, frame.known, strict=True)]
            yield pd.DataFrame(rows, columns=["label", "words"])

    return each.join(known, "label", "left").mapInPandas(split, "label string, words array<string>")


def salted(df: DataFrame, keys: DataFrame, on: str, *by: str) -> DataFrame:
    """``df`` joined to ``keys`` (one row for each ``on``), where a value like ``com`` may stand in nearly every row.

    Rows are dealt in ``SALTS`` parts by the columns ``by``, and ``keys`` has a copy for each part.
    """
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))
    copies = keys.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies, [on, "_part"]).drop("_part")


def words_of_urls(keys: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows (side, key, word): the words of the distinct hosts (all labels, without a port) and path shapes.

    ``key`` is the SHA-1 of the host or shape, so a long name isn't repeated with each of its words.
    """
    host = keys.select(F.lit("host").alias("side"), F.col("host_key").alias("key"), F.regexp_replace("host", "(:[0-9]*)?$", "").alias("own")).distinct()
    path = keys.select(F.lit("path").alias("side"), F.col("shape_key").alias("key"), F.col("shape").alias("own")).distinct()
    labels = stage(host.unionByName(path).select("side", "key", F.explode(runs_of(F.col("own"))).alias("label")), "url-labels")
    return salted(labels, split_words(labels, counts), "label", "key").select("side", "key", F.explode("words").alias("word"))


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, seeds: tuple[str, ...] = SEEDS, labels: DataFrame | None = None) -> DataFrame:
    """Rows page_id, host, path, rule, verdict, log_odds (of block; null where a rule decides).

    ``labels`` has rows (host, label), label 1 for unwanted hosts and 0 for wanted ones; of a host's labels the largest
    counts, others than 0 and 1 and null hosts don't. Without it hosts are labelled by ``seeds``, which otherwise only
    help to split names.

    A null URL or one without ``://`` has an empty host and path, fits no rule and is allowed, as no word
    speaks against it; so is one whose words speak for both alike. Rows that repeat are all answered; a null page_id
    stays null. Other columns are ignored.
    """
    host, path = url_parts(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path")).withColumn("shape", path_shape(F.col("path")))
    rows = rows.withColumns({"host_key": F.sha1(F.encode("host", "UTF-8")), "shape_key": F.sha1(F.encode("shape", "UTF-8"))})
    keys = stage(rows.groupBy("host_key", "shape_key", "host", "shape").agg(F.count("*").alias("n")), "url-keys")
    counts = stage(word_counts(pages, seeds), "url-words")
    words = stage(words_of_urls(keys, counts), "url-words-of")
    own = words.groupBy("side", "key").agg(F.collect_list(F.when(F.col("side") == "path", F.concat(F.lit("/"), "word")).otherwise(F.col("word"))).alias("words"), F.max(F.col("word").isin(*seeds)).cast("int").alias("label"))
    of = lambda side, key, *more: own.where(F.col("side") == side).select(F.col("key").alias(key), F.col("words").alias(f"{side}_words"), *more)
    none = F.array().cast("array<string>")
    by_seeds = [F.coalesce("label", F.lit(0)).alias("label")] if labels is None else []
    both = keys.drop("host", "shape").join(of("host", "host_key", *(["label"] if by_seeds else [])), "host_key", "left").join(of("path", "shape_key"), "shape_key", "left")
    if labels is not None:
        given = labels.where("host is not null and label in (0, 1)").groupBy(F.sha1(F.encode("host", "UTF-8")).alias("host_key")).agg(F.max("label").cast("int").alias("label"))
        both, by_seeds = both.join(given, "host_key", "left"), [F.col("label")]
    tokens = both.select("host_key", "shape_key", "n", *by_seeds, F.explode(F.concat(F.coalesce("host_words", none), F.coalesce("path_words", none))).alias("token"))
    tokens = stage(tokens, "url-tokens")
    times = lambda label: F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0))
    model = tokens.groupBy("token").agg(times(1).alias("bad"), times(0).alias("good"))
    bad, good = (float(x or 0) for x in model.agg(F.sum("bad"), F.sum("good")).first())
    more = (F.col("bad") + F.col("good")) * (SMOOTHING / max(bad + good, 1.0))
    ratio = F.log((F.col("bad") + more) / (bad + SMOOTHING)) - F.log((F.col("good") + more) / (good + SMOOTHING))
    odds = model.select("token", F.when(F.col("bad") + F.col("good") > 0, ratio).otherwise(0.0).alias("odds"))  # words of no labelled URL speak for neither
    scores = stage(salted(tokens, odds, "token", "host_key", "shape_key").groupBy("host_key", "shape_key").agg(F.sum("odds").alias("odds")), "url-scores")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    # one host may have a third of all pages, so pages are dealt in parts
    parts = scores.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumns({"rule": name, "ruled": verdict, "part": F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int")})
    out = dealt.join(parts, ["host_key", "shape_key", "part"], "left")
    log_odds = F.round(F.coalesce("odds", F.lit(0.0)), 6)
    judged = F.coalesce("ruled", F.when(log_odds > 0, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", judged.alias("verdict"), F.when(F.col("ruled").isNull(), log_odds).alias("log_odds"))


def seed_labels(pages: DataFrame, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """Rows (host, label) of all hosts of the pages: 1 where a host's words hold a seed word, else 0."""
    host, _ = url_parts(F.col("url").cast("string"))
    keys = stage(pages.select(host.alias("host")).distinct().withColumns({"host_key": F.sha1(F.encode("host", "UTF-8")), "shape_key": F.sha1(F.lit("")), "shape": F.lit("")}), "url-hosts")
    words = words_of_urls(keys, stage(word_counts(pages, seeds), "url-words")).where("side = 'host'")
    bad = words.where(F.col("word").isin(*seeds)).select(F.col("key").alias("host_key"), F.lit(1).alias("label")).distinct()
    return keys.join(bad, "host_key", "left").select("host", F.coalesce("label", F.lit(0)).alias("label"))


def held_out_agreement(pages: DataFrame, labels: DataFrame, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """Rows (label, n_hosts, agreed): how many held-out hosts of each label are judged as labelled.

    Hosts whose crc32 leaves 1 when divided by 3 are held out: the classifier learns from the others' labels, judges all
    pages without any rule, and a host is judged as most of its pages are.
    """
    out = F.pmod(F.crc32(F.encode("host", "UTF-8")), F.lit(3)) == 1
    judged = judge_urls(pages, (), seeds, labels.where(~out)).where(out)
    hosts = judged.groupBy("host").agg((F.count_if(F.col("verdict") == "block") * 2 > F.count("*")).cast("int").alias("_judged"))
    own = labels.where(out & F.col("label").isin(0, 1)).groupBy("host").agg(F.max("label").alias("label"))
    return own.join(hosts, "host").groupBy("label").agg(F.count("*").alias("n_hosts"), F.count_if(F.col("_judged") == F.col("label")).alias("agreed"))
