"""URL filters: rules, and naive Bayes over segmented host names and path tokens (operator 11).

Host names run words together. A unigram model of the words that the pages use splits them: for
each name the most probable sequence of words, by Viterbi. The pages that a rule decides teach a
multinomial naive Bayes model on the host's words and the path's tokens, which decides the others.
Everything is worked on once a different host, name or address (host and path).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm.hot import join_hot
from quillmesh.llm.terms import slices, split_terms, summed
from quillmesh.llm.words import freeing
from quillmesh.storage import BROADCAST_ROWS, materialize

#: Host, path and verdict.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: The longest label that a host name can have; longer runs of letters are no names and stay whole.
LONGEST_NAME = 63
#: Added to the count of every token.
SMOOTHING = 1.0
#: No running text: markup, entities, and host names that a page names, which would make words of whole names.
MARKUP = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>|&[a-z0-9#]+;|[a-z0-9-]+(?:\.[a-z0-9-]+)+"
#: Words that tell of unwanted sites: each counts as a hundredth of the tokens of "block" besides those learned.
SEEDS = ("ads", "adult", "bets", "casino", "pills", "porn", "spam", "xxx")
SEED_SHARE = 0.01
#: What lies between words of a page, after A-Z are lower-cased: ASCII other than letters.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LETTERS = r"[a-z\x{80}-\x{10FFFF}]+"


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"\A[\s\S]*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to "?", "#" or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"\A[\s\S]*?://[^/?#]*([^?#]*)", 1)


def fitting_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``k, rule, ruled``: of the rules (columns rule_host, rule_path, verdict) that fit an address
    (columns k, host, path), the longest; ties go to the longer host, then to "block"."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    near = addresses.select("k", "path", F.explode(suffixes).alias("rule_host"))
    met = join_hot(near, rules, "rule_host").where(F.startswith("path", F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = F.max_by(F.struct(rule.alias("rule"), F.col("verdict").alias("ruled")), F.struct(F.length(rule), F.length("rule_host"), "verdict"))
    return met.groupBy("k").agg(best.alias("best")).select("k", "best.rule", "best.ruled")


# --- segmentation -------------------------------------------------------------------------------


@freeing
def _page_words(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[pa.RecordBatch]:
    only = None if wanted is None else wanted.value

    def counts() -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            _, index, terms = split_terms(pc.replace_substring_regex(part.column(0).fill_null(""), pattern=MARKUP, replacement=" "), SEPARATORS)
            count = np.bincount(index, minlength=len(terms))
            words = terms.to_pylist()
            used = [i for i, w in enumerate(words) if count[i] and (only is None or w in only)]
            # the empty word stands for all
            yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in used] + [""], pa.string()), pa.array(np.append(count[used], len(index)).astype(np.int64))], ["word", "c"])

    yield from summed(counts(), ["word"], "c")


def page_words(html: DataFrame, wanted: DataFrame, limit: int = BROADCAST_ROWS) -> tuple[DataFrame, int]:
    """``word, c`` of all pages' visible words (a table of one column) that are ``wanted`` (column
    word, unique), and the number of all words. Tasks drop unwanted words if a count shows that few are wanted."""
    few = wanted.limit(limit + 1).collect()
    sent = html.sparkSession.sparkContext.broadcast(frozenset(r["word"] for r in few)) if len(few) <= limit else None
    counted = html.mapInArrow(lambda x: _page_words(x, sent), "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))
    counted = materialize(counted, "page-words")
    total = counted.where("word = ''").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    return counted.where("word <> ''").join(wanted, "word", "left_semi"), total


def best_words(name: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The most probable words of a name. ``known`` has the counts of the words by (start, length);
    an unknown word of n characters has the probability 10 / (total * 10 ** n). Ties go to fewer
    words, then to the longer first word."""
    whole = math.log10(max(total, 1))
    best: list[tuple] = [(0.0, 0, ())]
    for end in range(1, len(name) + 1):
        options = []
        for start in range(end):
            score, words, sizes = best[start]
            count = known.get((start, end - start))
            options.append((round(score + (math.log10(count) if count else 1.0 - (end - start)) - whole, 9), words - 1, (*sizes, end - start)))
        best.append(max(options))
    out, at = [], 0
    for size in best[-1][2]:
        out.append(name[at : at + size])
        at += size
    return out


@freeing
def _segment(batches: Iterator[pa.RecordBatch], total: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [best_words(name, {(k["start"] - 1, k["size"]): k["c"] for k in known or ()}, total) for name, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["run", "words"])


def segmented_hosts(hosts: DataFrame, html: DataFrame) -> DataFrame:
    """``host, words``: the words of each host (column host, unique), in order.

    Runs of digits are words; runs of letters (and non-ASCII signs) of at most 63 are split by the
    pages' words; longer runs stay whole; all else lies between words.
    """
    kept = F.regexp_extract_all("host", F.lit(_LETTERS + "|[0-9]+"), F.lit(0))
    runs = materialize(hosts.select("host", F.posexplode(kept).alias("pos", "run")), "host-runs")
    names = runs.select("run").distinct().where(F.col("run").rlike("^" + _LETTERS + "$") & (F.length("run") <= LONGEST_NAME))
    names = materialize(names, "host-names")
    size = F.length("run")
    spans = names.select("run", size.alias("length"), F.explode(F.sequence(F.lit(1), size)).alias("start"))
    spans = spans.select("run", "start", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("start") + 1)).alias("size"))
    spans = materialize(spans.select("run", "start", "size", F.expr("substring(run, start, size)").alias("word")), "host-spans")
    wanted = materialize(spans.select("word").distinct(), "host-substrings")
    words, total = page_words(html, wanted)
    known = join_hot(spans, materialize(words, "host-words"), "word").groupBy("run").agg(F.collect_list(F.struct("start", "size", "c")).alias("known"))
    split = names.join(known, "run", "left").mapInArrow(lambda x: _segment(x, total), "run string, words array<string>")
    split = join_hot(runs, materialize(split, "segmented"), "run", "left")
    parts = F.array_sort(F.collect_list(F.struct("pos", F.coalesce("words", F.array("run")).alias("words"))))
    return split.groupBy("host").agg(parts.alias("parts")).select("host", F.flatten("parts.words").alias("words"))


# --- naive Bayes --------------------------------------------------------------------------------


def address_tokens(addresses: DataFrame, hosts: DataFrame) -> DataFrame:
    """``k, n, ruled, token``: words of the host (marked "h:") and letter and digit runs of the lower-cased path ("p:")."""
    of_path = F.regexp_extract_all(F.translate("path", _UPPER, _LOWER), F.lit(_LETTERS + "|[0-9]+"), F.lit(0))
    mark = lambda words, by: F.transform(words, lambda w: F.concat(F.lit(by), w))
    both = F.concat(mark(F.coalesce("words", F.array().cast("array<string>")), "h:"), mark(of_path, "p:"))
    return join_hot(addresses, hosts, "host", "left").select("k", "n", "ruled", F.explode(both).alias("token"))


def block_scores(addresses: DataFrame, tokens: DataFrame, smoothing: float = SMOOTHING, seeds: Sequence[str] = SEEDS) -> tuple[DataFrame, float]:
    """``k, odds`` of addresses that no rule decides: the summed log odds of "block" against "allow"
    of their tokens that were learned or are ``seeds``; and the log odds of the classes."""
    blocked, allowed = (F.coalesce(F.sum(F.when(F.col("ruled") == v, F.col("n"))), F.lit(0)) for v in ("block", "allow"))
    learned = tokens.where("ruled IS NOT NULL").groupBy("token").agg(blocked.alias("b"), allowed.alias("a"), F.lit(0).alias("seed"))
    marked = tokens.sparkSession.createDataFrame([(by + w, 0, 0, 1) for w in seeds for by in ("h:", "p:")], "token string, b long, a long, seed int")
    model = materialize(learned.unionByName(marked).groupBy("token").agg(F.sum("b").alias("b"), F.sum("a").alias("a"), F.max("seed").alias("seed")), "url-tokens")
    b, a, v = model.agg(F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("a"), F.lit(0)), F.greatest(F.count(F.lit(1)), F.lit(1))).first()
    pages = addresses.agg(blocked, allowed).first()
    share = lambda c, n: F.log((c + smoothing) / (n + smoothing * v))
    taught = F.col("b") + F.col("seed") * float(b * SEED_SHARE)
    odds = share(taught, b * (1 + SEED_SHARE * 2 * len(seeds))) - share(F.col("a"), a)
    model = materialize(model.select("token", odds.alias("odds")), "url-model")
    scored = join_hot(materialize(tokens.where("ruled IS NULL").select("k", "token"), "open-tokens"), model, "token").groupBy("k").agg(F.sum("odds").alias("odds"))
    return scored, math.log((pages[0] + smoothing) / (pages[1] + smoothing))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] | DataFrame = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    smoothing: float = SMOOTHING,
    seeds: Sequence[str] = SEEDS,
) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, score``.

    * A rule (host, path, "allow" or "block") fits its host and all subdomains if the path starts
      with the rule's. The longest (host and path together) wins; its verdict stands.
    * Other addresses are blocked if their log odds of "block" (``score``, to nine places; null where
      a rule decides) are positive, as learned from the rows that rules decide, repeated rows counted each time.
      Tokens that are neither learned nor seeds don't count. If no rule fits any row, addresses
      without a seed are allowed.
    * Null urls and those without "://" have an empty host and path and are judged by the classes' odds
      alone. Null html has no words. Rows of one address get one verdict. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "rule_host string, rule_path string, verdict string")
    rules = materialize(rules.toDF("rule_host", "rule_path", "verdict"), "rules")
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = materialize(rows.withColumn("k", F.substring(F.unhex(F.sha2(F.concat_ws("\n", F.length("host"), "host", "path"), 256)), 1, 16)), "urls")
    addresses = materialize(rows.groupBy("k", "host", "path").agg(F.count(F.lit(1)).alias("n")), "addresses")
    addresses = materialize(addresses.join(fitting_rules(addresses, rules), "k", "left"), "ruled")
    hosts = materialize(segmented_hosts(addresses.select("host").distinct(), pages.select(F.col(html_col).alias("html"))), "hosts")
    tokens = materialize(address_tokens(addresses, hosts), "tokens")
    scores, prior = block_scores(addresses, tokens, smoothing, seeds)
    odds = F.when(F.col("ruled").isNull(), F.round(F.lit(prior) + F.coalesce("odds", F.lit(0.0)), 9))
    verdict = F.coalesce("ruled", F.when(odds > 0, "block").otherwise("allow"))
    judged = materialize(addresses.join(scores, "k", "left").select("k", "rule", verdict.alias("verdict"), odds.alias("score")), "judged")
    return join_hot(rows, judged, "k").select("page_id", "host", "path", "rule", "verdict", "score")


def op11_host_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {"op11_host_segmentation": op11_host_segmentation}
ORACLE: dict[str, str] = {}
