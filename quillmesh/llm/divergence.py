"""How far the sources of a language differ in their terms (operator 13).

Kept terms are found by iceberg prefix refinement: a term in enough documents has only prefixes in
at least as many, so prefixes (of bytes) are extended level by level, each level three times as long,
and those in too few documents are discarded with all that they begin, until only complete terms remain.
A document is one row and lies in one task, so distinct documents are counted without shuffling ids:
tasks send partial counts of prefixes that are still alive. Shares are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.llm.terms import distinct_pairs, letter_terms, slices, summed
from quillmesh.llm.words import freeing
from quillmesh.storage import materialize, new_path, small_side

LEAST_DOCUMENTS, PRIOR, SCALE, TOP_TERMS = 30, 5, 1_000_000_000, 50
#: Bytes of the first level's prefixes, and by how much each level is longer than the one before.
FIRST_LEVEL, EXTENSION = 4, 3
#: Tasks are told what is alive when it is no more terms than this, of so many bytes on average; beyond, partial counts meet it by a join.
KNOWN_TERMS, BYTES_A_TERM = 500_000, 32
#: Terms and, on average, sources whose shares one task compares.
BLOCK_TERMS, BLOCK_SOURCES = 1024, 64


class Known:
    """What is alive, as (language, term) pairs numbered from 0 in the order of a table (columns lang,
    term); without a table every pair may be alive."""

    def __init__(self, table: pa.Table | None):
        self.all = table is None
        if table is not None:
            lang, self.langs = _coded(table.column("lang").cast(pa.string()).combine_chunks())
            term, self.terms = _coded(table.column("term").cast(pa.binary()).combine_chunks())
            codes = lang * max(len(self.terms), 1) + term
            self.order = np.argsort(codes)
            self.codes = codes[self.order]

    def numbers(self, langs: pa.Array, terms: pa.Array, lang: np.ndarray, term: np.ndarray) -> np.ndarray:
        """The numbers of pairs of indices of ``langs`` and ``terms``; -1 of those that aren't alive."""
        own_lang, own_term = (pc.index_in(x.cast(kind), value_set=known).fill_null(-1).to_numpy().astype(np.int64) for x, known, kind in ((langs, self.langs, pa.string()), (terms, self.terms, pa.binary())))
        lang, term = own_lang[lang], own_term[term]
        code = np.where((lang >= 0) & (term >= 0), lang * max(len(self.terms), 1) + term, -1)
        place = np.minimum(np.searchsorted(self.codes, code), max(len(self.codes) - 1, 0))
        found = self.codes[place] == code if len(self.codes) else np.zeros(len(code), bool)
        return np.where(found, self.order[place] if len(self.codes) else -1, -1)


def _coded(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = column.dictionary_encode()
    return coded.indices.fill_null(0).to_numpy().astype(np.int64), coded.dictionary


def _prefixes(part: pa.RecordBatch, before: int, width: int, alive: Known) -> pa.RecordBatch:
    """``lang, whole, prefix, docs``: of terms longer than ``before`` bytes whose prefix of that length is alive."""
    row, index, terms = letter_terms(part.column(1))
    plain = terms.cast(pa.binary())
    sizes = pc.binary_length(plain).to_numpy()
    longer = sizes > before
    candidate, prefixes = _coded(pc.binary_slice(plain, 0, width))
    candidate = candidate * 2 + (sizes <= width)
    if before:
        row, index = row[longer[index]], index[longer[index]]
    lang, langs = _coded(part.column(0))
    row, candidate = distinct_pairs(row, candidate[index], part.num_rows, 2 * len(prefixes))
    found, docs = np.unique(lang[row] * (2 * max(len(prefixes), 1)) + candidate, return_counts=True)
    lang, candidate = found // (2 * max(len(prefixes), 1)), found % (2 * max(len(prefixes), 1))
    if not alive.all:
        parent, parents = _coded(pc.binary_slice(prefixes, 0, before))
        passed = alive.numbers(langs, parents, lang, parent[candidate // 2]) >= 0
        lang, candidate, docs = lang[passed], candidate[passed], docs[passed]
    return pa.RecordBatch.from_arrays([langs.take(pa.array(lang)), pa.array(candidate % 2 == 1), prefixes.take(pa.array(candidate // 2)), pa.array(docs)], ["lang", "whole", "prefix", "docs"])


@freeing
def _prefix_task(batches: Iterator[pa.RecordBatch], before: int, width: int, sent) -> Iterator[pa.RecordBatch]:
    yield from summed((_prefixes(part, before, width, sent.value) for part in slices(batches, 1)), ["lang", "whole", "prefix"], "docs")


def _counted(lang: pa.Array, source: pa.Array, text: pa.Array) -> tuple:
    """Every (language, source, term) of texts, as indices, with its occurrences."""
    row, index, terms = letter_terms(text)
    lang, langs = _coded(lang)
    source, sources = _coded(source)
    group, at = np.unique(lang * max(len(sources), 1) + source, return_inverse=True)
    size = max(len(terms), 1)
    code = at[row] * size + index
    if len(group) * size <= 16 * len(row) + 1024:
        count = np.bincount(code, minlength=len(group) * size)
        found = np.flatnonzero(count)
        count = count[found]
    else:
        found, count = np.unique(code, return_counts=True)
    group = group[found // size]
    return langs, sources, terms, group // max(len(sources), 1), group % max(len(sources), 1), found % size, count


@freeing
def _numbered_task(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """``source, number, c``: occurrences of the terms that are known, by their numbers."""

    def counts() -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            langs, sources, terms, lang, source, term, count = _counted(part.column(0), part.column(1), part.column(2))
            number = sent.value.numbers(langs, terms, lang, term)
            some = number >= 0
            yield pa.RecordBatch.from_arrays([sources.take(pa.array(source[some])), pa.array(number[some].astype(np.int32)), pa.array(count[some])], ["source", "number", "c"])

    yield from summed(counts(), ["source", "number"], "c")


@freeing
def _occurrence_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, term, c``: occurrences of all terms."""

    def counts() -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            langs, sources, terms, lang, source, term, count = _counted(part.column(0), part.column(1), part.column(2))
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(lang)), sources.take(pa.array(source)), terms.cast(pa.binary()).take(pa.array(term)), pa.array(count)], ["lang", "source", "term", "c"])

    yield from summed(counts(), ["lang", "source", "term"], "c")


def _known(alive: DataFrame, limit: int) -> pa.Table | None:
    """The pairs (columns lang, term), if their number and bytes show that tasks can have them all."""
    size = alive.limit(limit + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("lang") + F.octet_length("term")), F.lit(0))).first()
    return alive.toArrow() if size[0] <= limit and size[1] <= limit * BYTES_A_TERM else None


def kept_terms(rows: DataFrame, least: int, limit: int = KNOWN_TERMS, first: int = FIRST_LEVEL) -> DataFrame:
    """``lang, term`` (bytes): the terms in at least ``least`` rows of a language (columns lang, text; no nulls)."""
    spark = rows.sparkSession
    path, before, width, alive, known = new_path(spark, "kept-terms"), 0, first, None, None
    while True:
        sent = spark.sparkContext.broadcast(Known(known))
        counted = rows.select("lang", "text").mapInArrow(lambda x, a=before, b=width, s=sent: _prefix_task(x, a, b, s), "lang string, whole boolean, prefix binary, docs long")
        if before and known is None:
            parents = alive.select(F.col("lang").alias("parent_lang"), F.col("term").alias("parent"))
            counted = counted.join(parents, (F.substring("prefix", 1, before) == F.col("parent")) & (F.col("lang") == F.col("parent_lang")), "left_semi")
        level = materialize(counted.groupBy("lang", "whole", "prefix").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least), "prefixes")
        level.where("whole").select("lang", F.col("prefix").alias("term")).write.mode("append").parquet(path)
        alive = level.where("NOT whole").select("lang", F.col("prefix").alias("term"))
        if alive.isEmpty():
            return spark.read.schema("lang string, term binary").parquet(path)
        known, before, width = _known(alive, limit), width, EXTENSION * width


def term_counts(rows: DataFrame, kept: DataFrame, limit: int = KNOWN_TERMS) -> DataFrame:
    """``lang, source, term, c``: occurrences (at least one) of kept terms in each group."""
    spark, rows, known = rows.sparkSession, rows.select("lang", "source", "text"), _known(kept, limit)
    if known is None:
        counted = rows.mapInArrow(_occurrence_task, "lang string, source string, term binary, c long").join(kept, ["lang", "term"], "left_semi")
        return counted.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"))
    sent = spark.sparkContext.broadcast(Known(known))
    counted = rows.mapInArrow(lambda x: _numbered_task(x, sent), "source string, number int, c long").groupBy("source", "number").agg(F.sum("c").alias("c"))
    numbered = spark.createDataFrame(known.append_column("number", pa.array(np.arange(known.num_rows), pa.int32())), "lang string, term binary, number int")
    return counted.join(small_side(numbered), "number").select("lang", "source", "term", "c")


def _compare(table: pa.Table) -> pa.Table:
    """Sums of absolute differences for the pairs of sources of two blocks, over one block of terms. Rows
    without a term give each source's share of a term that it lacks, and the block's number of terms."""
    lang, first, second = (table.column(c)[0].as_py() for c in ("lang", "first", "second"))
    source, sources = _coded(table.column("source").combine_chunks())
    term, terms = _coded(table.column("term").combine_chunks())
    block, share, given = table.column("block").to_numpy(), table.column("share").to_numpy(), table.column("term").is_valid().to_numpy()
    shares, blocks = np.zeros((len(sources), len(terms)), np.int64), np.zeros(len(sources), np.int64)
    shares[source[~given]] = share[~given][:, None]
    shares[source[given], term[given]] = share[given]
    lacking = np.zeros(len(sources), np.int64)
    lacking[source[~given]] = share[~given]
    # terms that no source of the two blocks has
    others_have = int(table.column("terms").to_numpy()[~given].max()) - len(terms)
    blocks[source] = block
    names, left, right, sums = sources.to_pylist(), [], [], []
    order = sorted(range(len(names)), key=lambda i: names[i].encode())
    for at, i in enumerate(order):
        if first == second:
            others = order[at + 1 :]
        else:
            others = [j for j in order if blocks[i] == first and blocks[j] == second]
        left += [names[i]] * len(others)
        right += [names[j] for j in others]
        them = np.array(others, np.int64)
        sums += (np.abs(shares[them] - shares[i]).sum(1) + others_have * np.abs(lacking[them] - lacking[i])).tolist()
    n = len(sums)
    return pa.table({"lang": pa.array([lang] * n, pa.string()), "a": pa.array(left, pa.string()), "b": pa.array(right, pa.string()), "value": pa.array(sums, pa.int64())})


def pair_distances(shares: DataFrame, groups: DataFrame, kept: DataFrame, block_terms: int = BLOCK_TERMS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """``lang, a, b, value`` for each two sources of a language, both ways: the sum of |p - q| over all kept terms.

    Blocks of sources meet in pairs, once for each block of terms, so that a task holds about
    2 * block_sources * block_terms shares.
    """
    hashed = lambda column, n: F.pmod(F.xxhash64(column), n).cast("int")
    sizes = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / block_sources).alias("blocks"), F.greatest(F.ceil(F.max("v") / block_terms), F.lit(1)).alias("parts"))
    sizes = small_side(materialize(sizes, "sizes"))
    cells = shares.join(sizes, "lang").select("lang", "source", "term", F.col("p").alias("share"), hashed("source", F.col("blocks")).alias("block"), "blocks", hashed("term", F.col("parts")).alias("part"), F.lit(0).cast("long").alias("terms"))
    lacking = groups.join(sizes, "lang").select(
        "lang", "source", F.lit(None).cast("binary").alias("term"), F.col("none").alias("share"), hashed("source", F.col("blocks")).alias("block"), "blocks",
        F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("part"),
    )
    in_part = kept.join(sizes, "lang").groupBy("lang", hashed("term", F.col("parts")).alias("part")).agg(F.count(F.lit(1)).alias("terms"))
    lacking = lacking.join(small_side(materialize(in_part, "part-sizes")), ["lang", "part"], "left").withColumn("terms", F.coalesce("terms", F.lit(0)))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    met = cells.unionByName(lacking).withColumn("other", other)
    met = met.select("lang", "part", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "source", "term", "share", "terms")
    sums = met.groupBy("lang", "part", "first", "second").applyInArrow(_compare, "lang string, a string, b string, value long")
    one_way = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return one_way.select("lang", both.alias("x"), "value").select("lang", "x.a", "x.b", "value")


def source_divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
    prior: int = PRIOR,
    scale: int = SCALE,
    top_terms: int = TOP_TERMS,
    **bounds: int,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each source of a language its distances to the
    others (part "pair", all ranks) and the terms that it has more of than its language (part "term").

    * Terms are runs of letters and non-ASCII signs, A-Z lower-cased. Null text, lang and source count as empty.
    * A language keeps the terms of at least ``least_documents`` of its rows; repeated rows are
      documents of their own, and ids aren't looked at. Terms may be of any length.
    * p = 1 + floor(scale * (count + prior) / (N + prior * V)), in exact integers, with V kept terms
      and N their occurrences in the group. Without kept terms distances are 0.
    * Ties are ranked by the item's bytes. An empty table gives an empty result.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    limits = {k: v for k, v in bounds.items() if k in ("limit", "first")}
    blocks = {k: v for k, v in bounds.items() if k not in limits}
    kept = kept_terms(rows, least_documents, **limits)
    counts = materialize(term_counts(rows, kept, **{k: v for k, v in limits.items() if k == "limit"}), "term-counts")

    def share(c: str) -> str:  # whole-number division of decimals
        return f"1 + ((cast({c} as decimal(18,0)) + {prior}) * {scale}) div (n + {prior} * v)"

    kinds = small_side(materialize(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v")), "kinds"))
    groups = rows.select("lang", "source").distinct().join(counts.groupBy("lang", "source").agg(F.sum("c").alias("n")), ["lang", "source"], "left").join(kinds, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))
    none = F.when(F.col("v") > 0, F.expr(share("0"))).otherwise(F.lit(0))
    groups = materialize(groups.withColumn("none", none), "groups")
    shares = materialize(counts.join(small_side(groups), ["lang", "source"]).select("lang", "source", "term", "c", F.expr(share("c")).alias("p")), "shares")

    within = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pair_distances(shares.select("lang", "source", "term", "p"), groups, kept, **blocks)
    pairs = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value").withColumn("rank", F.row_number().over(within))

    whole = small_side(materialize(groups.groupBy("lang").agg(F.sum("n").cast("long").alias("n"), F.max("v").alias("v")), "languages"))
    of_lang = counts.groupBy("lang", "term").agg(F.sum("c").alias("c")).join(whole, "lang").select("lang", "term", F.expr(share("c")).alias("q"))
    above = shares.join(of_lang, ["lang", "term"]).where("p > q")
    terms = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= top_terms)
    return pairs.unionByName(terms)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = {
    "op13_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        o AS (SELECT lang, source, row_no, unnest(terms) AS term FROM d),
        kept AS (SELECT lang, term FROM o GROUP BY ALL HAVING count(DISTINCT row_no) >= 30),
        c AS (SELECT lang, source, term, count(*) AS c FROM o JOIN kept USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        g AS (SELECT lang, source, coalesce((SELECT sum(c) FROM c WHERE c.lang = s.lang AND c.source = s.source), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) s),
        p AS (SELECT lang, source, term, coalesce(c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c, 0) + 5)) // (n + 5 * v) AS p
              FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
        q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + 5)) // (sum(sum(c)) OVER (PARTITION BY lang) + 5 * any_value(v)) AS q FROM c JOIN v USING (lang) GROUP BY lang, term),
        f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
              UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r QUALIFY part = 'pair' OR rank <= 50
    """
}
QUERIES = {"op13_source_divergence": op13_source_divergence}
