"""Removal of repeated word spans by suffix automata (operator 7).

Every window of ``length`` words has an anchor: the smallest hash among its shorter word runs. All
places where a window occurs share its anchor, and the neighbouring windows of one anchor place form
a segment. A first pass counts anchors; a window whose anchor occurs once can't repeat. The repeated
anchors make a bit filter of fixed size, which is broadcast. A second pass sends the segments that
pass it, each different one once a task and with its words, to reference shards by anchor.

A shard's suffix automaton, over its words and with occurrence counts, decides: streaming the shard's
segments through it gives the matching statistics, that is, the longest suffix at each word that
occurs twice, and the maximal spans of at least a window are carried back to all places of the
segment. Shards are of bounded size. An anchor with very many different segments (a line that is
everywhere) is dealt over shards by its windows instead, so that no shard holds it alone.

An automaton only meets the segments that can match it. Broadcasting the automata of all reference
text to all tasks would make every document pass every shard, which grows with the square of the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.texts import distinct_texts
from quillmesh.llm.words import ascii_words, freeing, gram_hashes, mix, sorted_groups, word_hashes
from quillmesh.storage import materialize, small_side

WINDOW = 35
ANCHOR_WORDS = 8
#: Words of texts that a task works on together.
WORDS_TOGETHER = 100_000
#: Bytes of segments that a task, or a shard's automaton, holds.
HELD_BYTES = 16_000_000
SHARD_BYTES = 300_000
#: Anchors with more segments are dealt by single windows.
SEGMENTS_PER_ANCHOR = 512
#: Bits of the filter of repeated anchors, and of each part of it that a task builds.
FILTER_BITS, FILTER_PART = 1 << 27, 1 << 17
HELD_ANCHORS = 1_000_000
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _batch(schema: str, **columns) -> pa.RecordBatch:
    """A record batch of a schema of simple types; columns that aren't given are null."""
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    n = len(next(iter(columns.values())))
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[c], types[t]) if c in columns else pa.nulls(n, types[t]) for c, t in fields], [c for c, _ in fields])


def segments(hashes: np.ndarray, lengths: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end (word hashes, words of each text): for every anchor place the number
    of its text, the anchor, and the first and last window (by their first word) that have it."""
    windows = len(hashes) - length + 1
    if windows <= 0:
        return (np.empty(0, np.int64),) * 4
    run = min(ANCHOR_WORDS, length)
    grams = gram_hashes(hashes, run)
    # the leftmost smallest run of each window: the high bits order, the low bits are the place
    low = np.uint64(0xFFFFFFFF)
    least, width, span = (grams & ~low) | np.arange(len(grams), dtype=np.uint64), 1, length - run + 1
    while 2 * width <= span:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if width < span:
        least = np.minimum(least[: width - span], least[span - width :])
    place = (least & low).astype(np.int64)
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = text[:windows] == text[length - 1 :]
    changes = np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:windows] != text[: windows - 1]) | (inside[1:] != inside[:-1]), [True]])
    first, last = np.flatnonzero(changes[:-1] & inside), np.flatnonzero(changes[1:] & inside)
    return text[first], grams[place[first]].view(np.int64), first, last


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]], np.ndarray, np.ndarray]]:
    """Keys and words of some texts at a time, with the word hashes of all and the words of each."""
    keys, words, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            keys.append(key)
            words.append(ascii_words(text.as_py(), lower=False))
            held += len(words[-1])
            if held >= WORDS_TOGETHER or len(keys) >= 1000:
                yield keys, words, np.concatenate([word_hashes(w) for w in words]), np.array([len(w) for w in words])
                keys, words, held = [], [], 0
    if keys:
        yield keys, words, np.concatenate([word_hashes(w) for w in words]), np.array([len(w) for w in words])


@freeing
def _anchors(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def sent() -> pa.RecordBatch:
        anchor, count = np.unique(np.concatenate(held), return_counts=True)
        return _batch("anchor long, n int", anchor=anchor, n=np.minimum(count, 2).astype(np.int32))

    for _, _, hashes, lengths in _together(batches):
        held.append(segments(hashes, lengths, length)[1])
        n += len(held[-1])
        if n >= HELD_ANCHORS:
            yield sent()
            held, n = [], 0
    if n:
        yield sent()


def _bits(anchors: np.ndarray) -> list[np.ndarray]:
    """The two bits of the filter that stand for each anchor."""
    x = anchors.view(np.uint64)
    return [(mix(x ^ np.uint64(salt)) & np.uint64(FILTER_BITS - 1)).astype(np.int64) for salt in (0x51, 0xA7)]


@freeing
def _bit_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = np.unique(np.concatenate(_bits(batch.column(0).to_numpy())))
        yield _batch("part int, bit int", part=(bits // FILTER_PART).astype(np.int32), bit=(bits % FILTER_PART).astype(np.int32))


@freeing
def _filter_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in sorted_groups(batches, "part"):
        bits = np.zeros(FILTER_PART, bool)
        bits[group.column("bit").to_numpy()] = True
        yield _batch("part int, bits binary", part=[group.column("part")[0].as_py()], bits=[np.packbits(bits).tobytes()])


def anchor_filter(anchors: DataFrame) -> np.ndarray:
    """Bits of all values of a long column, FILTER_BITS of them whatever the input."""
    parts = anchors.mapInArrow(_bit_places, "part int, bit int").repartition("part").sortWithinPartitions("part").mapInArrow(_filter_parts, "part int, bits binary").toPandas()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for part, bits in zip(parts["part"], parts["bits"]):
        out[part * FILTER_PART // 8 : (part + 1) * FILTER_PART // 8] = np.frombuffer(bits, np.uint8)
    return out


def _passes(anchors: np.ndarray, bits: np.ndarray) -> np.ndarray:
    one, two = (bits[b >> 3] & (128 >> (b & 7)).astype(np.uint8) for b in _bits(anchors))
    return (one > 0) & (two > 0)


def _digest(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


#: One row a text (key, n_words, sha), place of a suspect segment (key, a, seg), or different segment
#: of a task (seg, anchor, n, words).
SUSPECTS = "key long, n_words long, sha string, a int, seg binary, anchor long, n int, words binary"


@freeing
def _suspects(batches: Iterator[pa.RecordBatch], length: int, sent) -> Iterator[pa.RecordBatch]:
    bits = sent.value
    found: dict[bytes, list] = {}
    held = 0

    def flush() -> pa.RecordBatch:
        anchor, n, words = zip(*found.values())
        return _batch(SUSPECTS, seg=list(found), anchor=anchor, n=np.minimum(n, 2).astype(np.int32), words=words)

    for keys, words, hashes, lengths in _together(batches):
        joined = [b" ".join(w) for w in words]
        yield _batch(SUSPECTS, key=keys, n_words=lengths, sha=[hashlib.sha256(j).hexdigest() for j in joined])
        text, anchor, first, last = segments(hashes, lengths, length)
        if not len(anchor):
            continue
        suspect = _passes(anchor, bits)
        text, anchor, first, last = text[suspect], anchor[suspect], first[suspect], last[suspect]
        begins = np.concatenate([[0], np.cumsum(lengths)])
        # byte offsets of all words in their own text
        sizes = np.fromiter((len(w) + 1 for ws in words for w in ws), np.int64, int(begins[-1]))
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        zero = offsets[begins[text]]
        start, end = offsets[first] - zero, offsets[last + length] - zero - 1
        segs = []
        for t, x, a, b in zip(text.tolist(), anchor.tolist(), start.tolist(), end.tolist()):
            content = joined[t][a:b]
            seg = _digest(content)
            segs.append(seg)
            known = found.get(seg)
            if known:
                known[1] += 1
            else:
                found[seg] = [x, 1, content]
                held += len(content) + 200
        yield _batch(SUSPECTS, key=np.array(keys, object)[text].tolist(), a=(first - begins[text]).astype(np.int32), seg=segs)
        if held >= HELD_BYTES:
            yield flush()
            found, held = {}, 0
    if found:
        yield flush()


class SuffixAutomaton:
    """Of several sequences, each with a weight; knows the longest suffix with a weight of 2."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.weight = [-1], [0], [0]

    def _state(self, length: int, transitions: dict, link: int) -> int:
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        self.weight.append(0)
        return len(self.link) - 1

    def _split(self, p: int, c, q: int) -> int:
        """The state of p's longest string followed by c, taken out of q if need be."""
        nxt, link, length = self.next, self.link, self.length
        if length[q] == length[p] + 1:
            return q
        clone = self._state(length[p] + 1, dict(nxt[q]), link[q])
        link[q] = clone
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def add(self, sequence: list, weight: int) -> None:
        nxt, link, length, last = self.next, self.link, self.length, 0
        for c in sequence:
            q = nxt[last].get(c)
            if q is not None:
                last = self._split(last, c, q)
            else:
                state, p = self._state(length[last] + 1, {}, 0), last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = state
                    p = link[p]
                if p >= 0:
                    link[state] = self._split(p, c, nxt[p][c])
                last = state
            self.weight[last] += weight

    def finish(self) -> None:
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        for v in reversed(order):
            self.weight[self.link[v]] += self.weight[v]
        self.repeated = [0] * len(self.link)
        for v in order:
            self.repeated[v] = self.length[v] if self.weight[v] >= 2 else self.repeated[self.link[v]]

    def matching(self, sequence: list) -> Iterator[int]:
        """For each element, the longest repeated suffix that ends there."""
        state = 0
        for c in sequence:
            state = self.next[state][c]
            yield self.repeated[state]


def maximal_spans(automaton: SuffixAutomaton, sequence: list, length: int) -> list[tuple[int, int]]:
    """Half-open spans that repeated runs of at least ``length`` elements cover."""
    spans: list[list[int]] = []
    for end, match in enumerate(automaton.matching(sequence), 1):
        if match >= length:
            start = end - match
            while spans and spans[-1][0] >= start:
                spans.pop()
            if spans and spans[-1][1] >= start:
                spans[-1][1] = end
            else:
                spans.append([start, end])
    return [(a, b) for a, b in spans]


@freeing
def _shard_spans(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The repeated spans of each segment, from the automata of whole shards."""
    for group in sorted_groups(batches, "shard"):
        counts: dict[tuple[bytes, bytes], int] = {}
        for seg, n, words in zip(*(group.column(c).to_pylist() for c in ("seg", "n", "words"))):
            counts[seg, words] = counts.get((seg, words), 0) + n
        ids: dict[bytes, int] = {}
        automaton, texts = SuffixAutomaton(), []
        for (seg, words), n in counts.items():
            sequence = [ids.setdefault(w, len(ids)) for w in words.split(b" ")]
            automaton.add(sequence, min(n, 2))
            texts.append((seg, sequence))
        automaton.finish()
        rows = [(seg, s, e) for seg, sequence in texts for s, e in maximal_spans(automaton, sequence, length)]
        if rows:
            seg, s, e = zip(*rows)
            yield _batch("seg binary, s int, e int", seg=seg, s=s, e=e)


def _spans_by_shard(segs: DataFrame, length: int) -> DataFrame:
    """``seg, s, e`` from segments (seg, anchor, n, words) dealt to shards by anchor."""
    total = segs.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0]
    shards = max(1, int(segs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // SHARD_BYTES)
    dealt = segs.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int").alias("shard"), "seg", "n", "words")
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(lambda x: _shard_spans(x, length), "seg binary, s int, e int")


WINDOWS = "whole binary, at int, seg binary, anchor long, n int, words binary"


@freeing
def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The windows of segments: where each is, and each different one of a batch once."""
    for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
        places, found = [], {}
        for seg, n, words in zip(*(batch.column(i).to_pylist() for i in range(3))):
            words = words.split(b" ")
            for i in range(len(words) - length + 1):
                content = b" ".join(words[i : i + length])
                one = _digest(content)
                places.append((seg, i, one))
                known = found.setdefault(one, [content, 0])
                known[1] += n
        if places:
            whole, at, one = zip(*places)
            yield _batch(WINDOWS, whole=whole, at=at, seg=one)
            contents, n = zip(*found.values())
            yield _batch(WINDOWS, seg=list(found), anchor=[int.from_bytes(d[:8], "little", signed=True) for d in found], n=np.minimum(n, 2).astype(np.int32), words=contents)


def repeated_spans(suspects: DataFrame, length: int, most: int = SEGMENTS_PER_ANCHOR) -> DataFrame:
    """``key, s, e``: half-open word ranges of texts, which repeated windows cover."""
    segs = suspects.where("words IS NOT NULL").select("seg", "anchor", "n", "words")
    hot = materialize(segs.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > most).select("anchor"), "hot")
    if hot.isEmpty():
        spans = _spans_by_shard(segs, length)
    else:
        hot = small_side(hot)
        spans = _spans_by_shard(segs.join(hot, "anchor", "left_anti"), length)
        # each different segment is cut into windows once, wherever it occurs, by evenly loaded tasks
        crowded = segs.join(hot, "anchor", "left_semi").groupBy("seg").agg(F.sum("n").alias("n"), F.first("words").alias("words"))
        windows = materialize(crowded.mapInArrow(lambda x: _windows(x, length), WINDOWS), "windows")
        single = _spans_by_shard(windows.where("words IS NOT NULL").select("seg", "anchor", "n", "words"), length).select("seg").distinct()
        places = windows.where("at IS NOT NULL").select("whole", "at", "seg")
        spans = spans.unionByName(places.join(single, "seg").select(F.col("whole").alias("seg"), F.col("at").alias("s"), (F.col("at") + length).alias("e")))
    by_seg = materialize(spans.groupBy("seg").agg(F.collect_list(F.struct("s", "e")).alias("x")), "segment-spans")
    placed = suspects.where("a IS NOT NULL").select("key", "a", "seg").join(by_seg, "seg").select("key", "a", F.explode("x").alias("x"))
    return placed.select("key", (F.col("a") + F.col("x.s")).alias("s"), (F.col("a") + F.col("x.e")).alias("e"))


KEPT = "key long, n_removed long, kept_sha string, kept_text string, spans array<struct<s:int,e:int>>"
_KEPT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))]


@freeing
def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in KEPT.split(", ")]
    for batch in (b.slice(i, 200) for b in batches for i in range(0, b.num_rows, 200)):
        out = []
        for key, text, starts, ends in zip(*(batch.column(i) for i in range(4))):
            words = ascii_words(text.as_py(), lower=False)
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, np.asarray(starts.as_py()), 1)
            np.add.at(edge, np.asarray(ends.as_py()), -1)
            gone = np.cumsum(edge[:-1]) > 0
            turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2)
            kept = b" ".join(w for w, x in zip(words, gone.tolist()) if not x)
            spans = [{"s": s, "e": e} for s, e in turns.tolist()]
            out.append((key.as_py(), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace"), spans))
        columns = list(zip(*out)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KEPT_TYPES)], names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = WINDOW, most: int = SEGMENTS_PER_ANCHOR) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256, spans, kept_text``.

    * A window of ``length`` words that also starts anywhere else (another row, or elsewhere in the
      same text) is repeated; every word that a repeated window covers goes. All windows are judged
      on the input. Shorter texts lose nothing. Null and empty texts have no words.
    * ``spans`` are the removed half-open word ranges, ``kept_text`` is null where nothing or
      everything went; a text that is copied whole loses all its words.
    * Windows are compared by their words. Only which segments are equal is told by 128-bit hashes,
      as is which texts are.
    * Rows with a null id, and repeated rows, count like others. An empty table gives no row.
    """
    if length < 1:
        raise ValueError("length must be positive")
    prints, classes, texts = distinct_texts(docs, id_col, text_col)
    seen = texts.mapInArrow(lambda x: _anchors(x, length), "anchor long, n int").groupBy("anchor").agg(F.sum("n").alias("n"))
    sent = docs.sparkSession.sparkContext.broadcast(anchor_filter(seen.where("n > 1").select("anchor")))
    suspects = materialize(texts.mapInArrow(lambda x: _suspects(x, length, sent), SUSPECTS), "suspects")
    by_key = repeated_spans(suspects, length, most).groupBy("key").agg(F.collect_list("s").alias("s"), F.collect_list("e").alias("e"))
    # texts of any length, so no count bounds a broadcast of either side
    changed = materialize(texts.hint("merge").join(by_key, "key").select("key", "text", "s", "e").mapInArrow(_kept, KEPT).dropDuplicates(["key"]), "changed")
    meta = suspects.where("n_words IS NOT NULL").select("key", "n_words", "sha").dropDuplicates(["key"])
    gone = (F.col("rows") > 1) & (F.col("n_words") >= length)

    def unless_gone(whole: Column, else_: Column) -> Column:
        return F.when(gone, whole).otherwise(else_)

    known = classes.join(meta, "key").join(changed, "key", "left").select(
        "h",
        "n_words",
        unless_gone(F.col("n_words"), F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        unless_gone(F.lit(EMPTY_SHA256), F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        unless_gone(F.array(F.struct(F.lit(0).alias("s"), F.col("n_words").cast("int").alias("e"))), F.col("spans")).alias("spans"),
        F.when(~gone, F.col("kept_text")).alias("kept_text"),
    )
    return prints.join(known, "h").select(F.col("doc").alias("doc_id"), "n_words", "n_removed", "kept_sha256", "spans", "kept_text")


def op7_suffix_automata(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES = {"op7_suffix_automata": op7_suffix_automata}
ORACLE: dict[str, str] = {
    "op7_suffix_automata": r"""
        WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        windows AS (SELECT r, p, array_to_string(w[p : p + 34], ' ') AS words FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d)),
        repeated AS (SELECT r, p FROM windows QUALIFY count(*) OVER (PARTITION BY words) > 1),
        words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
        marked AS (SELECT words.r, words.p, word, max(repeated.p) OVER (PARTITION BY words.r ORDER BY words.p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
                   FROM words LEFT JOIN repeated ON repeated.r = words.r AND repeated.p = words.p),
        kept AS (SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS t FROM marked GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
    """
}
