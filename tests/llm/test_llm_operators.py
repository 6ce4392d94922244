"""Operators against brute force, with the odd rows that tables may hold."""

import math
import random
import zlib
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h string, key string, t string, doc string, n string, id string, size string, word string"


def frame(spark, rows):
    """Documents with columns that clash with the operators' own names."""
    return spark.createDataFrame([(i, t, lang, "src", None, "x", None, "y", "z", "1", "i", None, "w") for i, t, lang in rows], DOCS)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{int(rng.random() ** 3 * vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated rows, null ids."""
    passage = prose(99, 80)
    base = prose(1, 300)
    near = base.split()
    near[150] = "changed"
    rows = [(i, prose(i, 60 + 13 * i), ["en", "de", None][i % 3]) for i in range(2, 24)]
    rows += [(50, base, "en"), (51, base, "en"), (52, " ".join(near), "en"), (53, base.upper(), "de")]
    rows += [(60, prose(60, 40) + " " + passage + " " + prose(61, 30), "en"), (61, prose(62, 55) + "\n" + passage, "en"), (62, passage + " " + passage, "de")]
    rows += [(70, None, "en"), (71, "", None), (72, " \t\n", "en"), (73, "one", "en"), (74, "one two", "en"), (75, "one  two", "de"), (76, "1234 5678", "en"), (77, "½ ² ① __", "en")]
    rows += [(80, prose(80, 30_000), "en"), (81, "a" * 5000 + " b", "en"), (82, "é ü ß x\x1c\u0000y <|endoftext|> 'll", "fr")]
    rows += [(90, prose(90, 100), "en"), (90, prose(90, 100), "en"), (None, base, "en"), (None, prose(91, 90), None), (None, None, None)]
    return rows


def result(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, odd_rows, keep, weak):
    from quillmesh.llm.exact_dedup import content_hash, exact_duplicates

    # the weak fingerprint makes most texts collide: bytes decide
    print_of = (lambda t: (F.length(t) % 3).cast("string").cast("binary")) if weak else content_hash
    got = exact_duplicates(frame(spark, odd_rows), keep=keep, fingerprint=print_of)
    groups = {}
    for i, t, _ in odd_rows:
        groups.setdefault(t or "", []).append(i)
    best = max if keep == "largest" else min
    want = []
    for i, t, _ in odd_rows:
        ids = groups[t or ""]
        known = [x for x in ids if x is not None]
        k = best(known) if known else None
        want.append((i, k, len(ids), i == k))
    assert result(got, "doc_id", "keep_id", "group_size", "kept") == sorted(want, key=repr)


@pytest.mark.parametrize("k,num", [(3, 90), (5, 80), (1, 50)])
def test_near_duplicates(spark, odd_rows, k, num):
    from quillmesh.llm.sketch_join import near_duplicates

    # one id under several texts: rows link by their text
    rows = odd_rows + [(400, odd_rows[2][1], "en"), (400, prose(401, 70), "en"), (402, prose(401, 70).upper(), "en"), (403, prose(401, 70), "en"), (None, prose(401, 70), "en")]
    got = near_duplicates(frame(spark, rows), k=k, num=num, den=100)
    want = brute.components({i: r[1] for i, r in enumerate(rows)}, k, num, 100)
    least = {}
    for i, (_, root) in want.items():
        least[root] = min((x for x in (least.get(root), rows[i][0]) if x is not None), default=None)
    expected = [(d, want[i][0], least[want[i][1]] if want[i][0] else d) for i, (d, _, _) in enumerate(rows)]
    assert result(got, "doc_id", "n_shingles", "component_id") == sorted(expected, key=repr)


def test_near_duplicates_of_a_large_near_group(spark, monkeypatch):
    """Edits of one text that are further from each other than from it: links chain through it."""
    from quillmesh.llm import sketch_join

    monkeypatch.setattr(sketch_join, "GROUP_BLOCK", 16)
    rng, base = random.Random(5), prose(7, 120, 5000).split()
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(w), "en"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in sketch_join.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute.components({i: t for i, t, _ in rows}, 3, 90, 100)


def test_block_keys_meet_for_linked_sets():
    import numpy as np
    from quillmesh.llm.sketch_join import Bands, block_keys

    rng = np.random.default_rng(0)
    for num in (50, 80, 90):
        bands = Bands(num, 100)
        for n in [1, 2, 5, 9, 10, 17, 30, 64, 200, 999]:
            for _ in range(20):
                a = rng.integers(0, 2**63, n, dtype=np.uint64)
                drop = rng.integers(0, bands.differ(n) + 1)
                b = np.concatenate([a[drop:], rng.integers(0, 2**63, rng.integers(0, 3), dtype=np.uint64)])
                both = len(np.intersect1d(a, b))
                if len(b) and both * 100 >= num * (len(a) + len(b) - both):
                    assert len(np.intersect1d(block_keys(np.unique(a), bands), block_keys(np.unique(b), bands)))


@pytest.mark.parametrize("length,most", [(35, 512), (35, 1), (3, 512), (3, 2), (1, 512)])
def test_substring_removal(spark, odd_rows, length, most):
    from quillmesh.llm.substrings import remove_repeats

    got = remove_repeats(frame(spark, odd_rows), length=length, most=most)
    want = brute.without_repeats([t for _, t, _ in odd_rows], length)
    assert result(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(((i, *w) for (i, _, _), w in zip(odd_rows, want)), key=repr)


def test_suffix_automaton_matches_brute_force():
    from quillmesh.llm.substrings import SuffixAutomaton

    rng = random.Random(3)
    for _ in range(200):
        texts = [([rng.randrange(3) for _ in range(rng.randrange(1, 14))], rng.choice([1, 1, 2])) for _ in range(rng.randrange(1, 5))]
        count = Counter()
        for t, w in texts:
            for a in range(len(t)):
                for b in range(a + 1, len(t) + 1):
                    count[tuple(t[a:b])] += w
        automaton = SuffixAutomaton()
        for t, w in texts:
            automaton.add(t, w)
        automaton.finish()
        for t, _ in texts:
            want = [max((e - a for a in range(e) if count[tuple(t[a:e])] >= 2), default=0) for e in range(1, len(t) + 1)]
            assert list(automaton.matching(t)) == want


def test_packing(spark, odd_rows):
    import numpy as np
    import public_tokenizers
    from quillmesh.llm.packing import pack_documents
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {}
    for i, t, _ in odd_rows:
        ids.setdefault(i, []).append(exact.encode(t or "", add_special_tokens=False).ids + [1])
    rows = [r.asDict() for r in pack_documents(frame(spark, odd_rows)).collect()]
    pieces = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    for i, every in ids.items():
        for tokens in every:
            own, at = [p for p in pieces if p[0] == i and p[4] == len(tokens) and pieces[p] > 0], 0
            while at < len(tokens):
                piece = next(p for p in own if p[1] == at and p[3] == zlib.crc32(np.array(tokens[at : at + p[2]], "<u4").tobytes()) and pieces[p] > 0)
                pieces[piece] -= 1
                at += piece[2]
            assert at == len(tokens)
    assert not +pieces
    padding = total = 0
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 2048
        total += end
        padding += 0 if end & (end - 1) == 0 else 2048 - end
    assert padding <= 2048 + 0.03 * total


def test_ids_of_any_white_space():
    import public_tokenizers
    from quillmesh.llm.packing import encoder
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(5)
    signs = ["a", "b", "word", "'s", "7", "é", ".", " ", " ", "\n", "\t", "\u00a0", "\u0085", "\u2003", "\u3000", "\r", "\x1c", "\v"]
    texts = ["a\n\u00a0\nb\tc", *("".join(rng.choices(signs, k=rng.randint(0, 9))) for _ in range(100_000))]
    for text, want in zip(texts, exact.encode_batch(texts, add_special_tokens=False)):
        assert own.encode(text) == b"".join(i.to_bytes(4, "little") for i in want.ids), repr(text)


def test_cut_is_whole():
    from quillmesh.llm.packing import cut

    for n in range(1, 5000):
        pieces = cut(n)
        assert sum(pieces) == n and all(0 < p <= 2048 for p in pieces) and (n < 64 or min(pieces) >= 64)


def test_sharding(spark, odd_rows):
    from quillmesh.llm.sharding import shard_by_bytes

    rows = odd_rows + [(1000 + i, prose(i, 50), "en") for i in range(800)] + [(3000 + i, "the same text", "en") for i in range(400)]
    got = shard_by_bytes(frame(spark, rows)).collect()
    want = sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows if i is not None)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got if r.doc_id is not None) == want
    assert len(got) == len(rows)
    sizes, slots = Counter(), {}
    for r in got:
        assert 0 <= r.shard < 24 and r.law == "bytes" and r.grown_shard is None
        sizes[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    share, largest = sum(sizes.values()) / 24, max(r["size"] for r in got)
    assert all(abs(sizes[s] - share) <= largest + 0.08 * share for s in range(24))


def test_brown_scores(spark, odd_rows):
    from quillmesh.llm.brown import END, class_model_scores

    rows = odd_rows + [(200 + i, prose(300 + i, 200), "en") for i in range(40)]
    got = class_model_scores(frame(spark, rows), core=64, classes=8, least_share=0.0005).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    tokens = [(i, [*brute.words(t), END]) for i, t, _ in rows]
    count = Counter(w for i, ws in tokens if not held(i) for w in ws)
    total, kinds = sum(count.values()), len(count)
    want = sorted(((i, held(i), len(ws), sum(w in count for w in ws), total, round(sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws), 5)) for i, ws in tokens), key=repr)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got), key=repr) == want
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_nothing_is_known_without_training_rows(spark):
    from quillmesh.llm.brown import class_model_scores

    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    got = class_model_scores(frame(spark, [(i, ["one two", None, ""][i % 3], "en") for i in held])).collect()
    assert {(r.n_known, r.train_tokens) for r in got} == {(0, 0)} and len(got) == len(held)


def test_brown_scores_equal_brute_force(spark, odd_rows):
    """Scores from dicts of class counts, given the classes; each context's probabilities sum to one."""
    from quillmesh.llm import brown

    train = [t for _, t, _ in odd_rows if t is not None and len(t) < 50_000]
    scored = train[:12] + ["never seen words", "w1 never w2 never", "", None]
    model, others, x = brown.train(spark.createDataFrame([(t,) for t in train], "text string"), core=32, classes=6, least_share=0.002)
    count = Counter(w for t in train for w in [*brute.words(t), brown.END])
    dictionary, rare = {w: int(model.classes[i]) for w, i in model.ids.items()}, x["rare"]
    table = {bytes(r.word): (r.c, r["class"]) for r in others.collect()}
    assert len(dictionary) > 32 and {w: c for w, (c, _) in table.items()} == {w: c for w, c in count.items() if w not in dictionary}
    assert all((k == rare) == (c < brown.LEAST_COUNT) for c, k in table.values()) and any(k != rare for _, k in table.values())
    history = lambda w: dictionary.get(w, rare)
    own = lambda w: dictionary[w] if w in dictionary else table[w][1] if w in table else rare
    cells, tokens = Counter(), Counter()
    for t in train:
        ws = [brown.END, *brute.words(t), brown.END]
        cells.update((history(v), own(w)) for v, w in zip(ws, ws[1:]))
    for w, c in count.items():
        tokens[own(w)] += c
    n, all_cells = rare + 1, sum(cells.values())
    share = {b: (sum(cells[a, b] for a in range(n)) + 0.5) / (all_cells + 0.5 * n) if tokens[b] or b == rare else 0.0 for b in range(n)}
    total_share = sum(share.values())

    def move(a, b):
        return (cells[a, b] + brown.TRANSITION_PRIOR * share[b] / total_share) / (sum(cells[a, k] for k in range(n)) + brown.TRANSITION_PRIOR)

    rares = [c for c, k in table.values() if k == rare]
    once, twice = rares.count(1), rares.count(2)
    cut = (once + 0.5) / (once + 2 * twice + 1)

    def emit(w):
        if own(w) != rare:
            return count[w] / tokens[own(w)]
        return (count[w] - cut if w in count else cut * len(rares)) / sum(rares)

    texts = spark.createDataFrame(list(enumerate(scored)), "key long, text string")
    got = {r.key: r.score for r in brown.score_texts(texts, model, others, x).collect()}
    for i, t in enumerate(scored):
        ws = [brown.END, *brute.words(t), brown.END]
        assert got[i] == pytest.approx(sum(math.log10(move(history(v), own(w)) * emit(w)) for v, w in zip(ws, ws[1:])), abs=1e-6)
    for a in range(n):
        assert sum(move(a, own(w)) * emit(w) for w in count) + move(a, rare) * emit(b"never seen") == pytest.approx(1, abs=1e-9)


def test_exchange_finds_the_classes():
    import numpy as np
    from quillmesh.llm.brown import exchange

    # two languages of words that follow their own kind
    rng = np.random.default_rng(1)
    kind = np.array([0, 1] * 10)
    bigrams = np.where(kind[:, None] == kind[None, :], 50, 1) + rng.integers(0, 3, (20, 20))
    found = exchange(bigrams.astype(float), 2)
    assert len({(k, c) for k, c in zip(kind, found)}) == 2


def test_exchange_rounds_raise_the_likelihood(spark):
    """Words of two kinds, of which only some have a class at first; each round moves all of them."""
    import numpy as np
    from quillmesh.llm.brown import exchange_round

    rng = np.random.default_rng(2)
    words, classes = 60, 2
    ids = [0]
    for _ in range(6000):
        kind = (ids[-1] % 2) ^ (rng.random() < 0.1)
        ids.append(1 + 2 * int(rng.integers(words // 2)) - (1 - kind))
    ids = np.array(ids) % words
    rows = [(bytearray(part.astype(np.int32).tobytes()),) for part in np.array_split(ids, 7)]
    encoded = spark.createDataFrame(rows, "ids binary")
    c = np.bincount(ids, minlength=words).astype(float)
    word_class = np.full(words + 1, -1, np.int64)
    word_class[:10], word_class[words] = np.arange(10) % 2, classes
    word_class[4] = 1  # one of the seeds is wrong
    for _ in range(2):
        word_class = exchange_round(encoded, classes, word_class, c)
    even, odd = word_class[0:words:2], word_class[1:words:2]
    assert np.mean(even == np.bincount(even).argmax()) > 0.95 and np.mean(odd == np.bincount(odd).argmax()) > 0.95
    assert np.bincount(even).argmax() != np.bincount(odd).argmax()


def test_texts_of_megabytes(spark):
    from quillmesh.llm import decontaminate, language, sketch_join, substrings

    long, near = prose(1, 500_000, 200_000), None
    words = long.split()
    near = " ".join(words[:499_000] + ["other"] * 5)
    rows = [(1, long, "en"), (2, near, "en"), (3, " ".join(words[1000:1060]), "en"), (4, "x" * 30_000, "en")]
    docs = frame(spark, rows)
    linked = {r.doc_id: r.component_id for r in sketch_join.near_duplicates(docs).collect()}
    assert linked == {1: 1, 2: 1, 3: 3, 4: 4}
    removed = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.remove_repeats(docs).collect()}
    assert removed[1] == (500_000, 499_000) and removed[2] == (499_005, 499_000) and removed[3] == (60, 60) and removed[4] == (1, 0)
    found = decontaminate.contaminated(docs, spark.createDataFrame([(7, rows[2][1])], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 7), (2, 7), (3, 7)}
    assert len(language.identify(docs).collect()) == 4


def test_language(spark, odd_rows, tables):
    from quillmesh.llm.language import identify

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    known = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = identify(docs).collect()
    assert all(r.lang_pred == known[r.doc_id] and 0 <= r.score <= 1 for r in got if r.held_out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    odd = identify(frame(spark, odd_rows)).collect()
    assert len(odd) == len(odd_rows)
    silent = {i for i, t, _ in odd_rows if i is not None and not any(c.isalpha() for c in t or "")}
    assert {r.doc_id for r in odd if r.lang_pred == "und" and r.doc_id is not None} == silent


def segmentations(word, pieces):
    """All ways to cut a word into pieces or, where no piece is a character, that character alone."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces or n == 1:
            yield from ([word[:n], *rest] for rest in segmentations(word[n:], pieces))


@pytest.mark.parametrize("plain", [32, 0])
def test_lattice_sums_all_segmentations(monkeypatch, plain):
    import numpy as np
    from quillmesh.llm import language

    monkeypatch.setattr(language, "PLAIN_LENGTH", plain)
    pieces = ["a", "b", "ab", "aba", "ba", "abaabbaaba"]
    probs = np.append(np.array([0.1, 0.2, 0.3, 0.1, 0.2, 0.1]), 0.0)
    p_of = dict(zip(pieces, probs))
    p = lambda cut: math.prod(p_of.get(x, language.UNCOVERED) for x in cut)
    words = ["a", "ab", "abab", "babax", "aabbaabab", "xabaabbaaba"]
    found = language.Lattice(pieces)
    got = found.log_likelihoods(words, probs[:, None])[:, 0]
    assert np.allclose(got, [math.log(sum(map(p, segmentations(w, pieces)))) for w in words])
    # the expectation step: uses of each piece, weighted by the share of each segmentation
    counts, want = np.array([3.0, 1, 2, 5, 1, 4]), Counter()
    for w, c in zip(words, counts):
        cuts = list(segmentations(w, pieces))
        for cut in cuts:
            for x in cut:
                want[x] += c * p(cut) / sum(map(p, cuts))
    assert np.allclose(found.expected(words, counts, probs)[:-1], [want[x] for x in pieces])


def test_words_of_small_batches_are_summed_together(monkeypatch):
    import numpy as np
    import pyarrow as pa
    from quillmesh.llm import language

    found = language.Lattice(["a", "aa", "ab", "b", "▁a"])
    probs = np.vstack([np.full((5, 2), 0.2), np.zeros(2)])
    words = [("▁" + f"{i:b}".replace("0", "a").replace("1", "b"), i % 2, 1 + i % 3) for i in range(400)]
    batches = [pa.RecordBatch.from_arrays([pa.array([f"l{lang}"]), pa.array([word]), pa.array([c])], ["lang", "word", "c"]) for word, lang, c in words]
    monkeypatch.setattr(language, "lattice", lambda path: found)
    calls, whole = [], found.expected
    monkeypatch.setattr(found, "expected", lambda *a: calls.append(1) or whole(*a))
    sent = type("Sent", (), {"value": probs})
    got = pa.Table.from_batches(list(language._expectations(iter(batches), "", ["l0", "l1"], sent))).to_pylist()
    want = np.zeros((2, 6))
    for word, lang, c in words:
        want[lang] += whole([word], np.array([float(c)]), probs[:, lang])
    assert np.allclose([want[r["i"], r["piece"]] for r in got], [r["e"] for r in got]) and len(got) == np.count_nonzero(want[:, :-1])
    assert len(calls) == 2


def test_prefixes_are_found_by_hash():
    import numpy as np
    from quillmesh.llm.language import Lattice

    rng = random.Random(2)
    found = Lattice(["".join(rng.choices("abcdé", k=rng.randint(1, 6))) for _ in range(3000)])
    some = np.concatenate([found.hashes, found.hashes + np.uint64(1), np.arange(2000, dtype=np.uint64)])
    place = {h: i for i, h in enumerate(found.hashes.tolist())}
    assert found._places(some).tolist() == [place.get(h, -1) for h in some.tolist()]



def test_long_words_are_scored_whole():
    import numpy as np
    from quillmesh.llm.language import Lattice

    found, probs = Lattice(["a", "aa"]), np.array([[0.5], [0.25], [0.0]])
    # f(n) = f(n - 1) / 2 + f(n - 2) / 4, by logarithms
    f = [0.0, math.log(0.5)]
    for _ in range(5000):
        f.append(np.logaddexp(f[-1] + math.log(0.5), f[-2] + math.log(0.25)))
    assert found.log_likelihoods(["a" * 5000], probs)[0, 0] == pytest.approx(f[5000])


def test_quality(spark, tables):
    from quillmesh.llm.quality import quality

    docs, labels = (spark.read.parquet(f"{tables}/{n}.parquet") for n in ("documents", "labels"))
    got = {r.doc_id: r.keep for r in quality(docs, labels).collect()}
    good = [r.doc_id for r in labels.where("quality = 1 AND toxic = 0").collect()]
    bad = [r.doc_id for r in labels.where("quality = 0").collect()]
    assert sum(got[i] for i in good) >= 0.98 * len(good)
    assert sum(got[i] for i in bad) <= 0.4 * len(bad)


def test_quality_threshold_is_the_quantile_of_unseen_texts(spark, tables):
    from quillmesh.llm.quality import quality, trusted_ids

    docs, labels = (spark.read.parquet(f"{tables.replace('sf0.001', 'sf0.01')}/{n}.parquet") for n in ("documents", "labels"))
    trusted = {r.doc_id for r in trusted_ids(labels).collect()}
    hidden = {i for i in trusted if zlib.crc32(b"%d" % i) % 5 == 0}
    got = quality(docs, labels.where(~F.col("doc_id").isin(*hidden))).collect()
    highest = max(r.score / r.threshold for r in got if r.doc_id in trusted - hidden)
    assert 0.99 <= highest <= 1.2
    assert sum(not r.keep for r in got if r.doc_id in hidden) <= 0.06 * len(hidden)
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert sum(r.keep for r in got if r.doc_id in bad) <= 0.02 * len(bad)


def test_quality_of_odd_rows(spark, odd_rows):
    from quillmesh.llm.quality import quality

    docs = frame(spark, odd_rows)
    labels = spark.createDataFrame([(i, 1, None) for i in range(2, 24)] + [(None, 1, 0), (50, None, None), (51, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality(docs, labels).collect()
    assert len(got) == len(odd_rows)
    assert all(not r.keep and r.perplexity is None for r in got if r.doc_id in (70, 71, 72))
    assert all(r.keep for r in got if r.doc_id in range(2, 24))
    unlabelled = quality(docs, labels.limit(0)).collect()
    assert all(r.keep == (r.symbols > 0) for r in unlabelled)


def test_kneser_ney_is_a_distribution(spark):
    import numpy as np
    from quillmesh.llm.quality import CHARACTERS, fit, score_units

    texts = spark.createDataFrame([("the cat the hat that cat",), ("a hat. the end",)], "text string")
    model = fit(texts)
    # next symbols after "the" at a text's start: units differ in their last symbol alone
    alphabet = sorted(set("the cat that hat. a end"))
    ends = [f"\n th{c}" for c in alphabet]
    logs = score_units(ends, model) - score_units(["\n th"], model)
    other = np.exp(score_units(["\n thé"], model) - score_units(["\n th"], model))[0]
    assert np.exp(logs).sum() + (CHARACTERS - len(alphabet)) * other == pytest.approx(1, abs=1e-3)


def kneser_ney(texts, order, characters, units):
    """p(symbol, context) of an interpolated modified Kneser-Ney model, by recursion over dicts."""
    raw = Counter()
    for text in texts:
        for u in units(text):
            for end in range(3, len(u) + 1):
                raw[u[max(0, end - order) : end]] += 1
    counts = {order: {g: c for g, c in raw.items() if len(g) == order}}
    for n in range(order - 1, 0, -1):
        lower = Counter(g[1:] for g in counts[n + 1])
        lower.update({g: c for g, c in raw.items() if len(g) == n})
        counts[n] = dict(lower)
    cuts, totals, weights = {}, {}, {}
    for n, table in counts.items():
        n1, n2, n3, n4 = (sum(a == i for a in table.values()) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        cuts[n] = [max(0.1, min(i - 0.1, i - (i + 1) * y * up / here)) if here and up else 0.5 for i, here, up in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        for g, a in table.items():
            totals[g[:-1]] = totals.get(g[:-1], 0) + a
            weights[g[:-1]] = weights.get(g[:-1], 0.0) + cuts[n][min(a, 3) - 1]

    def p(symbol, context):
        below = p(symbol, context[1:]) if context else 1 / characters
        if context not in totals:
            return below
        a = counts[len(context) + 1].get(context + symbol, 0)
        seen = a - cuts[len(context) + 1][min(a, 3) - 1] if a else 0.0
        return seen / totals[context] + weights[context] / totals[context] * below

    return p


def test_perplexity_equals_brute_force(spark, odd_rows, monkeypatch):
    from quillmesh.llm import quality as q

    monkeypatch.setattr(q, "LEARNED_SHARE", 1.0)
    rows = odd_rows + [(500 + i, prose(900 + i, 60, 60), "en") for i in range(12)]
    trusted = {*range(2, 10), *range(500, 508), 82}
    labels = spark.createDataFrame([(i, 1, 0) for i in trusted], "doc_id long, quality int, toxic int")
    p = kneser_ney([t for i, t, _ in rows if i in trusted], q.ORDER, q.CHARACTERS, q.units)
    got = Counter()
    for r in q.quality(frame(spark, rows), labels).collect():
        got[r.doc_id, r.lang, r.symbols, None if r.perplexity is None else f"{r.perplexity:.4g}"] += 1
    want = Counter()
    for i, t, lang in rows:
        us = q.units(t or "")
        logs = [math.log(p(u[e - 1], u[max(0, e - q.ORDER) : e - 1])) for u in us for e in range(3, len(u) + 1)]
        want[i, lang, len(logs), f"{math.exp(-sum(logs) / len(logs)):.4g}" if logs else None] += 1
    assert got == want


def test_contamination(spark, odd_rows):
    from quillmesh.llm.decontaminate import contaminated

    rng = random.Random(8)
    items = [(i, prose(500 + i, 25, 3000)) for i in range(12)] + [(20, None), (21, ""), (None, prose(501, 25, 3000)), (22, prose(505, 25, 3000))]
    planted = []
    for i in range(12):
        w = items[i][1].split()
        if i % 3 == 1:
            w[rng.randrange(len(w))] = "other"
        if i % 3 == 2:
            w = [x for j, x in enumerate(w) if j % 6 != 5]
        text = f"{prose(700 + i, 20 + 31 * i, 3000)} {' '.join(w).upper()}, {prose(800 + i, 40, 3000)}"
        planted.append((5000 + i, text, "en"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = contaminated(frame(spark, odd_rows + planted), benchmark)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(5000 + i, i) for i in range(12)} | {(5005, 22)}


def test_contamination_by_long_passages(spark, odd_rows):
    from quillmesh.llm.decontaminate import contaminated

    items = [(n, prose(900 + n, n, 3000)) for n in (48, 49, 100, 160, 200, 1000, 13_000)]
    planted = []
    for n, text in items:
        words = text.split()
        changes = [words, ["other" if j % 4 == 3 else w for j, w in enumerate(words)], [w for j, w in enumerate(words) if j % 4 != 3]]
        for i, changed in enumerate(changes):
            planted.append((10 * n + i, f"{prose(50_000 + n + i, 77, 3000)} {' '.join(changed)} {prose(70_000 + n + i, 50, 3000)}", "en"))
    others = [(900_000 + i, prose(2000 + i, 40 * (i + 1), 3000), "en") for i in range(60)]
    got = contaminated(frame(spark, odd_rows + planted + others), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == sorted((10 * n + i, n) for n, _ in items for i in range(3))
    assert all(r.passage_share > 0.99 for r in got if r.doc_id % 10 == 0)


def test_retrieval_finds_what_exhaustive_comparison_finds(spark):
    """Paraphrases of 300 passages (words replaced, left out, moved, answers only in part) in a space
    of 64 dimensions against the decision at every place of every text for every passage."""
    from quillmesh.llm import decontaminate as d

    rng = random.Random(11)
    items = [(i, prose(3000 + i, rng.randrange(15, 60), 20_000) + ". " + prose(4000 + i, 9, 20_000)) for i in range(300)]
    rows = []
    for i, text in items:
        w = text.split()
        kind = i % 5
        if kind == 1:
            w = [f"x{j}" if rng.random() < 0.3 else v for j, v in enumerate(w)]
        if kind == 2:
            w = [v for v in w if rng.random() > 0.35]
        if kind == 3:
            w = [v for j in range(0, len(w), 4) for v in sorted(w[j : j + 4], key=lambda _: rng.random())]
        if kind == 4:
            w = w[len(w) // 2 :]
        rows.append((i, f"{prose(5000 + i, rng.randrange(150), 20_000)} {' '.join(w)} {prose(6000 + i, rng.randrange(150), 20_000)}", "en"))
    docs, benchmark = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    texts = docs.selectExpr("text", "1L AS rows")
    space = d.latent_space(benchmark, texts, len(rows), "item_id", "text")
    assert space.vectors.shape[1] == 64 and len(space.lengths) > 300
    want = set()
    for i, text, _ in rows:
        words = d.words_of(text)
        for passage in space.passages:
            if any(d.decide(passage, words[slice(*d.region_of(passage, start, len(words)))]) for start in range(0, len(words) + 1, d.STRIDE)):
                want.add((i, passage.item))
    got = {(r.doc_id, r.item_id) for r in d.contaminated(docs, benchmark).collect()}
    assert len(want) > 150 and got <= want and len(got) >= 0.9 * len(want)


def test_weighted_lcs_and_answers():
    import numpy as np
    from quillmesh.llm.decontaminate import answer_of, weighted_lcs

    rng = random.Random(4)
    for _ in range(100):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(1, 12))] for _ in range(2))
        weights = np.array([rng.random() for _ in a])
        best = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, v in enumerate(a):
            for j, w in enumerate(b):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weights[i] if v == w else 0.0)
        assert weighted_lcs(a, b, weights) == pytest.approx(best[-1][-1])
    assert answer_of("What is it? The answer is B! Ok.") == ["the", "answer", "is", "b"]
    assert answer_of("one two three four five six seven eight nine ten") == "three four five six seven eight nine ten".split()
    assert answer_of(None) == []


def test_benchmarks_are_searched_in_groups(spark, monkeypatch):
    from quillmesh.llm import decontaminate as d

    items = [(i, prose(500 + i, 30, 3000)) for i in range(30)]
    docs = frame(spark, [(i, f"{prose(i, 60, 3000)} {t}", "en") for i, t in items])
    monkeypatch.setattr(d, "PASSAGES_TOGETHER", 10)
    got = d.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, i) for i in range(30)}


def test_latent_space_keeps_inner_products(spark):
    import numpy as np
    from quillmesh.llm.decontaminate import randomised_svd

    rng = np.random.default_rng(2)
    dense = np.where(rng.random((30, 200)) < 0.1, rng.random((30, 200)), 0.0)
    rows = spark.createDataFrame([(np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist()) for r in dense], "ids array<int>, values array<double>")
    space = randomised_svd(rows, 200, 30)
    probe = rng.random(200)
    assert np.allclose((dense @ space) @ (space.T @ probe), dense @ probe, atol=1e-6)
    best = np.linalg.svd(dense, compute_uv=False)
    low = randomised_svd(rows, 200, 5)
    assert low.shape[1] == 5
    assert np.linalg.norm(dense @ low) >= 0.97 * np.linalg.norm(best[:5])


def test_warc_round_trip(spark, tmp_path):
    from quillmesh.llm.warc import read_warc, write_warc

    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    long = "<p>é</p>" * 300
    pages = [(1, "http://a/", long), (2, None, long), (3, "http://b/\r\nX: y", fake), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", "x" * 999 + "é"), (9, "u", long), (10, "u", fake * 40), (11, "u", fake * 40 + "WARC/1.1\r\n")]
    df = spark.createDataFrame([(i, u, h, "x") for i, u, h in pages], "page_id long, url string, html string, t string").repartition(3)
    write_warc(df, str(tmp_path / "w"), records_per_file=4)
    got = read_warc(spark, str(tmp_path / "w")).collect()
    import hashlib

    want = []
    for i, _, h in pages:
        data = (h or "").encode()
        last = max((j for j, _, g in pages if (g or "") == (h or "") and j is not None), default=None)
        again = len(data) >= 1000 and last is not None and (i is None or i < last)
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", last if again else None, True))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.intact) for r in got), key=repr) == sorted(want, key=repr)


def test_warc_of_another_writer(spark, tmp_path):
    import base64
    import hashlib

    from quillmesh.llm.warc import read_warc

    digest = base64.b32encode(hashlib.sha1(b"abc").digest()).decode()
    block = "HTTP/1.1 200 OK\r\nX: y\r\n\r\nabc"
    first = "WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    second = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:2>\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n{block}\r\n\r\n"
    (tmp_path / "x.warc").write_bytes((first + second).encode())
    got = sorted(read_warc(spark, str(tmp_path)).collect(), key=lambda r: r.off)
    assert [(r.record_type, r.page_id, r.payload_bytes, r.intact) for r in got] == [("warcinfo", None, 0, True), ("response", None, 3, True)]
    assert got[1].payload_digest == hashlib.sha1(b"abc").hexdigest()


def test_empty_tables(spark, tmp_path):
    from quillmesh.llm import brown, decontaminate, exact_dedup, language, packing, quality, sharding, sketch_join, substrings, warc

    docs = frame(spark, []).cache()
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    for got in (
        exact_dedup.exact_duplicates(docs),
        sketch_join.near_duplicates(docs),
        substrings.remove_repeats(docs),
        packing.pack_documents(docs),
        sharding.shard_by_bytes(docs),
        language.identify(docs),
        brown.class_model_scores(docs),
        quality.quality(docs, labels),
        decontaminate.contaminated(docs, benchmark),
    ):
        assert got.count() == 0
    assert decontaminate.contaminated(frame(spark, [(1, "a b c", "en")]), benchmark).count() == 0
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 0
