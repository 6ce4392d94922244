"""URL filters, importance resampling and source divergence against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, rank string, words string, place string, weight string, part string, term string"


def frame(spark, rows):
    """Documents with columns that clash with the operators' own names."""
    return spark.createDataFrame([(i, t, lang, source, 1, *"abcdefg") for i, t, lang, source in rows], DOCS)


def prose(seed, n, vocabulary=300):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice(['Wort', 'mot', 'é', 'W'])}{'abcdefghij'[int(rng.random() ** 3 * 10)]}{'xyzuv'[rng.randrange(5)]}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(i, prose(i, rng.randint(0, 120)), rng.choice(["en", "de", None]), rng.choice(["a", "b", "ç", None])) for i in range(300)]
    out += [(400 + i, "the same text of more than twenty words " * 3, "en", "hot") for i in range(60)]
    out += [(7, prose(7, 60), "en", "a")] * 3 + [(None, prose(8, 60), "en", "a"), (None, prose(8, 60), "en", "a"), (None, None, None, None)]
    out += [(500, None, "en", "a"), (501, "", "en", "b"), (502, " \t\n.,;", "xx", "only"), (503, "x" * 100_000, "en", "a"), (504, "Aé-bÉ c\u0000d 12 ½", "en", "ç"), (505, prose(505, 60_000), "de", "long")]
    out += [(600 + i, "langeswort" * 30 + " und " + "y" * (3 * i), "lw", f"s{i % 3}") for i in range(9)]
    return out


def lowered(text):
    return (text or "").encode().translate(brute.ASCII_LOWER).decode()


# --- operator 12 --------------------------------------------------------------------------------


def resampled(rows, target, most, buckets, least, percent, seed):
    def grams(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, most + 1) for i in range(len(w) - n + 1)]

    found = [(r[0], *grams(r[1])) for r in rows]
    s, t = Counter(b for _, _, g in found for b in g), Counter(b for x in target for b in grams(x)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in s | t}
    scored = []
    for i, words, g in found:
        weight = sum(gain[b] for b in g)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, words, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in scored if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = len(able) * percent // 100
    return [(i, n, w, s, at if at <= drawn else None) for at, (i, _, n, w, s) in enumerate(able, 1)] + [(i, n, w, s, None) for i, words, n, w, s in scored if words < least]


@pytest.mark.parametrize("most,buckets,percent", [(1, 10_000, 10), (3, 97, 60), (2, 1000, 100)])
def test_importance_resampling(spark, rows, most, buckets, percent):
    from quillmesh.llm.importance import importance_resample

    target = [prose(i, 40, 30) for i in range(1000, 1040)] + [None, "", "W-é"]
    got = importance_resample(frame(spark, rows), spark.createDataFrame([(t, 1) for t in target], "text string, bucket int"), most_words=most, buckets=buckets, percent=percent, carry=["text", "score"])
    want = resampled(rows, target, most, buckets, 20, percent, 2024)
    assert sorted(((r.doc_id, r.n_features, r[2], r[3], r[4]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "text", "score"]
    assert Counter(r[5] for r in got.collect()) == Counter(r[1] for r in rows)


def test_resampling_prefers_the_target(spark):
    from quillmesh.llm.importance import importance_resample

    docs = [(i, f"{'red green' if i % 4 == 0 else 'sun moon'} " * 12, "en", "a") for i in range(400)]
    got = importance_resample(frame(spark, docs), spark.createDataFrame([("red green " * 50,)], "text string"), percent=20).where("rank IS NOT NULL").collect()
    assert len(got) == 80 and all(r.doc_id % 4 == 0 for r in got)


def test_resampling_without_target_or_rows(spark, rows):
    from quillmesh.llm.importance import importance_resample

    none = spark.createDataFrame([], "text string")
    assert importance_resample(frame(spark, []), none).count() == 0
    got = importance_resample(frame(spark, rows), none)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()), key=repr) == sorted(resampled(rows, [], 1, 10_000, 20, 10, 2024), key=repr)


# --- operator 13 --------------------------------------------------------------------------------


def diverged(rows, least, prior=5, scale=10**9, top=50):
    docs = [(r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(r[1]))) for r in rows]
    spread = defaultdict(Counter)
    for lang, _, terms in docs:
        spread[lang].update(set(terms))
    kept = {lang: {t for t, n in c.items() if n >= least} for lang, c in spread.items()}
    counts, whole = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        own = [t for t in terms if t in kept[lang]]
        counts[lang, source].update(own)
        whole[lang].update(own)
    share = lambda c, t, lang: 1 + scale * (c[t] + prior) // (c.total() + prior * len(kept[lang]))
    out = []
    for (lang, source), c in list(counts.items()):
        pairs = [(-sum(abs(share(c, t, lang) - share(d, t, lang)) for t in kept[lang]), other.encode(), other) for (la, other), d in list(counts.items()) if la == lang and other != source]
        terms = [(share(whole[lang], t, lang) - share(c, t, lang), t.encode(), t) for t in kept[lang] if c[t] > 0]
        out += [(lang, source, "pair", x[2], -x[0], at) for at, x in enumerate(sorted(pairs), 1)]
        out += [(lang, source, "term", x[2], -x[0], at) for at, x in enumerate(sorted(x for x in terms if x[0] < 0)[:top], 1)]
    return out


def diverged_by_operator(spark, rows, **sizes):
    from quillmesh.llm.divergence import source_divergence

    got = source_divergence(frame(spark, rows), **sizes)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize(
    "least,sizes",
    [
        (30, {}),
        (9, {"top_terms": 3}),
        # nothing fits the filters: partial counts meet what is alive by joins
        (5, {"limit": 0, "first": 1}),
        # many blocks of terms and sources
        (2, {"block_terms": 7, "block_sources": 1}),
        (10_000, {}),
    ],
)
def test_source_divergence(spark, rows, least, sizes):
    want = diverged(rows, least, top=sizes.get("top_terms", 50))
    assert diverged_by_operator(spark, rows, least_documents=least, **sizes) == sorted(want, key=repr)


def test_source_divergence_of_nothing(spark):
    assert diverged_by_operator(spark, []) == []


def test_known_terms_have_their_numbers():
    import numpy as np
    import pyarrow as pa
    from quillmesh.llm.divergence import Known

    pairs = [("en", b"the"), ("de", b"the"), ("de", b"\xc3\xbc"), ("", b"a")]
    known = Known(pa.table({"lang": [p[0] for p in pairs], "term": pa.array([p[1] for p in pairs], pa.binary())}))
    langs, terms = ["", "de", "xx", "en"], [b"a", b"the", b"\xc3\xbc", b"th"]
    every = [(i, j) for i in range(4) for j in range(4)]
    got = known.numbers(pa.array(langs), pa.array(terms, pa.binary()), *map(np.array, zip(*every)))
    assert got.tolist() == [pairs.index((langs[i], terms[j])) if (langs[i], terms[j]) in pairs else -1 for i, j in every]
    none = Known(pa.table({"lang": pa.array([], pa.string()), "term": pa.array([], pa.binary())}))
    assert none.numbers(pa.array(langs), pa.array(terms, pa.binary()), np.array([0]), np.array([0])).tolist() == [-1]


def test_letter_terms_are_split_terms(rows):
    import pyarrow as pa
    from quillmesh.llm.terms import letter_terms, split_terms

    texts = pa.array([r[1] for r in rows] + ["A\x00B\x7fÇ-é_9z"], pa.string()).slice(3)
    found = [f(texts, *more) for f, more in ((letter_terms, ()), (split_terms, (r"[\x00-\x40\x5B-\x60\x7B-\x7F]+",)))]
    words = [(row.tolist(), terms.take(pa.array(index)).to_pylist()) for row, index, terms in found]
    assert words[0] == words[1] and len(words[0][0]) > 1000
    assert len(letter_terms(pa.array([], pa.string()))[0]) == 0 and len(letter_terms(pa.array([None, ""], pa.string()))[0]) == 0


def test_prefixes_shrink_to_the_kept_terms(spark):
    """Prefixes with few documents end the search: long terms of a single document need no further level."""
    from quillmesh.llm.divergence import kept_terms

    rows = [("en", f"shared {'z' * 5}{i:05d} {'q' * 5000}{i}") for i in range(40)]
    rows = [(lang, re.sub(r"\d", lambda m: "abcdefghij"[int(m[0])], text)) for lang, text in rows]
    kept = {(r.lang, bytes(r.term)) for r in kept_terms(spark.createDataFrame(rows, "lang string, text string"), 30).collect()}
    assert kept == {("en", b"shared")}


# --- operator 11 --------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, host string, k string, n string, word string, score string"


def pages_frame(spark, pages):
    return spark.createDataFrame([(*p, *"abcde") for p in pages], PAGES)


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lowered(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path, rules):
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def splits(name):
    """All sequences of words of a short name."""
    return [[name]] + [[name[:i], *rest] for i in range(1, len(name)) for rest in splits(name[i:])] if name else [[]]


@pytest.fixture(scope="module")
def pages():
    hosts = ["redbox.example.com", "boxred.example.net", "blog.RedGreen.example.org", "m.casino-win.example.com", "redgreenbox.net", "x" * 70 + ".com", "büchergrün.de", "a.b.com:8080", "org", "notexample.org", "1red22box.net"]
    html = "<html><script>var casinowin = 1;</script><p>The red box, a Green box &amp; win. redbox.example.com Casino bücher grün red</p></html>"
    out = [(i, f"http{'s' * (i % 2)}://{hosts[i % len(hosts)]}{['/fr/1', '/de/2.html', '/es/x?y=/de/', '/en/1#z', '/en/77/', '', '/'][i % 7]}", html if i % 3 else None) for i in range(150)]
    out += [(1000 + i, "http://hot.redbox.example.net/de/1", "box " * 50) for i in range(90)]
    out += [(2000, None, html), (2001, "", ""), (2002, "no scheme", "red"), (2003, "://", None), (2004, "a://b://c/d", None), (2005, "http://h\nost/p\nath?q", None), (2006, "http://" + "y" * 200_000 + "/" + "z/" * 50_000, "w" * 3000 + " w" * 100_000)]
    out += [(None, "http://box.org/x", html), (7, "http://redbox.example.com/fr/1", html), (7, "http://redbox.example.com/fr/1", html), (2007, "http://..org/x", None)]
    return out


def filtered(pages, rules, seeds, smoothing=1.0):
    from quillmesh.llm.url_filter import MARKUP, SEED_SHARE

    words, total = Counter(), 0
    for _, _, h in pages:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(re.sub(MARKUP, " ", h or "")))
        words.update(found)
        total += len(found)

    def likely(name):
        if len(name) > 63:
            return [name]
        if len(name) > 14:  # too many splits to try: only at known words
            options = [s for s in splits_at(name, words)]
        else:
            options = splits(name)
        score = lambda s: round(sum(math.log10(words[w] / total) if words[w] else 1 - len(w) - math.log10(max(total, 1)) for w in s), 9)
        return max(options, key=lambda s: (score(s), -len(s), [len(w) for w in s]))

    def tokens(host, path):
        runs = re.findall(r"[a-z\x80-\U0010FFFF]+|[0-9]+", host)
        names = [w for r in runs for w in ([r] if r[0].isdigit() and r.isascii() else likely(r))]
        return ["h:" + w for w in names] + ["p:" + t for t in re.findall(r"[a-z\x80-\U0010FFFF]+|[0-9]+", lowered(path))]

    rows, counts, classes = [], {"allow": Counter(), "block": Counter()}, Counter()
    for i, url, _ in pages:
        host, path = split_url(url)
        verdict, rule = rule_of(host, path, rules)
        own = tokens(host, path)
        rows.append((i, host, path, rule, verdict, own))
        if verdict:
            counts[verdict].update(own)
            classes[verdict] += 1
    marked = {by + w for w in seeds for by in ("h:", "p:")}
    known = set(counts["allow"]) | set(counts["block"]) | marked
    a, b, v = counts["allow"].total(), counts["block"].total(), max(len(known), 1)
    odds = {t: math.log((counts["block"][t] + (t in marked) * b * SEED_SHARE + smoothing) / (b * (1 + SEED_SHARE * len(marked)) + smoothing * v)) - math.log((counts["allow"][t] + smoothing) / (a + smoothing * v)) for t in known}
    prior = math.log((classes["block"] + smoothing) / (classes["allow"] + smoothing))
    out = []
    for i, host, path, rule, verdict, own in rows:
        score = None if verdict else prior + sum(odds.get(t, 0.0) for t in own)
        out.append((i, host, path, rule, verdict or ("block" if round(score, 9) > 0 else "allow"), None if verdict else round(score, 6)))
    return out


def splits_at(name, words):
    known = [w for w in words if w in name]
    pattern = re.compile("(" + "|".join(sorted(map(re.escape, known), key=len, reverse=True)) + ")") if known else None
    return [[x for x in pattern.split(name) if x], [name]] if pattern else [[name]]


@pytest.mark.parametrize("seeds", [(), ("casino", "win")])
def test_url_filter(spark, pages, seeds):
    from quillmesh.llm.url_filter import RULES, filter_urls

    got = filter_urls(pages_frame(spark, pages), seeds=seeds).collect()
    got = [(*r[:5], None if r.score is None else round(r.score, 6)) for r in got]
    want = filtered(pages, RULES, seeds)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[4] for r in want if r[3] is None} == {"allow", "block"}


def test_url_filter_by_joins(spark, pages, monkeypatch):
    """Sides too large for broadcasts: hot keys are told apart and the others shuffled."""
    from quillmesh.llm import hot, url_filter

    plain = sorted(map(tuple, url_filter.filter_urls(pages_frame(spark, pages)).collect()), key=repr)
    monkeypatch.setattr(hot.join_hot, "__defaults__", ("inner", 0))
    monkeypatch.setattr(hot, "HOT_SHARE", 20)
    monkeypatch.setattr(url_filter.page_words, "__defaults__", (0,))
    assert sorted(map(tuple, url_filter.filter_urls(pages_frame(spark, pages)).collect()), key=repr) == plain


def test_url_filter_without_rules_or_pages(spark, pages):
    from quillmesh.llm.url_filter import filter_urls

    assert filter_urls(pages_frame(spark, [])).count() == 0
    got = filter_urls(pages_frame(spark, pages), rules=[("nowhere.test", "/", "block")]).collect()
    assert len(got) == len(pages) and {r["rule"] for r in got} == {None} and {r["verdict"] for r in got} == {"allow"}


def test_longest_rule_wins(spark):
    from quillmesh.llm.url_filter import filter_urls

    rules = [("com", "/aaaa", "allow"), ("b.com", "/a", "block"), ("a.b.com", "/", "allow"), ("com", "/aaaa", "block")]
    urls = ["http://a.b.com/a", "http://a.b.com/aaaa", "http://xb.com/aaaa", "http://b.com/ab", "http://a.b.com"]
    got = filter_urls(pages_frame(spark, [(i, u, None) for i, u in enumerate(urls)]), rules=rules).orderBy("page_id").collect()
    assert [(r["rule"], r["verdict"]) for r in got][:4] == [("a.b.com/", "allow"), ("a.b.com/", "allow"), ("com/aaaa", "block"), ("b.com/a", "block")]
    assert got[4]["rule"] is None


def test_viterbi_finds_the_best_split():
    from quillmesh.llm.url_filter import best_words

    rng = random.Random(2)
    for _ in range(300):
        name = "".join(rng.choices("abc", k=rng.randint(0, 9)))
        counts = {"".join(rng.choices("abc", k=rng.randint(1, 4))): rng.randint(1, 90) for _ in range(6)}
        total = sum(counts.values()) + 50
        known = {(i, n): counts[name[i : i + n]] for i in range(len(name)) for n in range(1, len(name) - i + 1) if name[i : i + n] in counts}
        price = lambda s: round(sum((math.log10(counts[w]) if w in counts else 1 - len(w)) - math.log10(total) for w in s), 7)
        best = max((price(s), -len(s), [len(w) for w in s]) for s in splits(name))
        got = best_words(name, known, total)
        assert "".join(got) == name and (price(got), -len(got)) == best[:2]
