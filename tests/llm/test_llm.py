"""The training-data operators against brute force, round trips and held-out labels."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from recordflow.llm import bpe, chat_format, media, mixing, passages, perplexity, pii, quality_rules, repeats, secret_scan, simhash
from recordflow.llm.graph import components
from recordflow.llm.queries import CONTROL_TEXT, QUERIES, _ranks

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h int, size int"
rng = random.Random(5)


def rnd(n, alphabet="abcd é\n"):
    return "".join(rng.choice(alphabet) for _ in range(n))


LONG = rnd(120_000)
#: Nulls, empty and very long texts, repeated rows, ties, and extra columns with clashing names.
ODD = [
    (1, "", "en", "a", 0, 1, 1), (2, None, None, None, None, 1, 1), (None, "some text here", "en", "a", 14, 1, 1),
    (None, None, None, "b", None, 1, 1), (3, LONG, "fr", "c", 120_000, 1, 1), (4, "same words", "en", "b", 10, 1, 1),
    (4, "same words", "en", "b", 10, 1, 1), (5, "same words", "en", "b", 10, None, 1), (6, "  \t\n ", "de", "b", 5, 1, 1),
    (7, "漢字 🙂 ß İ ſecret: K", "xx", "é", 20, 1, 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# --- 1 ---------------------------------------------------------------------------------------------------------


def facts(t):
    t = t or ""
    w = WORD.findall(t)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(tri)
    repeated = {i + j for i, x in enumerate(tri) if n[x] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated)


def test_quality_rules(docs, texts, odd, none):
    for rows, of in ((quality_rules.quality_rules(docs).collect(), lambda r: [texts[r.doc_id]]), (quality_rules.quality_rules(odd).collect(), lambda r: [x[1] for x in ODD if x[0] == r.doc_id])):
        for r in rows:
            got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            assert got in [facts(t) for t in of(r)]
            assert r.base_failed == (got[0] < 50 or 100 * got[4] > 50 * got[0]) and not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(none).count() == 0
    prose = "This is a line of plain prose that ends as it should.\n" + "\n".join(f"Word{i} and another word{i} stand in line number {i} here." for i in range(12))
    menu = "Home | News | Contact | About | Login\n"
    df = docs.sparkSession.createDataFrame([(1, prose + "\nAll rights reserved by nobody in particular.", 9), (2, menu * 3 + "\n".join(f"WORD{i} OF SHOUT{i}!! AND MORE{i}!!" for i in range(30)), 9)], "doc_id int, text string, line int")
    assert [r.kept for r in quality_rules.quality_rules(df).orderBy("doc_id").collect()] == [True, False]
    kept = quality_rules.cleaned_documents(df).collect()
    assert [(r.doc_id, r.text, r.line) for r in kept] == [(1, prose, 9)]


# --- 2 ---------------------------------------------------------------------------------------------------------


def test_cleaned_documents_keep_columns_of_any_name(spark):
    prose = "\n".join(" ".join(f"word{i * k}" for k in range(3, 12)) + "." for i in range(1, 15))
    rows = [(1, prose + "\nHome | Menu | Login", "a", 2, "c"), (2, "short", "b", 3, "d"), (None, None, None, None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, __t string, __h int, row string")
    kept = quality_rules.cleaned_documents(d)
    assert kept.columns == d.columns and [tuple(r) for r in kept.collect()] == [(1, prose, "a", 2, "c")]


def plain_print(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    u = sorted(set(fps))
    up = {x: x for x in u}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    a = np.array(u, np.uint64)
    for x in u:
        for j in np.flatnonzero(np.bitwise_count(a ^ np.uint64(x)) <= 3):
            p, q = root(x), root(u[j])
            up[max(p, q)] = min(p, q)
    return {x: root(x) for x in u}


def test_fingerprints():
    for t in [*(x[1] for x in ODD), "one", "one two", "A b C d e"]:
        assert simhash.fingerprint(t) == plain_print(t)


def test_components_of_prints(spark, monkeypatch):
    g = np.random.default_rng(1)
    base, fps = int(g.integers(1 << 62)), []
    for _ in range(900):  # a crowd of near copies
        f = base
        for k in g.integers(0, 64, g.integers(0, 7)):
            f ^= 1 << int(k)
        fps.append(f)
    fps += [int(x) for x in g.integers(0, 1 << 63, 600)]
    df = spark.createDataFrame([(i, np.uint64(x).astype(np.int64).item()) for i, x in enumerate(fps)], "doc_id long, fp long")
    roots = brute_components(fps)
    least = {}
    for i, x in enumerate(fps):
        least.setdefault(roots[x], i)
    monkeypatch.setattr(simhash, "fingerprints", lambda *a: df)
    for block in (2048, 64):
        monkeypatch.setattr(simhash, "BLOCK", block)
        got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
        assert got == {i: least[roots[x]] for i, x in enumerate(fps)}


def test_thresholds_cover_every_pair():
    counts = np.ones((4, 1 << 16), np.int64)
    counts[0, 0] = 10**7  # one partition is useless
    t = simhash.thresholds(counts)
    assert sum(t) == 0 and t[0] == -1 and min(t) >= -1


def test_near_dedup_keeps_one_of_each(odd, none, docs):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.fingerprint, r.component_id))
    assert by[1] == by[2] == by[6] == {("0" * 16, 1)} and by[5] == by[4] and {x[1] for x in by[5]} == {4}
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "7", "None"]
    assert simhash.near_duplicates(none).count() == 0 and simhash.representatives(none).count() == 0


def test_rows_of_one_id_are_told_apart(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six seven", "red green blue white black grey")
    rows = [(4, a, None, "x"), (4, b, "x", None), (5, b, None, None), (None, c, "1", "1"), (None, c, "1", "1"), (None, a, "2", "2"), (6, None, "3", "3")]
    d = spark.createDataFrame(rows, "doc_id long, text string, __key string, r1 string").repartition(3)
    kept = simhash.representatives(d)
    assert kept.columns == d.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[1], rows[3], rows[6]], key=str)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# --- 3 ---------------------------------------------------------------------------------------------------------


def test_media(odd, none):
    for data in (b"", b"x", bytes(range(256)) * 3):
        p = media.padded(data)
        assert len(p) % 64 == 0 and len(p) and media.from_png(media.to_png(p)).tobytes() == p
    with pytest.raises(ValueError):
        media.from_png(media.to_png(media.padded(b"x"))[:-20] + b"0" * 20)
    rows = media.text_media(odd).collect()
    assert len(rows) == len(ODD)
    want = set()
    for d, t, *_ in ODD:
        p = media.padded((t or "").encode())
        want.add((d, len((t or "").encode()), len(p), sha(p), zlib.crc32(p[-64:])))
    assert {(r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows} == want
    assert media.text_media(none).count() == 0


def test_sequences(spark):
    page = '<body><p>One <b>two</b></p><figure><img src="sha256:aa" alt="x"><figcaption>Cap</figcaption></figure><p>three</p><script>no</script><img src="b.png"></body>'
    s = media.sequence(page)
    assert [(x["position"], x["kind"], x["text"] or x["ref"], x["caption"]) for x in s] == [
        (0, "text", "One two", None), (1, "media", "sha256:aa", "Cap"), (2, "text", "three", None), (3, "media", "b.png", None),
    ]
    assert media.sequence(None) == []
    refs = media.references(media.interleaved(spark.createDataFrame([(1, page), (2, None)], "page_id int, html string")), "page_id")
    store = spark.createDataFrame([("aa", media.to_png(media.padded(b"q")))], "digest string, media binary")
    got = {r.position: r.payload_bytes for r in media.resolved(refs, store).collect()}
    assert got == {1: 64, 3: None}


def test_open_heads_and_empty_tags_hide_nothing():
    """A head without an end tag stops at the body or the first block; a self-closing tag holds nothing."""
    for page in ("<head><title>t</title><body>a<img src=x>", "<head><title>t</title><p>a</p><img src=x>", "<body><script/><template/>a<img src=x>"):
        assert [x["text"] or x["ref"] for x in media.sequence(page)] == ["a", "x"], page


# --- 4 ---------------------------------------------------------------------------------------------------------


def brute_kneser_ney(texts):
    """p(byte | context) of an interpolated modified Kneser-Ney model over six bytes, from dictionaries."""
    top = Counter()
    for t in texts:
        x = [255] * 5 + [*t.encode(), 254]
        top.update(tuple(x[i : i + 6]) for i in range(len(x) - 5))
    orders = {6: top}
    for j in (5, 4, 3, 2, 1):
        orders[j] = Counter(g[1:] for g in orders[j + 1])
    off, by = {}, {j: defaultdict(Counter) for j in orders}
    for j, grams in orders.items():
        n1, n2, n3, n4 = (sum(n == i for n in grams.values()) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        off[j] = lambda n, d=d: min(max(d[min(n, 3) - 1], 0.1), min(n, 3) - 0.1)
        for g, n in grams.items():
            by[j][g[:-1]][g[-1]] = n

    def p(context, x, j=6):
        if j == 0:
            return 1 / 255
        own, low = by[j].get(tuple(context[len(context) - j + 1 :])), p(context, x, j - 1)
        if not own:
            return low
        keep = max(own[x] - off[j](own[x]), 0) if x in own else 0
        return (keep + sum(map(off[j], own.values())) * low) / sum(own.values())

    return p


def test_model_is_a_distribution():
    texts = ["hello there, hello again", "other, heller", "aaa", "déjà vu"]
    k, n = np.unique(perplexity.grams([t.encode() for t in texts])[0], return_counts=True)
    facts = [(j, int(c), int(m)) for j, (_, x) in perplexity.continuations(k, n).items() for c, m in zip(*np.unique(x[x <= 4], return_counts=True))]
    two, many = np.unique(perplexity.continuations(k, n)[3][0] & np.uint64(0xFFFF), return_counts=True)
    model = perplexity.Shard(k, n, perplexity.lower_orders([*facts, *((2, int(c), int(m)) for c, m in zip(two, many))]))
    for context in (b"\xff" * 5, b"hello", b"e, he", b"zzzzz", b"there", b"\xff\xffaaa"):
        base = int.from_bytes(context, "big") << 8
        p = np.exp(model.logp(np.array([base + x for x in range(256)], np.uint64)[:255]))
        assert np.isclose(p.sum(), 1, atol=1e-9), context
    brute = brute_kneser_ney(texts)
    for t in ("hello there", "zz", "jà a"):
        k, _ = perplexity.grams([t.encode()])
        x = [255] * 5 + [*t.encode(), 254]
        assert np.allclose(model.logp(k), [np.log(brute(x[i : i + 5], x[i + 5])) for i in range(len(x) - 5)], atol=1e-9)


def test_classifier_on_labels(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    met = perplexity.classified(d, labels).join(labels, "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in met.groupBy("quality", "kept").count().collect()}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.99 and n[0, False] / (n[0, False] + n.get((0, True), 0)) > 0.7


def test_rare_languages_have_cuts_of_their_own(spark):
    """One language at a far level keeps its clean documents with 3 or 300 trusted ones; one without any is kept."""
    limits, r = perplexity.Limits(), random.Random(4)
    for few in (1, 3, 99, 101, 300):
        rows = [("en", 1.5 + r.gauss(0, 0.05), 0.01) for _ in range(500)] + [("xx", 6 + r.gauss(0, 0.05), 0.01) for _ in range(few)]
        got = {x["__lang"]: x for x in perplexity.language_cuts(spark.createDataFrame(rows, "lang string, __nll double, __room double"), limits).collect()}
        assert 5 < got["xx"]["__low"] < 5.95 and 6.05 < got["xx"]["__high"] < 7, few
        assert 1 < got["en"]["__low"] < 1.45 and 1.55 < got["en"]["__high"] < 2, few
    clean = "the cat and the dog sat on the mat and the rug"
    d = [(i, f"{clean} {i % 7} {clean}", "en") for i in range(300)] + [(300 + i, f"жжщ {i % 5} ъъы эюя " * 20, "xx") for i in range(8)]
    d += [(400, "ωψχ φυτ " * 40, "yy"), (401, "ωψχ φυτ " * 40, "en")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(304)], "doc_id long, quality int, toxic int")
    kept = {x.doc_id: x.kept for x in perplexity.classified(spark.createDataFrame(d, "doc_id long, text string, lang string"), labels).collect()}
    assert all(kept[300 + i] for i in range(8)) and kept[400] and not kept[401]


def test_word_order_counts(spark):
    """Shuffled words have the characters and words of a fluent text, and no higher score under a model of characters alone."""
    words = [f"x{a}{b}x" for a in "abcde" for b in "fghij"]
    cycle = lambda at, n: " ".join(words[(at + i) % 25] for i in range(n))
    fluent = cycle(3, 151).split()
    shuffled = " ".join(random.Random(1).sample(fluent, len(fluent)))
    rows = [(i, cycle(i, 100 + i), "en") for i in range(200)] + [(900, " ".join(fluent) + " xafx", "en"), (901, shuffled, "en")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in perplexity.classified(d, labels).where("doc_id >= 900").collect()}
    assert got[900].kept and not got[901].kept and got[901].perplexity > 1.3 * got[900].perplexity


@pytest.mark.parametrize("small", [False, True])
def test_sharded_scores_are_those_of_the_counts(spark, monkeypatch, small):
    """Scores by packets equal the brute-force model of the other fold; the model grows with the trusted text."""
    if small:  # many pieces, chunks and packets
        for name, x in (("PIECE", 64), ("CHUNK", 300), ("HELD", 40)):
            monkeypatch.setattr(perplexity, name, x)
    texts = [" ".join(random.Random(i).choices(["abc", "de", "fgh", "é", "漢字", "\xff", "a"], k=12)) for i in range(60)]
    odd = ["", None, "a", "\x00\xfe", "never met ZZ", texts[0], "🙂" * 50]
    d = spark.createDataFrame([*enumerate([*texts, *odd])], "doc_id long, text string").repartition(3)
    ids = spark.createDataFrame([(i,) for i in range(50)], "doc_id long")
    model = perplexity.counts(d, ids, perplexity.Limits(), 7)
    few = perplexity.counts(d, ids.where("doc_id < 5"), perplexity.Limits(), 7)
    size = lambda m: sum(len(perplexity._unpack_keys(r["keys"])) for r in m.where("kind = 0").collect())
    assert size(model) > size(few) > 0
    folds = {r.doc_id: r.f for r in d.select("doc_id", perplexity.fold_of().alias("f")).collect()}
    brute = [brute_kneser_ney([t for i, t in enumerate(texts[:50]) if folds[i] == f]) for f in (0, 1)]
    scores = perplexity.text_scores(d, model, 7, 3000)
    got = {r.doc_id: r.logp for r in d.join(scores.withColumnRenamed("text", "h"), F.xxhash64(d.text) == F.col("h")).collect()}
    assert scores.count() == len({t for t in [*texts, *odd] if t}) and len(got) == 65
    for i, t in enumerate([*texts, *odd]):
        if t:
            x = [255] * 5 + [*t.encode(), 254]
            want = sum(np.log(brute[1 - folds[i]](x[k : k + 5], x[k + 5])) for k in range(len(x) - 5))
            assert abs(got[i] - want) / (len(x) - 5) < 1e-6, i


def test_small_bundles_are_looked_up_together(monkeypatch):
    """A chunk comes in a bundle a task; its strings are not indexed anew for each of them."""
    texts = [f"text {i % 30} of some words" for i in range(40)]
    strings = np.unique(perplexity.grams([t.encode() for t in texts])[0])
    value = {int(k): -float(k % 97) for k in strings}
    answers = pa.table({"keys": [perplexity._pack_keys(strings)], "logp": [perplexity._pack(np.array(list(value.values()), np.float32))]})
    send = perplexity._bundled(1)
    one = lambda t: pa.RecordBatch.from_arrays([pa.array([t]), pa.array([hash(t) >> 8])], ["text", "hash"])
    bundles = pa.Table.from_batches([b for t in texts for b in send([one(t)])])
    calls, index_in = [], perplexity.pc.index_in
    monkeypatch.setattr(perplexity.pc, "index_in", lambda *x: calls.append(1) or index_in(*x))
    got = {r["text"]: r["logp"] for r in perplexity._sums(bundles, answers).to_pylist()}
    assert got == {hash(t) >> 8: sum(value[k] for k in perplexity.grams([t.encode()])[0].tolist()) for t in texts}
    assert len(bundles) == 40 and len(calls) == 1
    for name, x in (("PIECE", 60), ("LOOK", 300)):  # many pieces of a look-up, then many look-ups
        monkeypatch.setattr(perplexity, name, x)
        assert {r["text"]: r["logp"] for r in perplexity._sums(bundles, answers).to_pylist()} == got
    assert len(calls) > 3


def test_kept_documents_keep_columns_of_any_name(spark):
    d = spark.createDataFrame([(1, "some text", "en", 0, 1, 2, "x")], "doc_id long, text string, lang string, n int, kept int, __low int, row string")
    kept = perplexity.kept_documents(d, spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"))
    assert kept.columns == d.columns and [tuple(r) for r in kept.collect()] == [(1, "some text", "en", 0, 1, 2, "x")]


def test_classifier_odd_cases(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (None, 1, 0), (3, 1, None)], "doc_id long, quality int, toxic int")
    assert [r.doc_id for r in perplexity.trusted_ids(labels).collect()] == [3]
    rows = perplexity.classified(odd, labels).collect()
    assert len(rows) == len(ODD) and not any(r.kept for r in rows if r.perplexity is None)
    kept = perplexity.kept_documents(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == sum(bool(x[1]) for x in ODD)
    assert perplexity.classified(none, labels).count() == 0


# --- 5 ---------------------------------------------------------------------------------------------------------


def test_bpe(odd, none):
    path, pattern = _ranks()
    enc = bpe.encoding(path, pattern)
    assert isinstance(enc, tiktoken.Encoding)
    for n in (0, 1, 50, 700, 3000):
        for chunk, overlap in ((20, 8), (64, 16), (200, 50)):
            t = rnd(n, " \n\t abc'sdl12,.!?  漢🙂 　") + "a" * (n // 3) + " " * (n // 5)
            pieces = bpe.stitched(t, pattern, chunk, overlap)
            assert "".join(pieces) == t and [i for p in pieces for i in enc.encode_ordinary(p)] == enc.encode_ordinary(t)
    want = sorted((str(d), len(i := enc.encode_ordinary(t or "")), sha(np.array(i, "<u4").tobytes()), sha(t or "")) for d, t, *_ in ODD)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encoded_digests(odd, path, pattern).collect()) == want
    assert bpe.encoded_digests(none, path, pattern).count() == 0


# --- 6 ---------------------------------------------------------------------------------------------------------


def test_mixing(docs, texts, odd, none):
    rows = mixing.mixed_sizes(docs).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mixed_sizes(docs.repartition(3)).collect()))
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    by = defaultdict(list)
    for r in rows:
        assert r["size"] == len(WORD.findall(texts[r.doc_id])) and r.taken == r.copies * r["size"] <= 2 * r["size"]
        by[source[r.doc_id]].append(r)
    names = sorted(by)
    size = {s: sum(r["size"] for r in by[s]) for s in names}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    capped: set = set()
    while True:
        level = (1.5 * sum(size.values()) - sum(2 * size[s] for s in capped)) / sum(weight[s] for s in names if s not in capped)
        more = {s for s in names if s not in capped and level * weight[s] > 2 * size[s]}
        if not more:
            break
        capped |= more
    for s in names:
        want = 2 * size[s] if s in capped else level * weight[s]
        assert all(abs(r.target - want) < 1e-6 * want and r.source_size == size[s] for r in by[s])
        assert abs(sum(r.taken for r in by[s]) - want) <= max(r["size"] for r in by[s]) / 2 + 1
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {r.doc_id: r.copies for r in rows if r.copies}
    assert len(mixing.mixed_sizes(odd).collect()) == len(ODD) and mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mixed_sizes(none).count() == 0 and mixing.mixed_documents(none).count() == 0


@pytest.mark.parametrize("block", [4096, 7])
def test_mixing_splits_ties(spark, monkeypatch, block):
    """Equal rows without ids are taken by number, so that targets are met; other columns may tell them apart."""
    monkeypatch.setattr(mixing, "BLOCK", block)
    rows = [(None, "word " * 100, "a", i % 3) for i in range(400)] + [(i, "other words here " * (1 + i % 9), "b", 0) for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, key int").repartition(4)
    got = mixing.mixed_sizes(d).collect()
    assert len(got) == len(rows) and Counter((r.doc_id, r["size"]) for r in got) == Counter((r[0], len(r[1].split())) for r in rows)
    for r in {r.source_size: r for r in got}.values():
        same = [x for x in got if x.source_size == r.source_size]
        assert all(x.taken == x.copies * x["size"] <= 2 * x["size"] for x in same)
        assert abs(sum(x.taken for x in same) - r.target) <= max(x["size"] for x in same) / 2 + 1
    again = mixing.mixed_sizes(d.repartition(2)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    mixed = mixing.mixed_documents(d)
    assert mixed.columns == d.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(r.doc_id for r in got for _ in range(r.copies))


# --- 7 ---------------------------------------------------------------------------------------------------------


def brute_repeats(rows):
    at = defaultdict(list)
    data = [(t or "").encode() for _, t in rows]
    for i, b in enumerate(data):
        for p in range(len(b) - 399):
            at[b[p : p + 400]].append((i, p))
    marks = [bytearray(len(b)) for b in data]
    for v in at.values():
        if len(v) > 1:
            for i, p in v:
                marks[i][p : p + 400] = b"\1" * 400
    out = []
    for (d, _), b, m in zip(rows, data, marks):
        n = sum(m[j] and not (j and m[j - 1]) for j in range(len(m)))
        out.append((d, len(b), sum(m), n, sha(bytes(x for x, y in zip(b, m) if not y))))
    return sorted(out, key=str)


def test_prefixes():
    for _ in range(20):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(30))) for _ in range(5)]
        s = np.array([x for i, t in enumerate(texts) for x in [*(c + 10 for c in t), i]], np.int64)
        order, interval = repeats.shared_prefixes(s, 4)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        for a, b, x, y in zip(order, order[1:], interval, interval[1:]):
            assert (x == y) == (len(s) - max(a, b) >= 4 and s[a : a + 4].tolist() == s[b : b + 4].tolist())


@pytest.mark.parametrize("crowd", [256, 4])
def test_repeats(spark, none, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    shared = [rnd(n) for n in (150, 300, 420, 700)]
    rows = []
    for i in range(80):
        t = rnd(rng.choice([0, 50, 500]))
        for _ in range(rng.choice([0, 1, 2])):
            t += rng.choice(shared) + rnd(rng.choice([0, 5, 80]))
        rows.append((i if i % 20 else None, t))
    rows += [(100, "und " * 600), (101, "x" * 900), (102, None), (103, "ab" * 250), (7, rows[7][1]), (7, rows[7][1]), (104, rnd(40_000))]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, key int").repartition(3)
    assert sorted(map(tuple, repeats.without_repeats(df).collect()), key=str) == brute_repeats(rows)
    assert repeats.without_repeats(none).count() == 0


def brute_passages(rows):
    at = defaultdict(set)
    for i, (_, t) in enumerate(rows):
        w = WORD.findall(t or "")
        for p in range(len(w) - 50):
            at[tuple(w[p : p + 51])].add(i)
    hit = {i for v in at.values() if len(v) > 1 for i in v}
    return sorted(((d, i in hit) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("piece,run,bits", [(1 << 20, 256, 1 << 26), (40, 3, 64)])
def test_shared_passages(spark, none, monkeypatch, piece, run, bits):
    monkeypatch.setattr(passages, "PIECE", piece)
    monkeypatch.setattr(passages, "RUN", run)
    monkeypatch.setattr(passages.bits_of, "__defaults__", (bits,))
    prose = lambda n: [rnd(rng.randrange(1, 5), "abcdeé漢") for _ in range(n)]
    shared, line, rows = [prose(n) for n in (50, 51, 52, 60, 75, 200)], prose(30), []
    for i in range(150):
        t = prose(rng.choice([0, 20, 60]))
        for _ in range(rng.choice([0, 0, 1, 2])):
            p = rng.choice(shared)
            cut = rng.choice([0, 0, 1, 9])
            t += p[cut : len(p) - rng.choice([0, 0, 1, 9])] + prose(rng.choice([0, 3, 30]))
        t += line if i % 3 else []  # below 51 words, so it marks nothing by itself
        rows.append((i if i % 40 else None, "".join(w + rng.choice([" ", "\n", "\t  "]) for w in t)))
    rows += [(200, " ".join(["ab", "c"] * 300)), (201, " ".join(prose(60) * 3)), (202, None), (203, "x" * 200_000), (204, "y" * 900)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (205, " ".join(prose(20_000))), (206, "x " * 60), (207, "\nx" * 51)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_passages(rows)
    assert 20 < sum(x for _, x in want) < len(want) - 20
    got = repeats.with_passages(df).collect()
    assert sorted(((r.doc_id, r.shares_passage) for r in got), key=str) == want
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute_repeats(rows)
    assert any(r.shares_passage and not r.n_removed for r in got)
    assert repeats.with_passages(none).count() == 0


def test_common_passages_travel_once():
    line = [rnd(4, "abcde") for _ in range(60)]
    texts = [" ".join(line + [rnd(6, "abcde") for _ in range(40)]) for _ in range(300)]
    rows = next(passages._dealt(repeats._identity)([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])).to_pydict()
    most = Counter(zip(rows["key"], rows["content"])).most_common(1)[0][1]
    assert most == 1 and set(rows["th"]) == {repeats._identity(t.encode()) for t in texts}


# --- 8 ---------------------------------------------------------------------------------------------------------

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)


def base_secrets(t):
    t = t or ""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]


def test_secrets(docs, texts, odd, none):
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good, bad = "ghp_" + body + secret_scan.base62_crc(body), "ghp_" + body + "000000"
    cases = [*texts.values(), *(x[1] for x in ODD), "İ token=abcdefgh1", "a" * 31, "a" * 32, "AKIA" + "A" * 12, "password: password=12345678", "tokentoken:'x" * 9, good, bad, "K" + "e" * 40]
    cases += [rnd(300, "akiAKI tokens=:passwd'12345678 ") for _ in range(200)]
    for t in cases:
        assert {s for s in secret_scan.find_secrets(t) if s[0] in secret_scan.BASE} == set(base_secrets(t))
    kinds = lambda t: [s[0] for s in secret_scan.find_secrets(t)]
    assert kinds(good) == ["github"] and kinds(bad) == []
    for r in secret_scan.scan_secrets(docs).collect():
        spans = base_secrets(texts[r.doc_id])
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], secret_scan.KINDS.index(x[0]))))
        assert r.base_sha256 == sha(text) and [r.n_assign, r.n_access, r.n_hex] == [sum(x[0] == k for x in spans) for k in secret_scan.BASE]
    out = secret_scan.redacted_documents(odd)
    assert out.columns == odd.columns and out.count() == len(ODD)
    assert secret_scan.redact("a token=12345678 b") == "a [SECRET] b" and secret_scan.redact(None) is None
    assert secret_scan.scan_secrets(none).count() == 0


# --- 9 ---------------------------------------------------------------------------------------------------------


def test_chat(spark):
    for role in ("us<|er\n", "%0A\\n<\\|", "a"):
        for t in ("<|", "<\\|x<\\\\|", CONTROL_TEXT, "", "\n\n<|im_end|>\n"):
            part, s, e = chat_format.formatted_turn(role, t)
            assert chat_format.parsed_turn(part) == (role, t) and chat_format.unescaped(part[s:e]) == t and part.count("<|") == 2
    rows = [(1, 0, "system", None, 1), (1, 1, None, "q", 1), (1, 2, "assistant", "a<|im_end|>", 1), (1, 3, "user", "r", 1), (1, 4, "assistant", "b", 1), (None, 0, "assistant", "", 1), (2, None, "user", "x", 1), (2, None, "user", "x", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int")
    got = {r.conv_id: r for r in chat_format.digests(chat_format.formatted(df)).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 5, None: 1, 2: 2}
    assert got[1].turns_sha256 == sha("system\n\n\nq\nassistant\na<|im_end|>\nuser\nr\nassistant\nb\n") and got[1].loss_sha256 == sha("a<|im_end|>b")
    examples = chat_format.materialised(chat_format.formatted(df), [1]).orderBy("part_no").collect()
    assert [chat_format.unescaped(r.target) for r in examples] == ["a<|im_end|>", "b"]
    assert examples[1].context.startswith(examples[0].context + examples[0].target)
    assert chat_format.digests(chat_format.formatted(df.limit(0))).count() == 0


def test_chat_examples(spark):
    """Every assistant turn is an example with all turns before it, as an explicit expansion gives them; in any order of rows."""
    r = random.Random(3)
    convs = {i: [(r.choice(["user", "assistant", "system"]), r.choice(["<|im_end|>", "a\\n", "", "é🙂", LONG[:5000]]) + str(k)) for k in range(r.randrange(1, 9))] for i in range(30)}
    df = spark.createDataFrame([(i, k, *x) for i, c in convs.items() for k, x in enumerate(c)], "conv_id long, turn long, role string, text string")
    parts = chat_format.formatted(df)
    want, digests = {}, {}
    for i, c in convs.items():
        whole, n, contexts, size = "", 0, hashlib.sha256(), 0
        for k, (role, text) in enumerate(c):
            part, s, _ = chat_format.formatted_turn(role, text)
            if role == "assistant":
                context = whole + part[:s]
                want[i, n] = (k, len(context), sha(context), text)
                contexts.update(hashlib.sha256(context.encode()).digest())
                n, size = n + 1, size + len(context)
            whole += part
        digests[i] = (len(c), n, size, contexts.hexdigest(), len(whole))
    for p, ordered in ((parts, True), (parts, False), (parts.repartition(4, "part_no"), False)):
        got = {(x.conv_id, x.example): (x.context_turns, x.context_chars, x.context_sha256, x.target) for x in chat_format.expanded(p, ordered).collect()}
        assert got == want
        rows = chat_format.digests(p, ordered).collect()
        assert {x.conv_id: (x.n_turns, x.n_examples, x.context_chars, x.contexts_sha256, x.formatted_chars) for x in rows} == digests
    texts = {(x.conv_id, x.part_no): sha(x.context) for x in chat_format.materialised(parts).collect()}
    assert texts == {(i, k): c for (i, _), (k, _, c, _) in want.items()}
    with pytest.raises(Exception, match="in their order"):
        chat_format.digests(parts.repartition(4, "part_no"), True).collect()


@pytest.mark.parametrize("whole", [0, 300, 1 << 16])
def test_examples_are_rows_and_give_the_transcript(whole, monkeypatch):
    """Every assistant turn is a row with its target; contexts, whole or continued, are those of the transcript."""
    monkeypatch.setattr(chat_format, "WHOLE", whole)
    r = random.Random(8)
    rows = [(i, k, r.choice(["user", "assistant"]), r.choice([CONTROL_TEXT, "", "é\n", "word " * 30])) for i in range(20) for k in range(r.randrange(1, 9))]
    turns = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["conv_id", "turn", "role", "text"])
    parts = list(chat_format._parts([turns]))
    spelled = list(chat_format._spelled(parts))
    found = pa.Table.from_batches(spelled).to_pylist()
    assert [(x["conv_id"], chat_format.unescaped(x["target"])) for x in found if x["target"] is not None] == [(i, t) for i, _, role, t in rows if role == "assistant"]
    assert {x["base"] is None for x in found if x["row_no"] and x["target"] is not None} == ({True} if whole > 9999 else {False} if not whole else {True, False})
    assert pa.Table.from_batches(chat_format._read_examples(spelled)).to_pylist() == pa.Table.from_batches(chat_format._digested(parts)).to_pylist()


# --- 10 --------------------------------------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base_personal(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", m) for m in EMAIL.finditer(t)] + [("ip", m) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m) for m in CARD.finditer(t) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", m) for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]
    return [f"{k}:{m.start()}:{m.end()}" for k, m in sorted(out, key=lambda x: (x[1].start(), pii.BASE.index(x[0])))]


def test_personal_data(spark, texts, none):
    cases = dict(texts)
    odd = [None, "", "a@b" + ".c" * 3000, "1" * 20_000, "+1" + " 1" * 9000, "x@y.z_q@w.e 😀 a@b.c", "4111 1111 1111 1111 and 000.001.255.256 1.2.3.4.5.6.7.8", " ".join(f"a{i}@b.co" for i in range(400))]
    odd += [rnd(rng.choice([3, 30, 200]), "a.@-+ 1234567890()..@@--12") for _ in range(150)]
    cases |= {10**6 + i: t for i, t in enumerate(odd)}
    df = spark.createDataFrame([(k, t, 0) for k, t in cases.items()], "doc_id long, text string, base int")
    for r in pii.find_personal_data(df).collect():
        want = base_personal(cases[r.doc_id] or "")
        assert r.base_sha256 == sha(",".join(want)) and set(want) <= set(r.spans.split(",")) | {""}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in want) for k in pii.BASE]
    assert pii.find_personal_data(none).count() == 0
    two = spark.createDataFrame([(1, "mail a.b@c.de now 1.2.3.4", 7), (None, None, 8)], "id int, text string, rank int")
    assert sorted(map(str, (tuple(r) for r in pii.redacted_documents(two).collect()))) == ["(1, 'mail [EMAIL] now [IP]', 7)", "(None, None, 8)"]


def test_planted_spans_are_added(spark):
    """Valid spans are added on any number of rows, however many codes of their shape fail the check."""
    valid = {
        "iban": "GB82 WEST 1234 5698 7654 32", "number_group": "4111.1111.1111.1111",
        "national_id": "123-45-6789", "spelled_email": "jo.doe [at] mail [dot] org",
    }
    wrong = ["code GB83 WEST 1234 5698 7654 32 here", "code 4111.1111.1111.1112 here", "code 000-45-6789 here"]
    r = random.Random(8)
    noise = [f"part GB{r.randrange(10, 99)} WEST {r.randrange(1000, 9999)} {r.randrange(1000, 9999)} no, {r.randrange(1000, 9999)}.1234.5678.{r.randrange(1000, 9999)}." for _ in range(400)]
    for more in ([], noise):
        rows = [*(f"see {v} there" for v in valid.values()), *wrong, *more]
        df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
        got = {x.doc_id: x.spans for x in pii.find_personal_data(df).where("doc_id < 7").collect()}
        for i, (kind, v) in enumerate(valid.items()):
            assert f"{kind}:4:{4 + len(v)}" in got[i].split(","), (kind, len(more), got[i])
        assert not any(got[i] for i in (4, 5, 6)), got


def test_documents_are_redacted(spark, docs, texts, odd, none):
    """All of ``documents`` with its columns: base spans go, plain prose stays as it is."""
    rows = pii.redacted_documents(docs).collect()
    assert pii.redacted_documents(docs).columns == docs.columns and len(rows) == len(texts)
    for r in rows:
        assert not base_personal(r.text or "")
        assert (r.text == texts[r.doc_id]) == (not base_personal(texts[r.doc_id] or "")), r.doc_id
    assert pii.redacted_documents(odd).columns == odd.columns and pii.redacted_documents(odd).count() == len(ODD)
    assert pii.redacted_documents(none).count() == 0
    plain = ["In 1998 some 12 000 people met; 3.14 and 2.71 were read out, see 4-5.", "Chapter 3-2, verse 12, at the 2024-01-05 meeting."]
    many = [("my mail is a [at] b [dot] org", "[SPELLED_EMAIL]"), ("write to " + "x" * 90 + "(at)" + "y" * 60 + "(dot)museum", "[SPELLED_EMAIL]"), ("pay NO93 8601 1117 947 now", "[IBAN]"), ("id 078-05-1120.", "[NATIONAL_ID]")]
    d = spark.createDataFrame([(i, t, t, 1) for i, t in enumerate([*plain, *(t for t, _ in many)])], "doc_id long, text string, row string, base int")
    got = {r.doc_id: r for r in pii.redacted_documents(d).collect()}
    assert all(got[i].text == t and got[i].row == t for i, t in enumerate(plain))
    assert all(mark in got[i + 2].text and got[i + 2].row == t for i, (t, mark) in enumerate(many)), got


def test_national_phones_by_their_cues(spark):
    rows = [f"call us by phone {20 + i % 70} {1000 + i} {2000 + i} now" for i in range(200)] + [f"lot {20 + i % 70} {3000 + i} {4000 + i} now" for i in range(200)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = [("national_phone" in x.spans, x.doc_id < 200) for x in pii.find_personal_data(df).collect()]
    assert all(a == b for a, b in got)


def test_boosting_learns_from_counts():
    counts = np.zeros((pii.CELLS, 2))
    counts[:, 1] = (np.arange(pii.CELLS) >> 7) & 1
    counts[:, 0] = 1 - counts[:, 1]
    trees = pii.boosted(counts, pii.Boosting())
    assert ((pii.scores(trees) > 0) == (counts[:, 1] == 1)).all()
    assert pii.thresholds(trees, counts, pii.Boosting())[0] > 0


# --- pipeline --------------------------------------------------------------------------------------------------


def test_pipeline(spark, docs, texts):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    at, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, SF)
        assert at.columns == docs.columns, name
        sizes.append(at.count())
    assert sizes[0] >= sizes[1] == sizes[2] > 0
    final = corpus_pipeline.run(spark, SF).collect()
    enc = bpe.encoding(*_ranks())
    want = Counter((r.doc_id, len(enc.encode_ordinary(r.text)), sha(r.text)) for r in at.collect())
    assert Counter((r.doc_id, r.n_tokens, r.decoded_sha256) for r in final) == want


def test_queries_cover_all_documents(spark, texts):
    assert len([n for n in QUERIES if re.match(r"op\d+_", n)]) == 10
    for name in ("op1_quality_rules", "op4_perplexity", "op6_mixing", "op8_secret_scan"):
        assert QUERIES[name](spark, SF).select("doc_id").distinct().count() == len(texts)
    assert F.col("x") is not None
