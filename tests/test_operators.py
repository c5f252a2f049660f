"""Operators against scalar models on small fixtures."""

import random
from datetime import date
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from recordflow.functions import dates, fingerprints, text, urls
from recordflow.operators import classify, joins, linkage, measures, rules, sampling, state
from recordflow.sources import bundles, html, paginated
from recordflow.sources.shared import shared_dir, use_checkpoints


def values(spark, column, *rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(column).collect()]


def test_text(spark):
    x = F.col("x")
    assert values(spark, text.norm_alnum(x), ("  Ünï-Códe 9!",), (None,)) == ["uni code 9", ""]
    assert values(spark, F.size(text.shingles(text.words(x), 5)), ("a b c d",), ("a b c d e f",), ("",)) == [0, 2, 0]
    assert values(spark, text.subject_title(x, "school|department"), ("Reader, School of Law",)) == ["Reader"]


def test_urls(spark):
    x = F.col("x")
    keys = values(spark, urls.match_key(x), ("HTTPS://www.A.org:8080//b//c/?utm_source=1&id=3&a=2#f",), (None,), ("not a url",))
    assert keys == ["a.org:8080/b/c?id=3", "", ""]
    assert values(spark, urls.without_tracking(x), ("http://a/b?x=1&gclid=2",)) == ["http://a/b?x=1"]
    assert values(spark, urls.next_page(x), ("http://a?page=9",), ("http://a",)) == ["http://a?page=10", "http://a?page=2"]


def test_dates(spark):
    at = F.lit("2024-03-01 10:00:00").cast("timestamp")
    shown = [("1st May 2024",), ("yesterday",), ("30+ days ago",), ("2/1/2024",), ("soon",), (None,), ("2024-05-06T23:00:00-09:00",)]
    assert values(spark, dates.day_iso(F.col("x"), at), *shown) == ["2024-05-01", "2024-02-29", "2024-01-31", "2024-01-02", None, None, "2024-05-06"]


def test_hamming(spark):
    assert values(spark, fingerprints.hamming(F.col("x"), F.lit("ffffffffffffffff")), ("0" * 16,), ("f" * 16,), ("",)) == [64, 0, 0]


def test_failures(spark):
    got = values(spark, classify.failure(F.col("x"), F.col("y")), ("Read timed out", 503), ("Read timed out", 404), ("oops", None), (None, None), schema="x string, y int")
    assert got == ["UPSTREAM_5XX", "TIMEOUT", "UNKNOWN", "UNKNOWN"] and set(got) <= set(classify.FAILURES)


def test_decision_list(spark):
    x = F.col("x")
    r = [
        rules.Rule("note", x > 0, {"out": F.lit("noted")}, terminal=False),
        rules.Rule("stop", x > 5, {"out": F.lit("stopped")}),
        rules.Rule("late", x > 0, {"out": F.lit("late")}),
    ]
    df = spark.createDataFrame([(0,), (3,), (9,), (None,)], "x int")
    got = {a["x"]: (a["out"], a["fired"]) for a in rules.decide(df, r, {"out": F.lit("none")}).collect()}
    assert got == {0: ("none", []), 3: ("late", ["note", "late"]), 9: ("stopped", ["note", "stop"]), None: ("none", [])}


def test_balance_is_a_clamped_counter(spark):
    rng, rows, want = random.Random(1), [], {}
    for k in range(40):
        level = orphans = 0
        for i in range(rng.randrange(1, 25)):
            d = rng.choice([1, -1, 0])
            rows.append((k, i, d))
            if level + d < 0:
                orphans += 1
            else:
                level += d
        want[k] = (orphans, level)
    df = spark.createDataFrame(rows, "k int, i int, d int")
    got = {r.k: (r.orphan_done, r.incomplete) for r in sampling.balance(df, "k", ["i"], F.col("d")).collect()}
    assert got == want


def test_percentile_takes_the_nearest_rank(spark):
    xs = [random.Random(2).randrange(9) for _ in range(30)]
    got = measures.nearest_rank(spark.createDataFrame([(1, x) for x in xs], "g int, v int"), "g", "v", [0.0, 0.5, 0.9, 1.0])
    assert {r.p: r.value for r in got.collect()} == {p: sorted(xs)[round(29 * p)] for p in (0.0, 0.5, 0.9, 1.0)}


def test_greedy_clusters(spark):
    """The oldest matching cluster wins, and clusters never merge later."""
    use_checkpoints(spark)
    rng = random.Random(3)
    pairs = {tuple(sorted(rng.sample(range(30), 2))) for _ in range(28)}
    plain: list[list[int]] = []
    for n in range(30):
        home = next((c for c in plain if any((m, n) in pairs for m in c)), None)
        plain.append([n]) if home is None else home.append(n)
    f = spark.createDataFrame([(i,) for i in range(30)], "obs_ord long")
    got = linkage.clusters(f, spark.createDataFrame(sorted(pairs), "a long, b long")).collect()
    assert {r.obs_ord: r.cluster for r in got} == {m: c[0] for c in plain for m in c}


def test_containment_at_the_threshold(spark):
    """Pairs that share exactly 55 of 100 shingles are found where 0.55 * n lies above its whole number in doubles."""
    rows = []
    for at, n in enumerate((20, 100, 180, 200, 220, 340)):
        common = [at * 10_000 + i for i in range(n * 55 // 100)]
        for side in (0, 1):
            alone = [at * 10_000 + 1000 * (side + 1) + i for i in range(n - len(common))]
            rows.append((2 * at + side, common + alone))
        rows.append((100 + at, common[1:] + [at * 10_000 + 5000 + i for i in range(n - len(common) + 1)]))  # one too few
    got = linkage.containment_pairs(spark.createDataFrame(rows, "obs_ord long, grams array<long>"), 0.55)
    assert {(r.a, r.b): r.containment for r in got.collect()} == {(2 * i, 2 * i + 1): 0.55 for i in range(6)}


def test_components_of_long_paths(spark):
    """Paths of 300 nodes, one in an order that lets labels creep, are one component each; no node is in two clusters."""
    use_checkpoints(spark)
    one = list(range(300))
    two = [1000 + i for i in one]
    random.Random(7).shuffle(two)
    links = [tuple(sorted(p)) for path in (one, two) for p in zip(path, path[1:])]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in linkage.components(df).collect()}
    assert got == {x: x // 1000 * 1000 for x in (*one, *two)}
    with pytest.raises(RuntimeError):
        linkage.components(df, 3)
    f = spark.createDataFrame([(x,) for x in got], "obs_ord long")
    rows = linkage.clusters(f, df).collect()
    assert len(rows) == len({r.obs_ord for r in rows}) == 600


def test_title_ratio_keeps_its_order(spark):
    a, b = "tide", "diet"
    got = values(spark, linkage.title_ratio(F.col("x"), F.col("y")), (a, b), (b, a), schema="x string, y string")
    assert got == [SequenceMatcher(None, a, b).ratio(), SequenceMatcher(None, b, a).ratio()]


def _crowd(spark):
    """Observations of few titles, references and URLs, with copies and near copies in two countries and four sources."""
    rng = random.Random(5)
    bodies = [[f"w{rng.randrange(400)}" for _ in range(40)] for _ in range(4)]
    rows = []
    for i in range(160):
        body = list(rng.choice(bodies))
        for _ in range(rng.choice((0, 0, 1, 2, 3))):
            body[rng.randrange(40)] = f"x{rng.randrange(50)}"
        title = rng.choice(("Post in chemistry and physics at a large school, ref. no-7781", "Post in chemistry and physics at a large schools, ref. no-7781", "Other"))
        url = f"https://a.org/{rng.randrange(5)}" if rng.random() < 0.1 else None
        rows.append((i, rng.choice("abcd"), i // 2 if i % 9 == 0 else i, title, rng.choice(("GB", "DE", None)), " ".join(body), url, rng.choice(("North", "North East", "")), rng.choice(("FULL", "UNAVAILABLE", "PARTIAL"))))
    return spark.createDataFrame(rows, "obs_ord long, source_key string, source_job_id long, title string, country string, body string, url string, institution string, detail_status string")


def test_classes_give_the_clusters_of_pairs(spark):
    use_checkpoints(spark)
    f = linkage.features(_crowd(spark))
    pairs = linkage.edges(f).collect()
    assert {r.rule for r in pairs} == {"URL", "REF", "TITLE", "RATIO"} and len(pairs) == len({(r.a, r.b) for r in pairs})
    want: dict[int, int] = {}
    for n in range(160):
        want[n] = min((want[r.a] for r in pairs if r.b == n), default=n)
    members, links = linkage.class_links(f)
    got = {r.obs_ord: r.cluster for r in linkage.clusters(f, links, members).collect()}
    assert got == want


def test_class_links_lose_no_pair_and_no_rule(spark):
    use_checkpoints(spark)
    f = linkage.features(_crowd(spark))
    members, links = (x.collect() for x in linkage.class_links(f))
    of: dict[int, list[int]] = {}
    for r in members:
        of.setdefault(r.g, []).append(r.obs_ord)
    rank = ["URL", "REF", "TITLE", "RATIO"]
    got: dict[tuple[int, int], str] = {}
    for r in links:
        for a in of[r.x]:
            for b in of[r.y]:
                if a < b:
                    got[a, b] = min(got.get((a, b), r.rule), r.rule, key=rank.index)
    assert got == {(r.a, r.b): r.rule for r in linkage.edges(f).collect()}


def test_titles_of_one_text_make_no_shingles(spark, monkeypatch):
    """Without the rule on nearly equal titles, shingles are made where a title has two texts, and once for equal texts."""
    use_checkpoints(spark)
    words = [" ".join(f"{c}{i}" for i in range(30)) for c in "xyz"]
    rows = [(0, "a", 1, "One", "GB", words[0]), (1, "b", 2, "Two", "GB", words[1]), (2, "c", 3, "Two", "GB", words[1].upper() + "!"),
            (3, "d", 4, "Three", "GB", words[2]), (4, "e", 5, "Three", "GB", words[2]), (5, "f", 6, "Three", "GB", words[2] + " more")]
    obs = spark.createDataFrame(rows, "obs_ord long, source_key string, source_job_id long, title string, country string, body string").withColumn("detail_status", F.lit("FULL"))
    f = linkage.features(obs)
    want = {(r.a, r.b, r.rule) for r in linkage.edges(f, near=False).collect()}
    assert {x[:2] for x in want} == {(1, 2), (3, 4), (3, 5), (4, 5)}
    made = spark.sparkContext.accumulator(0)
    count, grams = F.udf(lambda g: made.add(1) or g, "array<bigint>"), linkage._grams
    monkeypatch.setattr(linkage, "_grams", lambda x: count(grams(x)))
    got = {(r.a, r.b, r.rule) for r in linkage.edges(linkage.features(obs), near=False).collect()}
    assert got == want and made.value == 2


def test_pairs_of_titles_are_settled_where_their_texts_are(spark):
    """The rule on titles gives what a plain comparison gives, and no pair of texts is dealt again to be judged."""
    use_checkpoints(spark)
    obs = _crowd(spark)
    f = linkage.features(obs)
    found = linkage.edges(f, near=False)
    assert "containment" not in found._jdf.queryExecution().toString()  # pairs with it met what they are judged by in two joins
    got = [(r.a, r.b, r.rule) for r in found.collect()]
    rows = sorted((r for r in f.drop("grams").collect()), key=lambda r: r.obs_ord)
    sets = {r.obs_ord: {tuple(w[i : i + 5]) for w in [r.body.lower().split()] for i in range(len(w) - 4)} for r in rows}
    want = set()
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            one = a.source_key == b.source_key and a.source_job_id != b.source_job_id or a.country and b.country and a.country != b.country
            if one or set(a.url_keys) & set(b.url_keys) or a.title_key != b.title_key or not (a.resolved and b.resolved) or a.refs and b.refs and not set(a.refs) & set(b.refs):
                continue
            x, y = sets[a.obs_ord], sets[b.obs_ord]
            c, p, q = len(x & y) / min(len(x), len(y)), a.institution_key, b.institution_key
            if c >= 0.7 or c >= 0.55 and p and q and SequenceMatcher(None, p, q).ratio() >= 0.9:
                want.add((a.obs_ord, b.obs_ord, "TITLE"))
    assert {x for x in got if x[2] == "TITLE"} == want and len(want) > 100 and len(got) == len(set(got))


def test_one_reference_is_few_class_links(spark):
    """300 observations of one reference and URL are some pairs of classes, not of observations."""
    use_checkpoints(spark)
    rows = [(i, "abc"[i % 3], i, "Post, ref. no-7781", "GB", "", "https://a.org/1", "North", "UNAVAILABLE") for i in range(300)]
    f = linkage.features(spark.createDataFrame(rows, _crowd(spark).schema))
    members, links = linkage.class_links(f)
    assert links.count() <= 18
    got = linkage.clusters(f, links, members).collect()
    assert len(got) == 300 and {r.cluster for r in got} == {0}


def test_url_links_are_the_pairs_of_one_rule(spark):
    """No text is read for them: shingles that fail when made are never made."""
    use_checkpoints(spark)
    f = linkage.features(_crowd(spark))
    want = {(r.a, r.b) for r in linkage.edges(f).where("rule = 'URL'").collect()}
    broken = f.withColumn("grams", F.array(F.raise_error(F.lit("made")).cast("long")))
    got = [(r.a, r.b) for r in linkage.url_links(broken).collect()]
    assert set(got) == want and len(got) == len(want) > 0


def test_linkage_rules(spark):
    use_checkpoints(spark)
    body = " ".join(f"w{i}" for i in range(40))
    rows = [
        (0, "a", 1, "Post AB12", "GB", body, None), (1, "b", 2, "Post AB12", "GB", body, None),  # one title, one text
        (2, "a", 3, "Post AB12", "GB", body, None),  # another id of one source: never with 0
        (3, "c", 4, "Post AB12", "DE", body, None),  # another country
        (4, "d", 5, "Other", None, "x", "https://a.org/1"), (5, "e", 6, "Thing", None, "y", "http://www.a.org/1/"),
    ]
    obs = spark.createDataFrame(rows, "obs_ord long, source_key string, source_job_id long, title string, country string, body string, url string")
    got = linkage.edges(linkage.features(obs.withColumn("detail_status", F.lit("FULL")))).collect()
    assert {(r.a, r.b): r.rule for r in got} == {(0, 1): "TITLE", (1, 2): "TITLE", (4, 5): "URL"}


def test_fold_equals_replay(spark):
    rng = random.Random(4)
    rows = [
        (i, date(2024, 1, 1 + d), rng.choice(["OPEN", "CLOSED"]), rng.random() < 0.6, float(rng.randrange(3)), rng.choice("ab"))
        for i in range(20) for d in range(5) if rng.random() < 0.7
    ]
    seen = spark.createDataFrame(rows, "id long, generation date, lifecycle string, resolved boolean, value double, detail string")
    now = spark.createDataFrame([], state.EMPTY_STATE)
    for d in range(5):
        now = state.step(now, seen.where(F.dayofmonth("generation") == d + 1))
    last = state.replay(seen).groupBy("id").agg(F.max_by(F.struct("times_seen", "lifecycle", "value", "event"), "generation").alias("x"))
    want = {r.id: tuple(r.x) for r in last.collect()}
    assert {r.id: (r.times_seen, r.lifecycle, r.value, r.event) for r in now.collect()} == want


def test_completeness_is_enforced(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1,)], "k int")
    with pytest.raises(Exception, match="no partner"):
        joins.complete(a, b, "k").collect()


@pytest.mark.parametrize(
    ("pages", "limits", "want"),
    [
        ([["a"], []], {}, ("empty_page", True, 1)),
        ([["a"], ["a"]], {}, ("repeated_page", False, 1)),
        ([["a"], ["b"], ["c"]], {"max_pages": 2}, ("configured_page_limit", False, 2)),
        ([["a", "b", "c"]], {"max_records": 2}, ("configured_record_limit", False, 2)),
        ([["a"], None], {}, ("request_failed", False, 1)),
        ([["a"], ["b"], None], {"window": lambda pages, e: pages == 2}, ("known_result_window_limit", True, 2)),
        ([["a"], ["b"], None], {"window": lambda pages, e: pages == 3}, ("request_failed", False, 2)),
        ([(["a"], 10, None), []], {}, ("empty_page", False, 1)),
        ([(["a", "b"], 2, None)], {"max_records": 2}, ("advertised_total_reached", True, 2)),
        ([(["a", "b"], 5, None), (["c", "d"], 0, None), (["e"], 0, None)], {}, ("advertised_total_reached", True, 5)),
        ([(["a"], 3, True), (["b"], None, False)], {}, ("last_page", False, 2)),
        ([(["a"], None, True), (["b"], None, False)], {}, ("last_page", True, 2)),
        ([["a"]] + [[str(i)] for i in range(1500)] + [[]], {}, ("empty_page", True, 1501)),
    ],
)
def test_pagination_stops(spark, pages, limits, want):
    def fetch(n):
        p = pages[n - 1]  # a missing page raises
        rows, total, more = p if isinstance(p, tuple) else (p, None, None)
        return [(x, x) for x in rows], total, more

    rows, why, complete = paginated.paginate(fetch, **limits)
    assert (why, complete, len(rows)) == want


def test_a_failed_first_page_is_no_empty_listing(spark):
    def fetch(n):
        raise TimeoutError("no answer")

    with pytest.raises(paginated.FirstPageFailed):
        paginated.paginate(fetch)
    stored = spark.createDataFrame(
        [("a", 1, None, None, None, "no answer"), ("b", 1, [("x", "1")], 1, None, None), ("c", 1, [], None, None, None)],
        "listing string, page int, rows array<struct<id:string,payload:string>>, total long, has_next boolean, error string",
    )
    got = {r.listing: r for r in paginated.scan_stored(stored).where("stop_reason IS NOT NULL").collect()}
    assert (got["a"].stop_reason, got["a"].complete, got["a"].pages) == ("request_failed", False, 0) and "no answer" in got["a"].error
    assert (got["b"].stop_reason, got["b"].complete, got["b"].advertised_total) == ("advertised_total_reached", True, 1)
    assert (got["c"].stop_reason, got["c"].complete) == ("empty_page", True)


def test_listings_are_a_data_source(spark):
    spark.dataSource.register(paginated.PaginatedSource)
    read = spark.read.format("paginated").option("listings", "list-7,list-3").option("fetch", "recordflow.sources.paginated:demo_fetch")
    got = {r.listing: r.n for r in read.load().groupBy("listing").agg(F.count("id").alias("n")).collect()}
    assert got == {"list-7": 7, "list-3": 3}
    assert read.option("limit", "2").load().where("stop_reason = 'configured_record_limit'").count() == 2


def test_html():
    page = '<nav><a href="/x">x</a></nav><main>Hi <b>there</b></main><a href="?page=2" rel="next">go</a><script type="application/ld+json">{"@graph":[{"@type":"JobPosting","title":"T"}]}</script>'
    assert html.page_text(page) == "Hi there"
    assert html.next_link("http://a.org/l?page=1", page) == "http://a.org/l?page=2"
    assert html.structured(page, "JobPosting") == '{"@type":"JobPosting","title":"T"}'
    assert html.page_text(None) == "" and html.next_link("http://a.org", "<a href=") is None


def test_state_commits_exclude_each_other(spark):
    root = shared_dir(spark, "state")
    df = spark.range(3)
    assert bundles.load_state(spark, root) is None
    assert bundles.publish_state(df, root, 0) == 1
    with pytest.raises(bundles.Conflict):
        bundles.publish_state(spark.range(9), root, 0)
    assert bundles.load_state(spark, root).count() == 3
    assert bundles.publish_state(spark.range(5), root, 1) == 2
    assert bundles.restore(spark, root, 1) == 3 and bundles.load_state(spark, root).count() == 3


def test_damaged_bundle_is_left_out(spark):
    root = shared_dir(spark, "bundles")
    for s in "ab":
        bundles.write_bundle(spark.range(4), root, "r", s)
    spark.range(1).write.mode("append").parquet(f"{root}/run_id=r/shard_id=b/records")
    records, status = bundles.fan_in(spark, root, "r")
    assert status == "PARTIAL" and records.count() == 4
