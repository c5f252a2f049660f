"""Projections and scalar functions over documents, pages and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.functions import dates, fingerprints, text, urls
from recordflow.operators import classify, context

from .adapters import OBS_SQL, observations, table
from .registry import query

# DuckDB spellings of the normal forms; the functions' accents are those that DuckDB strips from lower-case Latin text.
ALNUM = "trim(regexp_replace(strip_accents(lower({x})), '[^a-z0-9]+', ' ', 'g'))"
WS = r"trim(regexp_replace(strip_accents(lower({x})), '\s+', ' ', 'g'))"
CLEAN = r"trim(regexp_replace({x}, '\s+', ' ', 'g'))"
T_ALNUM, T_WS, T_CLEAN = (x.format(x="text") for x in (ALNUM, WS, CLEAN))


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query("norm_alnum", f"SELECT doc_id, {T_ALNUM} AS norm FROM documents")
def norm_alnum(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.norm_alnum(F.col("text")).alias("norm"))


@query("norm_alnum_any_script", f"SELECT doc_id, {T_ALNUM} AS norm FROM documents")
def norm_alnum_any_script(spark, sf_dir):
    folded = text.fold_any(F.col("text"))
    return docs(spark, sf_dir).select("doc_id", F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " ")).alias("norm"))


@query("norm_ws", f"SELECT doc_id, {T_WS} AS norm FROM documents")
def norm_ws(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.norm_ws(F.col("text")).alias("norm"))


@query("norm_eval", f"SELECT doc_id, translate({T_WS}, '–—', '--') AS norm FROM documents")
def norm_eval(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.norm_eval(F.col("text")).alias("norm"))


@query("clean_ws", f"SELECT doc_id, {T_CLEAN} AS norm FROM documents")
def clean_ws(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.squeeze(F.col("text")).alias("norm"))


SCRUB = [r"(?i)all rights reserved[^.]{0,80}\.?", r"(?i)licen[sc]ed under[^.]{0,120}\.?", r"https?://\S+"]


@query(
    "boilerplate_scrub",
    "SELECT doc_id, "
    + CLEAN.format(x="regexp_replace(regexp_replace(regexp_replace(text, '" + SCRUB[0] + "', ' ', 'g'), '" + SCRUB[1] + "', ' ', 'g'), '" + SCRUB[2] + "', ' ', 'g')")
    + " AS body FROM documents",
)
def boilerplate_scrub(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.scrub(F.col("text"), SCRUB).alias("body"))


@query("text_assembly", f"WITH {OBS_SQL} SELECT obs_ord, concat_ws(' ', nullif(title, ''), nullif(country, ''), nullif(detail_status, '')) AS joined FROM obs")
def text_assembly(spark, sf_dir):
    o = observations(spark, sf_dir)
    return o.select("obs_ord", text.assemble(F.col("title"), F.col("country"), F.col("detail_status")).alias("joined"))


PHRASES = ["thion", "eren", "que la", "der die", "password", "und"]


@query(
    "phrase_hits",
    "SELECT doc_id, list_filter([" + ", ".join(f"'{p}'" for p in PHRASES) + "], lambda p: contains(t, p)) AS hits FROM (SELECT doc_id, " + T_WS + " AS t FROM documents)",
)
def phrase_hits(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.phrase_hits(text.norm_ws(F.col("text")), PHRASES).alias("hits"))


LABELS = {"mail": r"[a-z0-9.]+@[a-z]", "number": r"[0-9]{6,}", "shout": "!!", "table": r"\|"}


@query(
    "regex_hits",
    "SELECT doc_id, list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{k}' END" for k, p in LABELS.items()) + "], lambda x: x IS NOT NULL) AS hits FROM documents",
)
def regex_hits(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.label_hits(F.col("text"), LABELS).alias("hits"))


@query(
    "snippet",
    """WITH t AS (SELECT doc_id, text, regexp_extract(text, 'thou|quel|schie') AS m FROM documents),
    u AS (SELECT *, CASE WHEN m = '' THEN 0 ELSE strpos(text, m) END AS pos FROM t)
    SELECT doc_id, CASE WHEN pos > 0 THEN substring(text, greatest(pos - 120, 1), pos - greatest(pos - 120, 1) + length(m) + 120) ELSE '' END AS snippet FROM u""",
)
def snippet(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.snippet(F.col("text"), "thou|quel|schie").alias("snippet"))


@query(
    "explicit_requirement",
    f"SELECT doc_id, regexp_matches(t, '(?s)(?:the|der|les).{{0,100}}(?:tion|ung)|(?:tion|ung).{{0,100}}(?:the|der|les)') AS required FROM (SELECT doc_id, {T_WS} AS t FROM documents)",
)
def explicit_requirement(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.near(text.norm_ws(F.col("text")), "the|der|les", "tion|ung").alias("required"))


_SENTENCES = "regexp_split_to_array(regexp_replace(text, '([.!?;])\\s+', '\\1' || chr(1), 'g'), chr(1))"


@query(
    "sentence_requirement",
    f"SELECT doc_id, len(list_filter({_SENTENCES}, lambda s: regexp_matches(s, 'tion') AND regexp_matches(s, 'the|la') AND NOT regexp_matches(s, 'and|et'))) > 0 AS required FROM documents",
)
def sentence_requirement(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.same_sentence(F.col("text"), "tion", "the|la", "and|et").alias("required"))


@query("sentence_count", f"SELECT doc_id, len({_SENTENCES})::BIGINT AS n FROM documents")
def sentence_count(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.size(text.sentences(F.col("text"))).cast("long").alias("n"))


SIGNALS = ["thou", "eren", "quel", "schie", "cion", "ment"]


@query(
    "distinct_signal_cluster",
    "SELECT doc_id, n, n >= 2 AS coherent FROM (SELECT doc_id, (" + " + ".join(f"regexp_matches(h, '{p}')::INT" for p in SIGNALS) + f")::BIGINT AS n FROM (SELECT doc_id, substring({T_WS}, 1, 6500) AS h FROM documents))",
)
def distinct_signal_cluster(spark, sf_dir):
    n = text.signal_count(text.norm_ws(F.col("text")), SIGNALS, 6500).cast("long")
    return docs(spark, sf_dir).select("doc_id", n.alias("n"), (n >= 2).alias("coherent"))


@query(
    "window_without_cue",
    "SELECT doc_id, len(list_filter(regexp_extract_all(text, '(?s).{0,90}(?:[Tt]hou).{0,90}'), lambda s: NOT regexp_matches(s, 'ing'))) > 0 AS uncovered FROM documents",
)
def window_without_cue(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.windows_without(F.col("text"), "[Tt]hou", "ing", 90).alias("uncovered"))


@query(
    "subject_title",
    r"SELECT page_id, trim(regexp_extract(t, '^(.*?)(?:(?i),\s*(?:school|faculty|department)\s+of\b.*)?$', 1)) AS subject FROM (SELECT page_id, 'Lecturer ' || page_id || ', School of ' || split_part(url, '/', 3) AS t FROM pages)",
)
def subject_title(spark, sf_dir):
    title = F.concat(F.lit("Lecturer "), F.col("page_id"), F.lit(", School of "), F.split_part("url", F.lit("/"), F.lit(3)))
    return table(spark, sf_dir, "pages").select("page_id", text.subject_title(title, "school|faculty|department").alias("subject"))


@query(
    "relevance_cut",
    """WITH t AS (SELECT doc_id, text, substring(text, 251, length(text)) AS tail FROM documents),
    u AS (SELECT *, regexp_extract(tail, '[Tt]he |[Dd]er |[Ll]a ') AS m FROM t)
    SELECT doc_id, CASE WHEN m <> '' THEN substring(text, 1, 250 + strpos(tail, m) - 1) ELSE text END AS relevant FROM u""",
)
def relevance_cut(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.relevance_text(F.col("text"), "[Tt]he |[Dd]er |[Ll]a ").alias("relevant"))


@query(
    "lookahead_mismatch",
    "SELECT doc_id, len(list_filter(regexp_extract_all(text, '(?s)tion.{0,100}'), lambda s: NOT contains(substring(s, 5), 'or'))) > 0 AS mismatch FROM documents",
)
def lookahead_mismatch(spark, sf_dir):
    spans = F.regexp_extract_all("text", F.lit("(?s)tion.{0,100}"), F.lit(0))
    miss = F.exists(spans, lambda s: ~F.contains(F.substring(s, 5, 200), F.lit("or")))
    return docs(spark, sf_dir).select("doc_id", miss.alias("mismatch"))


_REFS = [" (2024/15-AB)", " KU2023/118", " Ref. No-7781 and ref: x_91", "", " REFERENCE A/99-B 12/34/XY", " AB12 2024"]
_REF_TITLE = f"upper(source || {_REFS!r}[doc_id % {len(_REFS)} + 1] || '-' || doc_id)"


@query(
    "reference_tokens",
    rf"""SELECT doc_id, list_sort(list_distinct(list_transform({' || '.join(f"regexp_extract_all({_REF_TITLE}, '{p}')" for p in text.REFERENCES)}, lambda x: regexp_replace(x, '\s+', '', 'g')))) AS refs FROM documents""",
)
def reference_tokens(spark, sf_dir):
    ref = F.element_at(F.array(*[F.lit(x) for x in _REFS]), (F.col("doc_id") % len(_REFS) + 1).cast("int"))
    title = F.concat("source", ref, F.lit("-"), F.col("doc_id").cast("string"))
    return docs(spark, sf_dir).select("doc_id", text.references(title).alias("refs"))


SHINGLES_SQL = f"""toks AS (SELECT doc_id, list_filter(string_split({T_ALNUM}, ' '), lambda x: x <> '') AS w FROM documents),
  grams AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM toks WHERE len(w) >= 5))"""


@query("word_shingles", f"WITH {SHINGLES_SQL} SELECT doc_id, g AS shingle FROM grams")
def word_shingles(spark, sf_dir):
    w = text.words(text.norm_alnum(F.col("text")))
    return docs(spark, sf_dir).withColumn("w", w).select("doc_id", F.explode(text.shingles(F.col("w"))).alias("shingle"))


@query("simhash_exact")
def simhash_exact(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", fingerprints.simhash64(text.norm_alnum(F.col("text"))).alias("simhash"))


@query("hamming_pairs", "SELECT a.o_orderkey AS a, bit_count(xor(a.o_orderkey * 2654435761, a.o_custkey * 40503))::INT AS distance FROM orders a")
def hamming_pairs(spark, sf_dir):
    left = F.lpad(F.hex(F.col("o_orderkey") * 2654435761), 16, "0")
    right = F.lpad(F.hex(F.col("o_custkey") * 40503), 16, "0")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("a"), fingerprints.hamming(left, right).alias("distance"))


# URL parts by RE2: scheme, host, port, path, query
_URL = r"""u AS (SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '^www\.', '') AS host,
  regexp_extract(url, '^[a-z]+://[^/:?#]+(:\d+)', 1) AS port,
  regexp_replace(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/{2,}', '/', 'g'), '/+$', '') AS path,
  list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda x: x <> '') AS query FROM pages)"""


@query(
    "url_match_key",
    f"WITH {_URL}, k AS (SELECT *, array_to_string(list_sort(list_filter(query, lambda x: list_contains({list(urls.IDENTITY_KEYS)!r}, lower(split_part(x, '=', 1))))), '&') AS q FROM u) SELECT page_id, host || port || path || CASE WHEN q = '' THEN '' ELSE '?' || q END AS key FROM k",
)
def url_match_key(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.match_key(F.col("url")).alias("key"))


@query("url_state_key", f"WITH {_URL} SELECT page_id, host || port || path AS key FROM u")
def url_state_key(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.state_key(F.col("url")).alias("key"))


@query("url_generic", f"WITH {_URL} SELECT page_id, regexp_matches(lower(path), '^(?:.*(?:/jobs|/careers|/vacancies|/search))?$') AS generic FROM u")
def url_generic(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.is_generic(F.col("url")).alias("generic"))


@query(
    "url_tracking_strip",
    f"""WITH b AS (SELECT page_id, split_part(url, '#', 1) AS bare FROM pages),
    q AS (SELECT page_id, split_part(bare, '?', 1) AS path, array_to_string(list_filter(string_split(CASE WHEN contains(bare, '?') THEN substring(bare, length(split_part(bare, '?', 1)) + 2) ELSE '' END, '&'),
      lambda x: x <> '' AND NOT list_contains({list(urls.TRACKING_KEYS)!r}, lower(split_part(x, '=', 1)))), '&') AS kept FROM b)
    SELECT page_id, path || CASE WHEN kept = '' THEN '' ELSE '?' || kept END AS url FROM q""",
)
def url_tracking_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.without_tracking(F.col("url")).alias("url"))


@query("url_host_suffix", f"WITH {_URL} SELECT page_id, host, host = 'example.com' OR ends_with(host, '.example.com') AS inside FROM u")
def url_host_suffix(spark, sf_dir):
    h = urls.host(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", h.alias("host"), urls.in_domain(h, "example.com").alias("inside"))


@query(
    "url_next_page",
    r"SELECT page_id, CASE WHEN regexp_matches(url, '[?&]page=\d+') THEN regexp_replace(url, '([?&]page=)\d+', '\1' || (regexp_extract(url, '[?&]page=(\d+)', 1)::INT + 1)) WHEN contains(url, '?') THEN url || '&page=2' ELSE url || '?page=2' END AS next_url FROM pages",
)
def url_next_page(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.next_page(F.col("url")).alias("next_url"))


_SHOWN = """CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, 'Closing date: %-d %B %Y')
  WHEN 2 THEN strftime(ts, '%-d/%-m/%Y') WHEN 3 THEN 'yesterday' WHEN 4 THEN '3 days ago' ELSE 'rolling' END"""


@query(
    "day_iso_formats",
    f"""SELECT event_id, {_SHOWN} AS shown, CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m-%d')
    WHEN 2 THEN strftime(ts, '%Y-%m-%d') WHEN 3 THEN strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') WHEN 4 THEN strftime(ts - INTERVAL 3 DAY, '%Y-%m-%d') END AS day FROM events""",
)
def day_iso_formats(spark, sf_dir):
    kind = F.col("event_id") % 6
    shown = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == 1, F.concat(F.lit("Closing date: "), F.date_format("ts", "d MMMM yyyy")))
        .when(kind == 2, F.date_format("ts", "d/M/yyyy"))
        .when(kind == 3, "yesterday")
        .when(kind == 4, "3 days ago")
        .otherwise("rolling")
    )
    e = table(spark, sf_dir, "events").select("event_id", "ts", shown.alias("shown"))
    return e.select("event_id", "shown", dates.day_iso(F.col("shown"), F.col("ts")).alias("day"))


@query(
    "deadline_display",
    "SELECT o_orderkey, CASE WHEN d < 0 THEN 'past' WHEN d = 0 THEN 'today' WHEN d <= 7 THEN 'week' ELSE 'later' END AS shown FROM (SELECT o_orderkey, date_diff('day', DATE '1998-01-01', o_orderdate::DATE) AS d FROM orders)",
)
def deadline_display(spark, sf_dir):
    shown = dates.deadline_label(F.to_date("o_orderdate"), F.lit("1998-01-01").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", shown.alias("shown"))


@query("iso_parse", "SELECT event_id, epoch_us(ts)::BIGINT AS micros FROM events")
def iso_parse(spark, sf_dir):
    shown = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return table(spark, sf_dir, "events").select("event_id", F.unix_micros(dates.instant(shown)).alias("micros"))


@query("digests_ids", "SELECT doc_id, 'can_' || substring(sha1(source || '|' || doc_id), 1, 20) AS canonical_id, sha256(text) AS body_sha256 FROM documents")
def digests_ids(spark, sf_dir):
    cid = fingerprints.short_id("can_", F.col("source"), F.col("doc_id").cast("string"))
    return docs(spark, sf_dir).select("doc_id", cid.alias("canonical_id"), F.sha2("text", 256).alias("body_sha256"))


@query("cache_fingerprint", """SELECT conv_id, turn, sha256('{"model":"m1","role":"' || role || '","turn":' || turn || '}') AS fingerprint FROM conversations""")
def cache_fingerprint(spark, sf_dir):
    fp = fingerprints.request_digest(role=F.col("role"), turn=F.col("turn"), model=F.lit("m1"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", fp.alias("fingerprint"))


@query("json_size", """SELECT event_id, strlen('{"event_id":' || event_id || ',"event_type":"' || event_type || '"}')::BIGINT AS bytes FROM events""")
def json_size(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", fingerprints.json_size(F.col("event_id"), F.col("event_type")).alias("bytes"))


@query("canonical_json_id")
def canonical_json_id(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", fingerprints.canonical_json_sha1(F.col("props")).alias("id"))


@query(
    "label_between",
    r"SELECT event_id, trim(regexp_extract(t, 'Kind:\s*(.*?)(?:Amount|Ends|$)', 1)) AS kind FROM (SELECT event_id, 'Kind: ' || event_type || ' Amount: ' || event_id || ' Ends: soon' AS t FROM events)",
)
def label_between(spark, sf_dir):
    t = F.concat(F.lit("Kind: "), "event_type", F.lit(" Amount: "), "event_id", F.lit(" Ends: soon"))
    return table(spark, sf_dir, "events").select("event_id", text.between_labels(t, "Kind", ["Amount", "Ends"]).alias("kind"))


@query("safe_segment", r"SELECT page_id, regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g') AS segment, CASE WHEN regexp_matches(url, '^[=+\-@]') THEN '''' || url ELSE url END AS cell FROM pages")
def safe_segment(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.safe_segment(F.col("url")).alias("segment"), text.cell_text(F.col("url")).alias("cell"))


@query("country_infer", f"WITH {OBS_SQL} SELECT obs_ord, CASE WHEN country IN ('GB', 'DE') THEN country WHEN regexp_matches(lower(body), '(^|[^\\p{{L}}\\p{{N}}_])que([^\\p{{L}}\\p{{N}}_]|$)') THEN 'ES' WHEN regexp_matches(lower(body), '(^|[^\\p{{L}}\\p{{N}}_])les([^\\p{{L}}\\p{{N}}_]|$)') THEN 'FR' END AS inferred FROM obs")
def country_infer(spark, sf_dir):
    o = observations(spark, sf_dir)
    known = F.when(F.col("country").isin("GB", "DE"), F.col("country"))
    names = [("que", "ES"), ("les", "FR")]
    return o.select("obs_ord", classify.country(known, F.lower("body"), names).alias("inferred"))


@query("market_tier", f"WITH {OBS_SQL} SELECT obs_ord, CASE WHEN country IN ('GB', 'DE') THEN 'CORE' WHEN country = 'FR' THEN 'SECONDARY' WHEN country IS NULL THEN 'UNKNOWN' ELSE 'OTHER' END AS tier, detail_status FROM obs")
def market_tier(spark, sf_dir):
    o = observations(spark, sf_dir)
    return o.select("obs_ord", classify.tier(F.col("country"), {"CORE": ["GB", "DE"], "SECONDARY": ["FR"]}).alias("tier"), "detail_status")


_MESSAGES = ["", "Access Denied", "read timed out", "Too many requests", "captcha shown", "connection refused", "Unknown production shard x", "failed", "blocked by policy", "no DNS answer"]
_STATUSES = [0, 429, 503, 404, 0, 599, 600]
_TYPES = ["", "ReadTimeout", "ProxyError", "JSONDecodeError", "KeyError", "ValueError", "InvalidArtifact", "FileNotFoundError", "", "", ""]
_CODES = ["", "", "SignatureDoesNotMatch", "", ""]


@query(
    "failure_class",
    f"""WITH e AS (SELECT event_id, lower({_MESSAGES!r}[event_id % {len(_MESSAGES)} + 1]) AS m, {_STATUSES!r}[event_id // 3 % {len(_STATUSES)} + 1] AS s, lower({_TYPES!r}[event_id // 2 % {len(_TYPES)} + 1]) AS t, {_CODES!r}[event_id // 5 % {len(_CODES)} + 1] AS c FROM events)
    SELECT event_id, CASE WHEN c <> '' OR m = 'access denied' THEN 'AUTH_PERMISSION' WHEN s = 429 OR m = 'too many requests' THEN 'RATE_LIMIT' WHEN s IN (503, 599) THEN 'UPSTREAM_5XX'
      WHEN t = 'readtimeout' OR m = 'read timed out' THEN 'TIMEOUT' WHEN m IN ('captcha shown', 'blocked by policy') THEN 'BLOCKED_ANTI_BOT' WHEN t = 'proxyerror' OR m IN ('connection refused', 'no dns answer') THEN 'NETWORK_TRANSPORT'
      WHEN t = 'jsondecodeerror' THEN 'PARSER_SCHEMA' WHEN t = 'keyerror' OR m LIKE 'unknown production shard%' THEN 'CONFIGURATION' WHEN t = 'invalidartifact' THEN 'INVALID_ARTIFACT' WHEN t = 'filenotfounderror' THEN 'MISSING_ARTIFACT' ELSE 'UNKNOWN' END AS failure FROM e""",
)
def failure_class(spark, sf_dir):
    pick = lambda v, by: F.element_at(F.array(*[F.lit(x) for x in v]), (F.floor(F.col("event_id") / by) % len(v) + 1).cast("int"))
    found = classify.failure(pick(_MESSAGES, 1), pick(_STATUSES, 3), pick(_TYPES, 2), pick(_CODES, 5))
    return table(spark, sf_dir, "events").select("event_id", found.alias("failure"))


@query(
    "status_lattice",
    """SELECT user_id, CASE WHEN bool_and(event_type <> 'error') THEN 'OK' WHEN bool_or(event_type <> 'error') THEN 'PARTIAL' ELSE 'ERROR' END AS status FROM events GROUP BY user_id""",
)
def status_lattice(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("status", F.when(F.col("event_type") == "error", "ERROR").otherwise("OK"))
    return e.groupBy("user_id").agg(classify.status_of(F.col("status")).alias("status"))


@query(
    "title_filters",
    f"WITH {OBS_SQL} SELECT obs_ord, regexp_matches(t, 'ung|tion') AND NOT regexp_matches(t, 'ver') AS excluded FROM (SELECT obs_ord, {WS.format(x='title')} AS t FROM obs)",
)
def title_filters(spark, sf_dir):
    t = text.norm_ws(F.col("title"))
    return observations(spark, sf_dir).select("obs_ord", (t.rlike("ung|tion") & ~t.rlike("ver")).alias("excluded"))


@query(
    "context_clean",
    r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM documents),
    c AS (SELECT doc_id, pos, trim(regexp_replace(line, '\s+', ' ', 'g')) AS line FROM l),
    k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS rn FROM c WHERE line <> '')
    SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (length(line) < 24 OR rn = 1), '') AS body FROM k GROUP BY doc_id""",
)
def context_clean(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", context.cleaned(F.col("text")).alias("body")).where("body <> '' OR body IS NOT NULL")


@query(
    "section_extract",
    r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM documents),
    h AS (SELECT doc_id, pos, line, CASE WHEN length(line) BETWEEN 1 AND 12 THEN line END AS head FROM l),
    s AS (SELECT doc_id, pos, line, head, last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS section FROM h)
    SELECT doc_id, coalesce(section, '') AS section, count(*) FILTER (head IS NULL AND line <> '') AS n_lines FROM s GROUP BY ALL""",
)
def section_extract(spark, sf_dir):
    return context.section_sizes(docs(spark, sf_dir), "doc_id", "text", longest_heading=12)
