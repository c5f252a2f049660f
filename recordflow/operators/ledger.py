"""A durable ledger of postings: identity by aliases, snapshots, change reasons, events.

One batch of observations is folded into the ledger by joins alone: an observation belongs to the entry that owns one
of its aliases.  Aliases that several entries own tell nothing.  An observation whose aliases lead to different entries, and
two observations of one batch that lead to the same one, are errors: they would make the ledger depend on their order.
Entries that are not observed stay as they are; absence closes nothing.

Records have the columns ``record_id``, ``aliases`` (structs of rank and alias, strongest first, as of
``collection.aliases``) and ``snapshot`` (as of ``snapshot``).  Null aliases are no identity and raise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordflow.functions import fingerprints, text

from .state import changed

# Statuses, field groups and the distance from which a detail counts as another one.
GOOD_DETAIL = ("FULL", "PARTIAL")
STABLE = ("title", "institution", "department", "country_code", "city", "role_family", "role_level")
ENRICHED = ("employment_type", "workplace_mode", "deadline_at", "deadline_status", "contract_term", "duration_months", "fte", "lifecycle_status")
CARRIED = (
    "employment_type", "workplace_mode", "deadline_at", "deadline_status", "contract_term", "duration_months", "fte",
    "detail_status", "detail_simhash", "detail_words", "recommendation", "dimensions",
)
MATERIAL_DISTANCE = 14
WRITER_ROLE = "CENTRAL_FINALIZER"
SNAPSHOT = (
    "struct<title:string,institution:string,department:string,country_code:string,city:string,role_family:string,role_level:string,"
    "employment_type:string,workplace_mode:string,deadline_at:string,deadline_status:string,contract_term:string,"
    "duration_months:double,fte:double,lifecycle_status:string,detail_status:string,detail_simhash:string,detail_words:long,"
    "recommendation:string,dimensions:string>"
)
LEDGER = (
    f"state_id string, aliases array<string>, first_seen_at timestamp, last_seen_at timestamp, times_seen long,"
    f" lifecycle_status string, snapshot {SNAPSHOT}, last_event string, change_reasons array<string>"
)


def lifecycle(status: Column) -> Column:
    """OPEN and CLOSED as the source says, anything else is UNKNOWN."""
    s = F.upper(F.coalesce(status, F.lit("")))
    return F.when(s.isin("OPEN", "CLOSED"), s).otherwise("UNKNOWN")


def snapshot(of: dict[str, Column]) -> Column:
    """The compared values of a record in normal form; ``of`` names the raw columns, what it lacks is missing."""
    null = F.lit(None)
    raw = lambda name, kind="string": of.get(name, null).cast(kind)
    plain = ("title", "institution", "department", "city")
    upper = {"country_code": "", **dict.fromkeys(("role_family", "role_level", "employment_type", "workplace_mode", "deadline_status", "contract_term"), "UNKNOWN")}
    status = F.upper(F.coalesce(F.nullif(raw("detail_status"), F.lit("")), F.lit("NOT_ATTEMPTED")))
    kept = status.isin(*GOOD_DETAIL)
    body = text.norm_ws(F.coalesce(raw("detail"), F.lit("")))
    words = F.when(kept & (body != ""), F.size(F.split(body, " "))).otherwise(0)
    values = {
        **{c: text.norm_ws(F.coalesce(raw(c), F.lit(""))) for c in plain},
        **{c: F.upper(F.coalesce(F.nullif(raw(c), F.lit("")), F.lit(d))) for c, d in upper.items()},
        "deadline_at": F.coalesce(raw("deadline_at"), F.lit("")),
        "duration_months": raw("duration_months", "double"),
        "fte": raw("fte", "double"),
        "lifecycle_status": lifecycle(raw("source_status")),
        "detail_status": status,
        "detail_simhash": F.when(kept, of["detail_simhash"] if "detail_simhash" in of else fingerprints.simhash64(body)).otherwise(""),
        "detail_words": of["detail_words"] if "detail_words" in of else words,
        "recommendation": F.upper(F.coalesce(raw("recommendation"), F.lit(""))),
        "dimensions": raw("dimensions"),
    }
    order = [x.split(":")[0].removeprefix("struct<") for x in SNAPSHOT.split(",")]
    return F.struct(*[values[c].alias(c) for c in order]).cast(SNAPSHOT)


def resolved(s: Column) -> Column:
    return F.coalesce(s["detail_status"].isin(*GOOD_DETAIL) & (s["detail_words"] > 0), F.lit(False))


def change_reasons(old: Column, new: Column) -> Column:
    """Names of the fields that differ; enriched ones count only while the detail has not been lost."""
    degraded = resolved(old) & ~resolved(new)
    both = resolved(old) & resolved(new)
    said = lambda c: (F.coalesce(old[c], F.lit("")) != "") & (F.coalesce(new[c], F.lit("")) != "")
    far = fingerprints.hamming(old["detail_simhash"], new["detail_simhash"]) >= MATERIAL_DISTANCE
    found = [
        *[F.when(changed(old[c], new[c]), c) for c in STABLE],
        *[F.when(~degraded & changed(old[c], new[c]), c) for c in ENRICHED],
        F.when(both & said("detail_simhash") & far, "full_jd"),
        F.when(both & said("recommendation") & (old["recommendation"] != new["recommendation"]), "recommendation"),
    ]
    return F.array_compact(F.array(*found))


def stored(old: Column, new: Column) -> Column:
    """What the ledger keeps: through a lost detail, the last trusted enriched values and stable ones that went missing."""
    keep = resolved(old) & ~resolved(new)
    out = new
    for c in CARRIED:
        out = out.withField(c, F.when(keep, old[c]).otherwise(new[c]))
    for c in STABLE:
        gone = keep & (F.coalesce(new[c], F.lit("")) == "") & (F.coalesce(old[c], F.lit("")) != "")
        out = out.withField(c, F.when(gone, old[c]).otherwise(new[c]))
    return out


def event(known: Column, was: Column, now: Column, why: Column) -> tuple[Column, Column]:
    """(event, reasons): a posting that is open again names its lifecycle among the reasons, first if it was not there."""
    again = known & (was == "CLOSED") & (now == "OPEN")
    first = F.concat(F.array(F.lit("lifecycle_status")), why)
    reasons = F.when(again & ~F.array_contains(why, "lifecycle_status"), first).otherwise(why)
    name = F.when(~known, "NEW").when(again, "REOPENED").when(F.size(reasons) > 0, "MATERIALLY_CHANGED").otherwise("SEEN")
    return name, reasons


def matches(ledger: DataFrame, records: DataFrame) -> DataFrame:
    """(record_id, found): the entries that own an alias of the record, each once, by the rank of the alias."""
    owned = ledger.select("state_id", F.explode("aliases").alias("alias")).groupBy("alias")
    index = owned.agg(F.min("state_id").alias("state_id"), F.max("state_id").alias("other")).where("state_id = other").drop("other")
    each = records.select("record_id", F.explode("aliases").alias("x")).select("record_id", "x.rank", "x.alias")
    met = each.join(index, "alias").groupBy("record_id", "state_id").agg(F.min("rank").alias("rank"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("rank", "state_id"))), lambda x: x["state_id"])
    return met.groupBy("record_id").agg(ordered.alias("found"))


def conflicts(ledger: DataFrame, records: DataFrame) -> DataFrame:
    """(record_id, found) of the records whose aliases lead to several entries."""
    return matches(ledger, records).where(F.size("found") > 1)


def allocated(ledger: DataFrame, fresh: DataFrame) -> DataFrame:
    """``fresh`` with ``state_id``: of the strongest alias, with the least free number behind it where that is taken."""
    base = F.concat(F.lit("job_"), F.substring(F.sha1(F.element_at("aliases", 1)["alias"]), 1, 20))
    named = fresh.withColumn("base", base)
    parts = F.regexp_extract("state_id", r"^(.*?)(?:_(\d+))?$", 1)
    known = ledger.select(F.when(F.col("state_id").rlike(r"^job_[0-9a-f]+_\d+$"), parts).otherwise(F.col("state_id")).alias("base"), "state_id")
    taken = known.join(named.select("base").distinct(), "base", "left_semi").groupBy("base").agg(F.collect_set("state_id").alias("taken"))
    met = named.join(taken, "base", "left")
    free = F.filter(
        F.transform(F.sequence(F.lit(0), F.size("taken")), lambda i: F.when(i == 0, F.col("base")).otherwise(F.concat("base", F.lit("_"), i.cast("string")))),
        lambda x: ~F.array_contains("taken", x),
    )
    return met.withColumn("state_id", F.when(F.col("taken").isNull(), F.col("base")).otherwise(F.element_at(free, 1))).drop("base", "taken")


def fold(ledger: DataFrame, records: DataFrame, observed_at: Column, writer_role: str) -> DataFrame:
    """The ledger after one batch, with ``record_id``, ``event`` and ``quality_event`` of the observed entries (else null)."""
    if writer_role != WRITER_ROLE:
        raise PermissionError(f"the ledger is written by {WRITER_ROLE} only")
    sure = F.assert_true(F.size("aliases") > 0, F.concat(F.lit("no identity: "), F.coalesce("record_id", F.lit("?"))))
    known = matches(ledger, records)
    one = F.assert_true(F.size("found") == 1, F.concat_ws(" ", F.lit("identity conflict:"), "record_id", F.array_join("found", ",")))
    ids = known.select("record_id", F.element_at("found", 1).alias("state_id"), one.alias("ok")).where("ok IS NULL").drop("ok")
    batch = records.withColumn("ok", sure).where("ok IS NULL").drop("ok").join(ids, "record_id", "left")
    new = allocated(ledger, batch.where("state_id IS NULL").drop("state_id"))
    both = batch.where("state_id IS NOT NULL").unionByName(new)
    n = F.count("*").over(W.partitionBy("state_id"))
    single = F.assert_true(F.col("n") == 1, F.concat(F.lit("two observations of one entry: "), F.col("state_id")))
    both = both.withColumn("n", n).withColumn("ok", single).where("ok IS NULL")
    now = both.select("state_id", "record_id", F.transform("aliases", lambda x: x["alias"]).alias("n_aliases"), F.col("snapshot").alias("n_snapshot"))
    met = ledger.join(now, "state_id", "full")
    here, old = F.col("record_id").isNotNull(), F.col("snapshot")
    seen = here & F.col("times_seen").isNotNull()
    none = F.array().cast("array<string>")
    was = F.coalesce("lifecycle_status", old["lifecycle_status"], F.lit("UNKNOWN"))
    new_ = F.col("n_snapshot")
    why = F.when(seen, change_reasons(old, new_)).otherwise(none)
    name, reasons = event(seen, was, new_["lifecycle_status"], F.col("why"))
    quality = F.when(seen & ~resolved(old) & resolved(new_), "DETAIL_RESOLVED").when(seen & resolved(old) & ~resolved(new_), "DETAIL_UNRESOLVED")
    pick = lambda when_here, before: F.when(here, when_here).otherwise(F.col(before))
    out = met.withColumn("why", why).withColumns({"event": F.when(here, name), "reasons": reasons, "quality_event": quality})
    return out.select(
        "state_id",
        pick(F.when(seen, F.array_union("aliases", "n_aliases")).otherwise(F.array_distinct("n_aliases")), "aliases").alias("aliases"),
        F.coalesce("first_seen_at", observed_at).alias("first_seen_at"),
        pick(observed_at, "last_seen_at").alias("last_seen_at"),
        (F.coalesce("times_seen", F.lit(0)) + here.cast("long")).alias("times_seen"),
        pick(new_["lifecycle_status"], "lifecycle_status").alias("lifecycle_status"),
        pick(F.when(seen, stored(old, new_)).otherwise(new_), "snapshot").alias("snapshot"),
        pick(F.col("event"), "last_event").alias("last_event"),
        pick(F.col("reasons"), "change_reasons").alias("change_reasons"),
        "record_id",
        "event",
        "quality_event",
    )


def summary(folded: DataFrame) -> DataFrame:
    """Counts of events and quality events of the batch, and the ledger's size; nothing is ever inferred closed."""
    n = lambda c, x: F.count_if(F.col(c) == x).alias(x.lower())
    events = [n("event", x) for x in ("NEW", "SEEN", "MATERIALLY_CHANGED", "REOPENED")]
    return folded.agg(*events, *[n("quality_event", x) for x in ("DETAIL_RESOLVED", "DETAIL_UNRESOLVED")], F.count("record_id").alias("records_observed"), F.count("*").alias("state_jobs"))


def violations(ledger: DataFrame) -> DataFrame:
    """(state_id, violation): entries without id, without aliases, or with an id that another entry has too."""
    n = F.count("*").over(W.partitionBy("state_id"))
    found = F.array_compact(
        F.array(
            F.when(F.col("state_id").isNull(), "no state_id"),
            F.when(F.coalesce(F.size("aliases"), F.lit(0)) <= 0, "no aliases"),
            F.when(F.col("n") > 1, "state_id not unique"),
        )
    )
    return ledger.withColumn("n", n).select("state_id", F.explode(found).alias("violation"))


def digest(ledger: DataFrame) -> DataFrame:
    """One row: entries and an order-independent digest of all of them; equal ledgers have equal digests."""
    row = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in sorted(ledger.columns)]), {"ignoreNullFields": "false"}))
    return ledger.agg(F.count("*").alias("entries"), F.sha2(F.concat_ws(":", F.count("*").cast("string"), F.sum(row.cast("decimal(38,0)")).cast("string")), 256).alias("digest"))
