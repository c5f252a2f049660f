"""Evaluation of postings and the ledger, by scenario."""

import pytest
from pyspark.sql import functions as F

from recordflow.operators import collection, evaluate, ledger, reporting
from recordflow.plans.evaluating import POLICY

POSTING = (
    "id int, position struct<title_raw:string,title_normalized:string,department:string,institution_raw:string,role_family:string,employment_type:string>, location struct<country_code:string>,"
    " requirements struct<degree_text:string,degree_fields:array<string>,methods_required:array<string>,methods_preferred:array<string>,work_rights_text:string,sponsorship_text:string,"
    "professional_registration_text:string,teaching_requirement_text:string,language_requirements:array<struct<language:string,level:string,mandatory:boolean,raw_text:string>>>,"
    " description struct<detail_status:string,full_jd:string>, contract struct<term_type:string,duration_months:double>,"
    " classification struct<pre_evaluation_disposition:string,review_codes:array<string>,blocker_codes:array<string>>"
)
GOOD = "Training and physical activity with cortisol. "


def posting(i, title="Postdoc", body=GOOD, country="GB", status="FULL", family=None, languages=(), term="PERMANENT", months=None, registration=None, blockers=None, sponsorship=None, methods=()):
    req = (None, None, list(methods), None, None, sponsorship, registration, None, list(languages))
    return (i, (title, None, None, None, family, None), (country,), req, (status, body), (term, months), (None, None, blockers))


def test_scenarios(spark):
    cases = [
        (posting(0), "STRONG_APPLY", "ELIGIBLE_FOR_EVALUATION", []),
        (posting(1, title="PhD candidate"), "SKIP", "POLICY_SKIP", ["ROLE_STUDENT"]),
        (posting(2, status="BLOCKED"), "REVIEW", "NEEDS_DETAIL_REVIEW", []),
        (posting(3, status="BLOCKED", title="Maître de conférences", country="FR"), "SKIP", "POLICY_SKIP", ["FR_FACULTY_OUT_OF_SCOPE"]),
        (posting(4, body=GOOD + "Optogenetics experience is essential."), "SKIP", "POLICY_SKIP", ["MANDATORY_OPTOGENETICS"]),
        (posting(5, body=GOOD + "Optogenetics would be nice."), "STRONG_APPLY", "ELIGIBLE_FOR_EVALUATION", []),
        (posting(6, body="Marketing and accounting."), "SKIP", "POLICY_SKIP", ["HIGH_CONFIDENCE_UNRELATED_DOMAIN"]),
        (posting(7, body="Something else."), "REVIEW", "POLICY_REVIEW", []),
        (posting(8, languages=[("German", "C1", True, None)], body=GOOD + "Teaching."), "SKIP", "POLICY_SKIP", ["MANDATORY_GERMAN_C1_C2_TEACHING"]),
        (posting(9, languages=[("German", "C1", True, None)]), "REVIEW", "POLICY_REVIEW", []),
        (posting(10, languages=[("English", "C2", True, None)]), "STRONG_APPLY", "ELIGIBLE_FOR_EVALUATION", []),
        (posting(11, country="AU", sponsorship="No sponsorship; must already hold work rights"), "SKIP", "POLICY_SKIP", ["AU_NO_SPONSORSHIP_WORK_RIGHTS_REQUIRED"]),
        (posting(12, sponsorship="No sponsorship"), "REVIEW", "POLICY_REVIEW", []),
        (posting(13, registration="Registration with the HCPC is required"), "SKIP", "POLICY_SKIP", ["MANDATORY_PROFESSIONAL_REGISTRATION"]),
        (posting(14, registration="HCPC registration preferred"), "STRONG_APPLY", "ELIGIBLE_FOR_EVALUATION", []),
        (posting(15, term="FIXED_TERM", months=6.0), "REVIEW", "POLICY_REVIEW", []),
        (posting(16, title="Assistant Professor", term="FIXED_TERM", months=24.0), "APPLY", "ELIGIBLE_FOR_EVALUATION", []),
        (posting(17, blockers=["BEFORE"]), "SKIP", "POLICY_SKIP", ["BEFORE"]),
        (posting(18, title="Postdoc", family="OUT_OF_SCOPE"), "LOW_PRIORITY", "ELIGIBLE_FOR_EVALUATION", []),
        (posting(19, methods=["electron microscopy"]), "REVIEW", "POLICY_REVIEW", []),
        (posting(20, title=None, body=None, country=None, status=None), "REVIEW", "NEEDS_DETAIL_REVIEW", []),
        (posting(21, body="Equal opportunities. Marketing and accounting. " + GOOD), "REVIEW", "POLICY_REVIEW", []),
    ]
    rows = evaluate.evaluated(spark.createDataFrame([c[0] for c in cases], POSTING), POLICY).collect()
    got = {r.id: (r.recommendation, r.disposition, list(r.blocker_codes)) for r in rows}
    assert got == {c[0][0]: tuple(c[1:]) for c in cases}


def records(spark, rows):
    """(record, canonical, job, title, status, words, simhash, lifecycle)"""
    d = spark.createDataFrame(rows, "r string, c string, j string, title string, status string, words long, hash string, life string")
    a = collection.aliases(F.col("c"), F.lit("s"), F.col("j"), [], F.lit(None).cast("string"))
    of = {"title": F.col("title"), "detail_status": F.col("status"), "detail_words": F.col("words"), "detail_simhash": F.col("hash"), "source_status": F.col("life"), "fte": F.lit(0.5)}
    return d.select(F.col("r").alias("record_id"), a.alias("aliases"), ledger.snapshot(of).alias("snapshot"))


def fold(spark, state, rows, day):
    at = F.lit(f"2026-01-0{day} 00:00:00").cast("timestamp")
    out = ledger.fold(state.drop("record_id", "event", "quality_event"), records(spark, rows), at, ledger.WRITER_ROLE)
    return spark.createDataFrame(out.collect(), out.schema)


def test_ledger_scenarios(spark):
    zero, near, far = "0" * 16, "0" * 13 + "fff", "ffff" + "0" * 9 + "fff"
    state = spark.createDataFrame([], ledger.LEDGER)
    state = fold(spark, state, [("a", "c1", "1", "T", "FULL", 9, zero, "OPEN"), ("b", "c2", "2", "T", "FULL", 9, zero, "CLOSED"), ("c", "c3", "3", "T", "FULL", 9, zero, "OPEN"), ("d", "c4", "4", "T", "FULL", 9, zero, "OPEN")], 1)
    assert {r.event for r in state.collect()} == {"NEW"}
    state = fold(spark, state, [("a", "c1x", "1", "T", "FETCH_FAILED", 0, "", "OPEN"), ("b", "c2", "2", "T", "FULL", 9, zero, "OPEN"), ("c", "c3", "3", "T", "FULL", 9, near, "OPEN")], 2)
    got = {r.record_id: r for r in state.collect()}
    assert (got["a"].event, got["a"].quality_event, got["a"].change_reasons) == ("SEEN", "DETAIL_UNRESOLVED", [])  # a lost detail is no change
    assert got["a"].snapshot.detail_status == "FULL" and "canonical:c1x" in got["a"].aliases and got["a"].times_seen == 2
    assert (got["b"].event, got["b"].change_reasons) == ("REOPENED", ["lifecycle_status"])
    assert got["c"].event == "SEEN"  # 12 bits are no other detail
    absent = got[None]
    assert (absent.times_seen, absent.last_event, absent.lifecycle_status) == (1, "NEW", "OPEN")  # absence closes nothing
    state = fold(spark, state, [("c", "c3", "3", "T", "FULL", 9, far, "OPEN"), ("a", "c1", "1", "U", "FULL", 9, zero, "OPEN")], 3)
    got = {r.record_id: r for r in state.collect() if r.record_id}
    assert (got["c"].event, got["c"].change_reasons) == ("MATERIALLY_CHANGED", ["full_jd"])
    assert got["a"].change_reasons == ["title"]
    with pytest.raises(Exception, match="identity conflict"):
        fold(spark, state, [("x", "c1", "2", "T", "FULL", 9, zero, "OPEN")], 4)
    with pytest.raises(Exception, match="two observations"):
        fold(spark, state, [("x", "c1", "", "T", "FULL", 9, zero, "OPEN"), ("y", "", "1", "T", "FULL", 9, zero, "OPEN")], 4)
    with pytest.raises(PermissionError):
        ledger.fold(state, records(spark, []), F.current_timestamp(), "COLLECTOR")
    one, two = (ledger.digest(s.drop("record_id", "event", "quality_event")).first() for s in (state, state.repartition(3)))
    assert one == two and one.entries == 4


def test_deadlines_and_names(spark):
    x = F.col("x")
    d = spark.createDataFrame([("1st May 2026",), ("2026-02-30",), (None,), ("closes 05/06/2026",)], "x string")
    assert [r[0] for r in d.select(reporting.parsed_deadline(x)).collect()] == ["2026-05-01", "2026-02-30", "", "2026-06-05"]
