"""Evaluation of postings: documents with derived fields as postings, each dimension, the route, and the whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.operators import evaluate as ev

from .adapters import table
from .registry import query
from .scalars import WS

# --- documents as postings; both dialects are made from the same lists ------------------------------------------

TITLES = [
    "Postdoctoral Fellow in Sport Science", "Research Fellow", "PhD Student in Biology", "Assistant Professor of Health",
    "Lecturer in Motor Control", "Professor of Physics", "Research Scientist, Imaging", "Maître de conférences",
    "Scientific Project Manager", "Office Clerk", "Postdoc, Stress Biology", "Senior Researcher", "Chair in Law",
]
FAMILIES = ["UNKNOWN", "UNKNOWN", "LECTURER", "UNKNOWN", "RESEARCH_SCIENTIST", "OUT_OF_SCOPE", "UNKNOWN", "OTHER"]
RIGHTS = [
    "", "Visa sponsorship available.", "No visa sponsorship.", "Sponsorship may be available.", "You must have the right to work.",
    "No sponsorship; you must already hold work rights.", "Hosting agreement possible.", "", "Professional registration is required (AHPRA).",
    "Registration preferred.", "A medical degree is essential.",
]
SCIENCE = [
    "Exercise physiology and physical activity with cortisol.", "Sport training.", "Nothing special.", "Astronomy and galaxy surveys at an observatory.",
    "Patch-clamp required.", "Machine learning expertise is required, with Python.", "Cell culture required. Essential: western blot.",
    "Advanced independent fMRI analysis of neuroimaging data is required.", "Fluent German is required for teaching at C1 level.", "", "", "Dutch: native speakers, essential.",
]
REST = ["", "At least 10 years of experience.", "A PhD is required.", "We are an equal opportunity employer, regardless of race or age."]
COUNTRIES = ["AU", "GB", "DE", "FR", "NL", "US"]
TERMS = ["PERMANENT", "FIXED_TERM", "TEMPORARY", "UNKNOWN", "TENURE_TRACK"]
EMPLOYED = ["FULL_TIME", "CASUAL", "UNKNOWN", "SESSIONAL", "PART_TIME", "FULL_TIME", "FULL_TIME"]
DETAIL = ["FULL", "PARTIAL", "FETCH_FAILED", "FULL", "FULL", "FULL"]
REGISTERED = ["", "", "Registered with the board", "", "Licence preferred"]
METHODS = ["", "physical activity", "statistics|wearable", "electron microscopy", "", "", "cognition|x-ray"]
POLICY = ev.Policy(
    core=("exercise physiology", "physical activity", "Training", "cortisol"),
    adjacent=("sport", "Surveys"),
    titles=(("postdoctoral fellow", "POSTDOC", "PRIMARY"), ("postdoc", "POSTDOC", "HIGH_VALUE"), ("research fellow", "RESEARCH_FELLOW_POSTDOC", "PRIMARY"), ("Assistant Professor", "ASSISTANT_PROFESSOR", "PRIMARY"), ("project manager", "SCIENTIFIC_PROJECT_MANAGER", "SECONDARY"), ("clerk", "OTHER_RESEARCH", "HARD_EXCLUDE")),
    country_titles={"GB": (("lecturer", "LECTURER", "PRIMARY"),), "DE": (("senior researcher", "RESEARCH_SCIENTIST", "SECONDARY"),)},
    mobility={"GB": "POTENTIALLY_VIABLE", "DE": "FAVORABLE", "FR": "REVIEW", "NL": "POTENTIALLY_VIABLE"},
)


def _pick(values: list[str], by: int):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(F.col("doc_id") / by) % len(values) + 1).cast("int"))


def _pick_sql(values: list[str], by: int) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][(doc_id // {by}) % {len(values)} + 1]"


_ITEM = "struct<language:string,level:string,mandatory:boolean,raw_text:string>"


def postings(spark, sf_dir):
    item = lambda lang, lev, must, raw: F.struct(F.lit(lang).alias("language"), F.lit(lev).alias("level"), F.lit(must).alias("mandatory"), F.lit(raw).alias("raw_text")).cast(_ITEM)
    n = F.col("doc_id") % 5
    languages = (
        F.when(n == 1, F.array(item("German", "C1", True, "german c1")))
        .when(n == 2, F.array(item("English", None, True, None), item("French", None, False, None)))
        .when(n == 3, F.array(item("Dutch", "B2", True, None)))
        .otherwise(F.array().cast(f"array<{_ITEM}>"))
    )
    wanted = _pick(METHODS, 3)
    body = F.concat_ws(" ", _pick(SCIENCE, 1), _pick(RIGHTS, 2), "text", _pick(REST, 5))
    lit = F.lit("")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.struct(_pick(TITLES, 1).alias("title_raw"), lit.alias("title_normalized"), F.lit("Department of Sport").alias("department"), lit.alias("institution_raw"), _pick(FAMILIES, 7).alias("role_family"), _pick(EMPLOYED, 3).alias("employment_type")).alias("position"),
        F.struct(_pick(COUNTRIES, 1).alias("country_code")).alias("location"),
        F.struct(
            lit.alias("degree_text"), F.array().cast("array<string>").alias("degree_fields"),
            F.when(wanted == "", F.array().cast("array<string>")).otherwise(F.split(wanted, r"\|")).alias("methods_required"),
            F.when(n == 4, F.array(F.lit("patience"))).otherwise(F.array().cast("array<string>")).alias("methods_preferred"),
            lit.alias("work_rights_text"), lit.alias("sponsorship_text"), _pick(REGISTERED, 4).alias("professional_registration_text"),
            F.when(F.col("doc_id") % 4 == 0, "Teaching duties").otherwise("").alias("teaching_requirement_text"), languages.alias("language_requirements"),
        ).alias("requirements"),
        F.struct(_pick(DETAIL, 1).alias("detail_status"), body.alias("full_jd")).alias("description"),
        F.struct(_pick(TERMS, 2).alias("term_type"), (F.col("doc_id") % 30).cast("double").alias("duration_months")).alias("contract"),
        F.struct(
            F.when(F.col("doc_id") % 9 == 0, "POLICY_REVIEW").alias("pre_evaluation_disposition"),
            F.when(F.col("doc_id") % 9 == 0, F.array(F.lit("PRIOR_REVIEW"), F.lit("UNCLEAR_DOMAIN"))).alias("review_codes"),
            F.when(F.col("doc_id") % 50 == 0, F.array(F.lit("PRIOR_BLOCK"))).alias("blocker_codes"),
        ).alias("classification"),
    )


# --- the same rules as SQL ---------------------------------------------------------------------------------------

_Q = lambda p: p.replace("'", "''")
_EVAL = lambda x: f"translate({WS.format(x=x)}, '–—', '--')"
_LIST = lambda x: "[" + ", ".join(f"'{_Q(ev.norm(v))}'" for v in x) + "]"
_HIT = lambda t, p: f"regexp_matches({t}, '{_Q(p)}')"
_NEED = lambda t, p: f"regexp_matches({t}, '(?s)(?:{ev.REQUIRED}).{{0,100}}(?:{_Q(p)})|(?:{_Q(p)}).{{0,100}}(?:{ev.REQUIRED})')"
_FILTER = "list_filter([{}], lambda x: x IS NOT NULL)"
_CODE = lambda *pairs: _FILTER.format(", ".join(f"CASE WHEN {c} THEN '{code}' END" for c, code in pairs))
_HITS = lambda t, terms: f"list_filter({_LIST(terms)}, lambda p: contains({t}, p))"


def _scrubbed(x: str) -> str:
    for p in ev.NOISE:
        x = f"regexp_replace({x}, '{_Q(p)}', ' ', 'g')"
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def _titles_sql() -> str:
    rules = [(f"country = '{c}' AND ", r) for c, own in POLICY.country_titles.items() for r in own] + [("", r) for r in POLICY.titles]
    fellow = f"CASE WHEN {_HIT('body', ev.FELLOW_EVIDENCE)} THEN 'PRIMARY' ELSE 'CONDITIONAL' END"
    out = ""
    for here, (phrase, family, what) in rules:
        status = fellow if family == "RESEARCH_FELLOW_POSTDOC" else f"'{ev.STATUS_OF_POLICY.get(what, 'CONDITIONAL')}'"
        out += f" WHEN {here}contains(title, '{ev.norm(phrase)}') THEN {{'family': '{family}', 'status': {status}}}"
    return out


_SQ = lambda names: ", ".join(f"'{x}'" for x in names)
_STUDENT = f"({_HIT('title', ev.STUDENT)} AND NOT contains(title, 'postdoc'))"
_FACULTY = f"(country = 'FR' AND {_HIT('title', ev.FRENCH_FACULTY)})"
_OUT = "{'family': 'OUT_OF_SCOPE', 'status': 'OUT_OF_SCOPE'}"
_JD = f"concat_ws(' ', {_pick_sql(SCIENCE, 1)}, {_pick_sql(RIGHTS, 2)}, text, {_pick_sql(REST, 5)})"
_WANTED = _pick_sql(METHODS, 3)
_TEACH_TEXT = "CASE WHEN doc_id % 4 = 0 THEN 'Teaching duties' ELSE '' END"
_LANG_RAW = "CASE doc_id % 5 WHEN 1 THEN 'german c1' ELSE '' END"
_REG_TEXT = _pick_sql(REGISTERED, 4)
_PARTS = [
    _EVAL(_pick_sql(TITLES, 1)), "'Department of Sport'", f"replace({_WANTED}, '|', ' ')", "CASE WHEN doc_id % 5 = 4 THEN 'patience' ELSE '' END",
    _REG_TEXT, _TEACH_TEXT, _LANG_RAW, _JD,
]
_BODY = _scrubbed(_EVAL("concat_ws(' ', " + ", ".join(f"nullif({p}, '')" for p in _PARTS) + ")"))
_UNRELATED = " ".join(f"WHEN len({_HITS('body', v)}) >= 2 OR (len({_HITS('unit', v)}) > 0 AND len({_HITS('body', v)}) >= 1) THEN '{k}'" for k, v in ev.UNRELATED.items())
_KNOWN = " OR ".join(f"contains(' ' || x || ' ', '{p}')" for p in ev.KNOWN_METHODS)
_WET = " + ".join(f"({_NEED('body', p)})::INT" for p in ev.WET_LAB)
_SAID = "(' ' || ' ' || body)"  # no sponsorship or work rights text in these postings
_MOBILITY = f"""CASE WHEN country = 'AU' AND {_HIT(_SAID, ev.SPONSOR_NO)} AND {_HIT(_SAID, ev.WORK_RIGHTS)} THEN 'AU_NO_SPONSORSHIP_WORK_RIGHTS_REQUIRED'
  WHEN {_HIT(_SAID, ev.SPONSOR_YES)} OR contains(body, 'hosting agreement') THEN 'FAVORABLE' WHEN {_HIT(_SAID, ev.SPONSOR_MAYBE)} THEN 'POTENTIALLY_VIABLE'
  WHEN {_HIT(_SAID, ev.SPONSOR_NO)} THEN 'VISA_AMBIGUOUS' WHEN {_HIT(_SAID, ev.WORK_RIGHTS)} THEN 'WORK_RIGHTS_RESTRICTION'
  WHEN market = 'REVIEW' THEN 'SPONSORSHIP_UNSTATED' WHEN market = 'VERIFY_CURRENT_RULES' THEN 'VERIFY_CURRENT_MOBILITY_RULES' ELSE 'DEFAULT' END"""

EVALUATED = f"""p AS (SELECT doc_id, text, {_EVAL(_pick_sql(TITLES, 1))} AS title, {_pick_sql(COUNTRIES, 1)} AS country, {_pick_sql(FAMILIES, 7)} AS known,
    {_BODY} AS body, {_pick_sql(DETAIL, 1)} AS detail, {_EVAL(_JD)} AS jd, list_filter(string_split({_WANTED}, '|'), lambda x: x <> '') AS needed, doc_id % 5 = 4 AS wished,
    {_EVAL(_REG_TEXT)} AS reg, {_pick_sql(TERMS, 2)} AS term, {_pick_sql(EMPLOYED, 3)} AS employed, doc_id % 30 AS months FROM documents),
  q AS (SELECT *, title || ' department of sport' AS unit, detail NOT IN ('FULL', 'PARTIAL') OR jd = '' AS detail_missing,
    CASE country {' '.join(f"WHEN '{c}' THEN '{s}'" for c, s in POLICY.mobility.items())} ELSE 'VERIFY_CURRENT_RULES' END AS market,
    {_HITS('body', POLICY.core)} AS core, {_HITS('body', POLICY.adjacent)} AS adjacent, doc_id % 4 = 0 OR {_HIT('body', ev.TEACHING)} AS teaching FROM p),
  r AS (SELECT *, CASE WHEN {_STUDENT} OR {_FACULTY} THEN {_OUT}
      WHEN known <> 'UNKNOWN' THEN {{'family': known, 'status': CASE WHEN known IN ({_SQ(ev.PRIMARY)}) THEN 'PRIMARY' WHEN known IN ({_SQ(ev.SECONDARY)}) THEN 'SECONDARY' WHEN known = 'OUT_OF_SCOPE' THEN 'OUT_OF_SCOPE' ELSE 'CONDITIONAL' END}}
      {_titles_sql()} WHEN {_HIT('title', ev.SENIOR)} AND NOT contains(title, 'assistant professor') THEN {_OUT}
      WHEN {_HIT('title', r'\bresearch fellow\b')} THEN {{'family': 'RESEARCH_FELLOW_POSTDOC', 'status': 'CONDITIONAL'}}
      WHEN {_HIT('title', r'\bresearch(?:er)?\b|\bscientist\b')} THEN {{'family': 'OTHER_RESEARCH', 'status': 'CONDITIONAL'}} ELSE {{'family': 'UNKNOWN', 'status': 'AMBIGUOUS'}} END AS role,
    CASE WHEN len(core) = 0 AND len(adjacent) = 0 THEN CASE {_UNRELATED} END END AS unrelated FROM q),
  s AS (SELECT *, role.family AS role_family, role.status AS role_status,
    CASE WHEN len(core) >= 3 OR (len({_HITS('unit', POLICY.core)}) > 0 AND len(core) >= 2) THEN 'STRONG' WHEN len(core) > 0 THEN 'GOOD'
      WHEN len(adjacent) > 0 OR len({_HITS('unit', POLICY.adjacent)}) > 0 THEN 'ADJACENT' WHEN unrelated IS NOT NULL THEN 'WEAK' ELSE 'UNCLEAR' END AS scientific,
    {_CODE(*[(_NEED('body', p), code) for code, p in ev.METHOD_BLOCKERS.items()], (f"{_NEED('body', ev.AI_SUBJECT)} AND {_HIT('body', ev.AI_CENTRAL)}", 'MANDATORY_ADVANCED_AI_ML'), (f"{_WET} >= 2", 'MANDATORY_SPECIALIST_WET_LAB'))} AS method_blockers,
    {_CODE((f"{_HIT('body', ev.ADVANCED_IMAGING)} AND {_NEED('body', '(?:fmri|neuroimaging)')}", 'ADVANCED_FMRI_ANALYSIS_NOT_ESTABLISHED'), (f"len(list_filter(needed, lambda x: NOT ({_KNOWN}))) > 0", 'METHOD_MISMATCH_UNCLEAR'))} AS method_review,
    {_CODE((f"(doc_id % 5 = 1 AND teaching) OR (doc_id % 5 IN (0, 4) AND {_HIT('body', ev.GERMAN_LEVEL)} AND {_HIT('body', ev.TEACHING)} AND {_NEED('body', 'german')})", 'MANDATORY_GERMAN_C1_C2_TEACHING'))} AS language_blockers,
    (doc_id % 5 = 1 AND NOT teaching) OR doc_id % 5 = 3 OR (doc_id % 5 IN (0, 4) AND NOT ({_HIT('body', ev.GERMAN_LEVEL)} AND {_HIT('body', ev.TEACHING)} AND {_NEED('body', 'german')}) AND {_HIT('body', ev.LOCAL_LANGUAGE)} AND {_NEED('body', '(?:dutch|french|german)')}) AS language_open,
    {_MOBILITY} AS moved,
    CASE WHEN {_HIT("(reg || ' ' || body)", ev.REGISTERED_SOFT)} THEN 'CLEAR' WHEN {_NEED("(reg || ' ' || body)", ev.REGISTERED)} OR {_HIT("(reg || ' ' || body)", ev.REGISTERED_HARD)} THEN 'BLOCKED'
      WHEN {_HIT('reg', 'registration|registered|licen[cs]e')} THEN 'REVIEW' ELSE 'CLEAR' END AS registration,
    {_CODE((' OR '.join(_NEED("(' ' || body)", p) for p in ev.DEGREES), 'MANDATORY_MEDICAL_OR_NURSING_DEGREE'))} AS qualification,
    CASE WHEN employed IN ('CASUAL', 'SESSIONAL') THEN 'REVIEW' WHEN term IN ('PERMANENT', 'TENURE_TRACK') THEN 'ATTRACTIVE' WHEN term IN ('FIXED_TERM', 'TEMPORARY') THEN CASE WHEN months < 12 THEN 'REVIEW' ELSE 'ACCEPTABLE' END ELSE 'UNKNOWN' END AS contract,
    {_CODE(("employed IN ('CASUAL', 'SESSIONAL')", 'CASUAL_OR_SESSIONAL_ROLE'), ("employed NOT IN ('CASUAL', 'SESSIONAL') AND term IN ('FIXED_TERM', 'TEMPORARY') AND months < 12", 'SHORT_FIXED_TERM'))} AS contract_review,
    CASE WHEN doc_id % 9 = 0 THEN ['PRIOR_REVIEW', 'UNCLEAR_DOMAIN'] ELSE []::VARCHAR[] END AS prior_review, CASE WHEN doc_id % 50 = 0 THEN ['PRIOR_BLOCK'] ELSE []::VARCHAR[] END AS prior_blockers,
    CASE WHEN doc_id % 9 = 0 THEN 'POLICY_REVIEW' ELSE 'ELIGIBLE_FOR_EVALUATION' END AS prior_disposition FROM r),
  t AS (SELECT *,
    CASE WHEN role_family = 'POSTDOC' THEN 'STRONG' WHEN role_family = 'RESEARCH_FELLOW_POSTDOC' THEN CASE WHEN role_status = 'PRIMARY' THEN 'STRONG' ELSE 'REVIEW' END
      WHEN role_family IN ({_SQ(ev.FACULTY)}) THEN CASE WHEN {_HIT('body', ev.MANY_YEARS)} THEN 'REVIEW' ELSE 'ACCEPTABLE' END WHEN role_family IN ({_SQ(ev.SECONDARY)}) THEN 'REVIEW'
      WHEN role_family = 'OUT_OF_SCOPE' THEN 'MISMATCH' WHEN role_family = 'OTHER_RESEARCH' THEN 'REVIEW' ELSE 'UNKNOWN' END AS level,
    {_CODE(("role_family = 'RESEARCH_FELLOW_POSTDOC' AND role_status <> 'PRIMARY'", 'GENERIC_RESEARCH_FELLOW'), (f"role_family IN ({_SQ(ev.FACULTY)}) AND {_HIT('body', ev.MANY_YEARS)}", 'VERY_SENIOR_EXPERIENCE_REQUIREMENT'), (f"role_family IN ({_SQ(ev.SECONDARY)})", 'SECONDARY_ROLE_DISABLED_BY_DEFAULT'), (f"role_family NOT IN ('POSTDOC', 'RESEARCH_FELLOW_POSTDOC', 'OUT_OF_SCOPE', {_SQ(ev.FACULTY)}, {_SQ(ev.SECONDARY)})", 'UNCERTAIN_LOCAL_TITLE'))} AS level_review,
    CASE WHEN len(method_blockers) > 0 THEN 'MISMATCH' WHEN len(method_review) > 0 THEN 'REVIEW' WHEN len(needed) > 0 THEN 'STRONG' WHEN wished THEN 'ACCEPTABLE' ELSE 'UNKNOWN' END AS methods,
    CASE WHEN len(language_blockers) > 0 THEN 'BLOCKED' WHEN language_open THEN 'REVIEW' ELSE 'CLEAR' END AS language,
    CASE WHEN moved = 'AU_NO_SPONSORSHIP_WORK_RIGHTS_REQUIRED' THEN 'BLOCKED' WHEN moved IN ('FAVORABLE', 'POTENTIALLY_VIABLE') THEN moved WHEN moved IN ('VISA_AMBIGUOUS', 'WORK_RIGHTS_RESTRICTION') THEN 'REVIEW' ELSE market END AS mobility,
    {_CODE(("moved IN ('VISA_AMBIGUOUS', 'WORK_RIGHTS_RESTRICTION', 'SPONSORSHIP_UNSTATED', 'VERIFY_CURRENT_MOBILITY_RULES')", 'X')).replace("'X'", 'moved')} AS mobility_review FROM s),
  u AS (SELECT *, array_to_string(list_distinct_in_order, ',') AS blocker_codes FROM (SELECT *, list_filter(all_blockers, lambda x, i: list_position(all_blockers, x) = i) AS list_distinct_in_order FROM (SELECT *,
    prior_blockers || method_blockers || language_blockers || {_CODE(("moved = 'AU_NO_SPONSORSHIP_WORK_RIGHTS_REQUIRED'", 'AU_NO_SPONSORSHIP_WORK_RIGHTS_REQUIRED'), ("registration = 'BLOCKED'", 'MANDATORY_PROFESSIONAL_REGISTRATION'))} || qualification
      || {_CODE((f"role_family = 'OUT_OF_SCOPE' AND {_STUDENT}", 'ROLE_STUDENT'), (f"role_family = 'OUT_OF_SCOPE' AND {_FACULTY}", 'FR_FACULTY_OUT_OF_SCOPE'), ("scientific = 'WEAK' AND detail IN ('FULL', 'PARTIAL')", 'HIGH_CONFIDENCE_UNRELATED_DOMAIN'))} AS all_blockers FROM t))),
  v AS (SELECT *, array_to_string(list_filter(all_reviews, lambda x, i: list_position(all_reviews, x) = i), ',') AS review_codes FROM (SELECT *,
    prior_review || {_CODE(("scientific = 'UNCLEAR'", 'UNCLEAR_DOMAIN'))} || level_review || method_review || {_CODE(('language_open', 'LOCAL_LANGUAGE_MANDATORY_UNCONFIRMED'))} || mobility_review
      || {_CODE(("registration = 'REVIEW'", 'PROFESSIONAL_REGISTRATION_AMBIGUOUS'))} || contract_review || {_CODE(('detail_missing', 'FULL_JD_UNAVAILABLE'))} AS all_reviews FROM u)),
  w AS (SELECT *, CASE WHEN blocker_codes <> '' THEN 'blocker' WHEN detail_missing THEN 'detail_missing'
      WHEN methods = 'REVIEW' OR language IN ('REVIEW', 'BLOCKED') OR mobility IN ('REVIEW', 'BLOCKED', 'VERIFY_CURRENT_RULES') OR registration IN ('REVIEW', 'BLOCKED') THEN 'dimension'
      WHEN level IN ('REVIEW', 'UNKNOWN') OR scientific = 'UNCLEAR' THEN 'ambiguous' WHEN role_status IN ('SECONDARY', 'CONDITIONAL', 'AMBIGUOUS') THEN 'role' WHEN scientific = 'ADJACENT' THEN 'adjacent'
      WHEN scientific = 'WEAK' OR level = 'MISMATCH' THEN 'weak' WHEN contract = 'REVIEW' THEN 'contract'
      WHEN role_status = 'PRIMARY' AND scientific = 'STRONG' AND level = 'STRONG' AND methods IN ('STRONG', 'ACCEPTABLE', 'UNKNOWN') THEN 'strong'
      WHEN role_status = 'PRIMARY' AND scientific IN ('STRONG', 'GOOD') AND level IN ('STRONG', 'ACCEPTABLE') THEN 'apply' WHEN review_codes <> '' THEN 'codes' ELSE 'default' END AS exit FROM v),
  evaluated AS (SELECT *, CASE exit WHEN 'blocker' THEN 'SKIP' WHEN 'weak' THEN 'LOW_PRIORITY' WHEN 'default' THEN 'LOW_PRIORITY' WHEN 'strong' THEN 'STRONG_APPLY' WHEN 'apply' THEN 'APPLY' ELSE 'REVIEW' END AS recommendation FROM w)"""


def _dims(spark, sf_dir):
    return ev.dimensions(postings(spark, sf_dir), POLICY)


def _sql(columns: str) -> str:
    return f"WITH {EVALUATED} SELECT doc_id, {columns} FROM evaluated"


def _joined(*names: str):
    return [F.array_join(n, ",").alias(n.replace(".", "_")) for n in names]


@query("eval_role", _sql("role_family, role_status"))
def eval_role(spark, sf_dir):
    return _dims(spark, sf_dir).select("doc_id", F.col("role.family").alias("role_family"), F.col("role.status").alias("role_status"))


@query("eval_scientific", _sql("scientific, array_to_string(core, ',') AS core, array_to_string(adjacent, ',') AS adjacent, unrelated"))
def eval_scientific(spark, sf_dir):
    x = F.col("scientific")
    return _dims(spark, sf_dir).select("doc_id", x["status"].alias("scientific"), F.array_join(x["core"], ",").alias("core"), F.array_join(x["adjacent"], ",").alias("adjacent"), x["unrelated"].alias("unrelated"))


@query("eval_level", _sql("level, array_to_string(level_review, ',') AS level_review"))
def eval_level(spark, sf_dir):
    return _dims(spark, sf_dir).select("doc_id", F.col("level.status").alias("level"), *_joined("level.review"))


@query("eval_methods", _sql("methods, array_to_string(method_review, ',') AS methods_review, array_to_string(method_blockers, ',') AS methods_blockers"))
def eval_methods(spark, sf_dir):
    return _dims(spark, sf_dir).select("doc_id", F.col("methods.status").alias("methods"), *_joined("methods.review", "methods.blockers"))


@query("eval_language", _sql("language, language_open, array_to_string(language_blockers, ',') AS language_blockers"))
def eval_language(spark, sf_dir):
    return _dims(spark, sf_dir).select("doc_id", F.col("language.status").alias("language"), (F.size("language.review") > 0).alias("language_open"), *_joined("language.blockers"))


@query("eval_mobility", _sql("mobility, array_to_string(mobility_review, ',') AS mobility_review"))
def eval_mobility(spark, sf_dir):
    return _dims(spark, sf_dir).select("doc_id", F.col("mobility.status").alias("mobility"), *_joined("mobility.review"))


@query("eval_registration_contract", _sql("registration, array_to_string(qualification, ',') AS qualification, contract, array_to_string(contract_review, ',') AS contract_review"))
def eval_registration_contract(spark, sf_dir):
    return _dims(spark, sf_dir).select("doc_id", F.col("registration.status").alias("registration"), F.array_join("qualification", ",").alias("qualification"), F.col("contract.status").alias("contract"), *_joined("contract.review"))


@query("eval_prior", _sql("prior_disposition, array_to_string(prior_review, ',') AS prior_review, array_to_string(prior_blockers, ',') AS prior_blockers"))
def eval_prior(spark, sf_dir):
    return _dims(spark, sf_dir).select("doc_id", F.col("prior.disposition").alias("prior_disposition"), *_joined("prior.review", "prior.blockers"))


@query("eval_route", _sql("exit, recommendation"))
def eval_route(spark, sf_dir):
    return ev.evaluated(postings(spark, sf_dir), POLICY).select("doc_id", "exit", "recommendation")


_DISPOSITION = "CASE WHEN blocker_codes <> '' THEN 'POLICY_SKIP' WHEN detail_missing THEN 'NEEDS_DETAIL_REVIEW' WHEN review_codes <> '' OR recommendation = 'REVIEW' THEN 'POLICY_REVIEW' ELSE 'ELIGIBLE_FOR_EVALUATION' END"


@query("eval_full", _sql(f"role_family, role_status, scientific, level, methods, language, mobility, registration, contract, blocker_codes, review_codes, recommendation, {_DISPOSITION} AS disposition"))
def eval_full(spark, sf_dir):
    dims = [F.col(f"{x}.status").alias(x) for x in ("scientific", "level", "methods", "language", "mobility", "registration", "contract")]
    return ev.evaluated(postings(spark, sf_dir), POLICY).select("doc_id", F.col("role.family").alias("role_family"), F.col("role.status").alias("role_status"), *dims, *_joined("blocker_codes", "review_codes"), "recommendation", "disposition")
