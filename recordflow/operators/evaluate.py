"""Evaluation of postings: independent dimensions from text and fields, codes, and one ordered route.

A posting is one row with structs ``position``, ``location``, ``requirements``, ``description``, ``contract`` and
``classification``.  Every dimension is a projection of column expressions; nothing is shuffled, and missing structs' fields
count as empty.  Vocabularies that differ by user are a ``Policy``; what is said in postings is fixed below.
"""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.functions import text

from .classify import first_of

# Families, codes, patterns and word lists that results must agree on.
GOOD_DETAIL = ("FULL", "PARTIAL")
PRIMARY = (
    "POSTDOC", "RESEARCH_FELLOW_POSTDOC", "ASSISTANT_PROFESSOR", "LECTURER", "RESEARCH_ASSISTANT_PROFESSOR", "TENURE_TRACK",
    "JUNIOR_PROFESSOR",
)
FACULTY = ("ASSISTANT_PROFESSOR", "LECTURER", "RESEARCH_ASSISTANT_PROFESSOR", "TENURE_TRACK", "JUNIOR_PROFESSOR")
SECONDARY = ("RESEARCH_SCIENTIST", "SCIENTIFIC_PROJECT_MANAGER", "RESEARCH_PROJECT_MANAGER", "RESEARCH_PROGRAMME_MANAGER")
NOISE = (
    r"equal opportunit(?:y|ies).{0,700}",
    r"regardless of.{0,500}(?:race|religion|gender|sex|sexual orientation|disability|age).{0,500}",
    r"without regard to.{0,500}(?:race|religion|gender|sex|sexual orientation|disability|age).{0,500}",
    r"mental health (?:support|benefits?|resources?)",
    r"health(?:care)? insurance",
    r"wellbeing benefits?",
    r"wellness benefits?",
    r"exercise (?:your|their|the) rights",
    r"employee assistance programme",
)
REQUIRED = "required|essential|mandatory|must have|must possess|demonstrated expertise|strong experience|proven experience|extensive experience"
STUDENT = r"\b(?:phd|doctoral)\s+(?:student|candidate|trainee)\b|\bdoctoral researcher\b"
FRENCH_FACULTY = r"\b(?:maitre de conferences|mcf)\b"
FELLOW_EVIDENCE = r"\bpostdoc(?:toral)?\b|\bphd\b.{0,80}(?:required|essential)|(?:required|essential).{0,80}\bphd\b"
SENIOR = r"\b(?:full professor|professor of|chair in|associate professor)\b"
MANY_YEARS = r"(?:minimum|at least)\s*(?:8|9|10|1[1-9]|[2-9][0-9])\s+years"
UNRELATED = {
    "CHEMISTRY_MATERIALS": ("organometallic", "synthetic chemistry", "catalysis", "materials chemistry", "polymer chemistry"),
    "ASTRONOMY_ASTROPHYSICS": ("astronomy", "astrophysics", "observatory", "galaxy", "stellar"),
    "ENGINEERING_INFRASTRUCTURE": ("civil engineering", "structural engineering", "power systems", "electrical engineering", "construction engineering"),
    "BUSINESS_LAW": ("marketing", "accounting", "corporate finance", "commercial law", "legal research"),
    "AGRICULTURE_PLANT": ("plant breeding", "crop science", "agronomy", "horticulture", "plant pathology"),
}
METHOD_BLOCKERS = {"MANDATORY_PATCH_CLAMP": r"patch[- ]clamp", "MANDATORY_OPTOGENETICS": r"optogenetic"}
AI_SUBJECT = "(?:advanced )?(?:machine learning|deep learning|artificial intelligence|computational modelling|computer vision)"
AI_CENTRAL = "(?:python|pytorch|tensorflow|machine learning|deep learning|computer vision)"
WET_LAB = ("cell culture", "western blot", "flow cytometr", "molecular biology", "cloning", "immunoprecipitation")
ADVANCED_IMAGING = (
    "(?:advanced|independent|expert).{0,50}(?:fmri|neuroimaging).{0,50}(?:preprocess|analysis)"
    "|(?:fmri|neuroimaging).{0,50}(?:preprocess|analysis).{0,50}(?:advanced|expert|independent)"
)
KNOWN_METHODS = (
    "exercise", "physical activity", "fitness", "cardiorespiratory", "cpet", "randomized", "randomised", "intervention",
    "psychological", "cognitive", "cognition", "cortisol", "stress", "hpa", "nr3c1", "epigen", "physiolog", "mri",
    "neuroimaging", "statistics", "statistical", "spss", " r ", "project", "grant", "horizon", "msca", "digital health",
    "virtual reality", "wearable", "behavior", "behaviour",
)
TEACHING = "teach|teaching|lehre|unterricht"
GERMAN_LEVEL = r"german.{0,50}\b(?:c1|c2)\b|\b(?:c1|c2)\b.{0,50}german"
LOCAL_LANGUAGE = "(?:fluent|native|bilingual|c1|c2).{0,40}(?:dutch|french|german)|(?:dutch|french|german).{0,40}(?:fluent|native|bilingual|c1|c2)"
SPONSOR_YES = "(?:visa )?sponsorship (?:is )?(?:available|provided|offered)|eligible for sponsorship|we sponsor"
SPONSOR_MAYBE = "sponsorship may be available|may consider sponsorship|sponsorship can be considered"
SPONSOR_NO = "no (?:visa )?sponsorship|sponsorship (?:is )?not available|cannot sponsor|unable to sponsor"
WORK_RIGHTS = "must (?:already )?(?:have|hold).{0,70}(?:work rights|right to work|working rights)|existing unrestricted work rights|unrestricted working rights"
REGISTERED_SOFT = "(?:registration|registered|licen[cs]e).{0,30}(?:preferred|desirable|advantage)"
REGISTERED = "(?:professional registration|clinical registration|medical registration|nursing registration|ahpra|hcpc|gmc|nmc)"
REGISTERED_HARD = "must be (?:currently )?registered with|current registration with .{0,40}(?:is )?(?:required|essential)"
DEGREES = ("(?:medical degree|degree in medicine|mbbs|md degree|medical qualification)", "(?:nursing degree|degree in nursing|registered nurse qualification)")
STATUS_OF_POLICY = {"PRIMARY": "PRIMARY", "HIGH_VALUE": "PRIMARY", "HARD_EXCLUDE": "OUT_OF_SCOPE", "NORMALLY_SKIP": "OUT_OF_SCOPE", "SECONDARY": "SECONDARY"}


def norm(x: str) -> str:
    """``text.norm_eval`` of a literal."""
    bare = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    return " ".join(bare.lower().replace("–", "-").replace("—", "-").split())


@dataclass(frozen=True)
class Policy:
    """What a user wants: topics, title rules as (phrase, family, policy), and what holds for a country by default."""

    core: tuple[str, ...]
    adjacent: tuple[str, ...]
    titles: tuple[tuple[str, str, str], ...]
    country_titles: dict[str, tuple[tuple[str, str, str], ...]] = field(default_factory=dict)
    mobility: dict[str, str] = field(default_factory=dict)

    @classmethod
    def read(cls, folder: str) -> Policy:
        """From a folder with roles.json, scientific_profile.json and mobility_policy.json."""
        roles, profile, mobility = (json.loads((Path(folder) / f"{n}.json").read_text("utf-8")) for n in ("roles", "scientific_profile", "mobility_policy"))
        tracks = profile.get("scientific_tracks", {})
        rules = lambda x: tuple((r["pattern"], r.get("family", "UNKNOWN"), r.get("policy", "CONDITIONAL")) for r in x)
        return cls(
            tuple(t for k, v in tracks.items() if "_CORE_" in k for t in v),
            tuple(tracks.get("C_ADJACENT", ())),
            rules(roles.get("global_title_patterns", ())),
            {c: rules(x) for c, x in roles.get("country_rules", {}).items()},
            {c: x.get("default_status", "VERIFY_CURRENT_RULES") for c, x in mobility.get("countries", {}).items()},
        )


def required(x: Column, subject: str) -> Column:
    return text.near(x, REQUIRED, subject, 100)


def _codes(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(code)) for c, code in pairs]))


def _upper(x: Column, default: str) -> Column:
    return F.upper(F.coalesce(F.nullif(x, F.lit("")), F.lit(default)))


def assembled(df: DataFrame) -> DataFrame:
    """Adds title, department, unit (both) and body, in rule form; the body is all evidence without boilerplate."""
    req, pos = F.col("requirements"), F.col("position")
    title = text.norm_eval(F.coalesce(F.nullif(pos["title_raw"], F.lit("")), pos["title_normalized"]))
    parts = text.assemble(
        title, pos["department"], pos["institution_raw"], req["degree_text"], F.array_join(req["degree_fields"], " "),
        F.array_join(req["methods_required"], " "), F.array_join(req["methods_preferred"], " "), req["work_rights_text"],
        req["sponsorship_text"], req["professional_registration_text"], req["teaching_requirement_text"],
        F.array_join(F.transform(req["language_requirements"], lambda x: F.coalesce(x["raw_text"], F.lit(""))), " "),
        F.col("description.full_jd"),
    )
    out = df.withColumns({"title": title, "department": text.norm_eval(pos["department"]), "body": text.scrub(text.norm_eval(parts), list(NOISE))})
    status = F.coalesce(F.col("description.detail_status"), F.lit("NOT_ATTEMPTED"))
    return out.withColumns(
        {
            "unit": text.squeeze(F.concat_ws(" ", "title", "department")),
            "country": F.upper(F.coalesce(F.col("location.country_code"), F.lit(""))),
            "detail_missing": ~status.isin(*GOOD_DETAIL) | (text.norm_eval(F.col("description.full_jd")) == ""),
            "has_detail": status.isin(*GOOD_DETAIL),
        }
    )


def _student() -> Column:
    return F.col("title").rlike(STUDENT) & ~F.contains(F.col("title"), F.lit("postdoc"))


def _french_faculty() -> Column:
    return (F.col("country") == "FR") & F.col("title").rlike(FRENCH_FACULTY)


def role(policy: Policy) -> Column:
    """(family, status): vetoes, a family known before, country rules, global rules, then what a title says by itself."""
    pair = lambda f, s: F.struct((f if isinstance(f, Column) else F.lit(f)).alias("family"), (s if isinstance(s, Column) else F.lit(s)).alias("status"))
    known = _upper(F.col("position.role_family"), "UNKNOWN")
    status = F.when(known.isin(*PRIMARY), "PRIMARY").when(known.isin(*SECONDARY), "SECONDARY").when(known == "OUT_OF_SCOPE", "OUT_OF_SCOPE").otherwise("CONDITIONAL")
    t, fellow = F.col("title"), F.when(F.col("body").rlike(FELLOW_EVIDENCE), "PRIMARY").otherwise("CONDITIONAL")
    rules = [(F.col("country") == c, r) for c, own in policy.country_titles.items() for r in own] + [(F.lit(True), r) for r in policy.titles]
    steps = [(_student() | _french_faculty(), pair("OUT_OF_SCOPE", "OUT_OF_SCOPE")), (known != "UNKNOWN", pair(known, status))]
    for here, (phrase, family, what) in rules:
        found = fellow if family == "RESEARCH_FELLOW_POSTDOC" else F.lit(STATUS_OF_POLICY.get(what, "CONDITIONAL"))
        if norm(phrase):
            steps.append((here & F.contains(t, F.lit(norm(phrase))), pair(family, found)))
    steps += [
        (t.rlike(SENIOR) & ~t.rlike("assistant professor"), pair("OUT_OF_SCOPE", "OUT_OF_SCOPE")),
        (t.rlike(r"\bresearch fellow\b"), pair("RESEARCH_FELLOW_POSTDOC", "CONDITIONAL")),
        (t.rlike(r"\bresearch(?:er)?\b|\bscientist\b"), pair("OTHER_RESEARCH", "CONDITIONAL")),
    ]
    out = pair("UNKNOWN", "AMBIGUOUS")
    for when, then in reversed(steps):
        out = F.when(when, then).otherwise(out)
    return out


def scientific(policy: Policy) -> Column:
    """(status, core, adjacent, unrelated): hits by topic, and the first unrelated field without any hit."""
    core_terms, near_terms = ([norm(x) for x in terms] for terms in (policy.core, policy.adjacent))
    body, unit = F.col("body"), F.col("unit")
    core, adjacent = text.phrase_hits(body, core_terms), text.phrase_hits(body, near_terms)
    count = lambda x, terms: F.size(text.phrase_hits(x, list(terms)))
    alien = first_of([((count(body, v) >= 2) | ((count(unit, v) > 0) & (count(body, v) >= 1)), k) for k, v in UNRELATED.items()])
    unrelated = F.when((F.size(core) == 0) & (F.size(adjacent) == 0), alien)
    title_core, title_near = count(unit, core_terms) > 0, count(unit, near_terms) > 0
    status = (
        F.when((F.size(core) >= 3) | (title_core & (F.size(core) >= 2)), "STRONG")
        .when(F.size(core) > 0, "GOOD")
        .when((F.size(adjacent) > 0) | title_near, "ADJACENT")
        .when(unrelated.isNotNull(), "WEAK")
        .otherwise("UNCLEAR")
    )
    return F.struct(status.alias("status"), core.alias("core"), adjacent.alias("adjacent"), unrelated.alias("unrelated"), _codes((status == "UNCLEAR", "UNCLEAR_DOMAIN")).alias("review"))


def level() -> Column:
    family, primary = F.col("role.family"), F.col("role.status") == "PRIMARY"
    years = F.col("body").rlike(MANY_YEARS)
    status = (
        F.when(family == "POSTDOC", "STRONG")
        .when(family == "RESEARCH_FELLOW_POSTDOC", F.when(primary, "STRONG").otherwise("REVIEW"))
        .when(family.isin(*FACULTY), F.when(years, "REVIEW").otherwise("ACCEPTABLE"))
        .when(family.isin(*SECONDARY), "REVIEW")
        .when(family == "OUT_OF_SCOPE", "MISMATCH")
        .when(family == "OTHER_RESEARCH", "REVIEW")
        .otherwise("UNKNOWN")
    )
    named = family.isin("POSTDOC", "RESEARCH_FELLOW_POSTDOC", *FACULTY, *SECONDARY, "OUT_OF_SCOPE")
    review = _codes(
        ((family == "RESEARCH_FELLOW_POSTDOC") & ~primary, "GENERIC_RESEARCH_FELLOW"),
        (family.isin(*FACULTY) & years, "VERY_SENIOR_EXPERIENCE_REQUIREMENT"),
        (family.isin(*SECONDARY), "SECONDARY_ROLE_DISABLED_BY_DEFAULT"),
        (~named, "UNCERTAIN_LOCAL_TITLE"),
    )
    return F.struct(status.alias("status"), review.alias("review"))


def methods() -> Column:
    body = F.col("body")
    normed = lambda name: F.filter(F.transform(F.coalesce(F.col(f"requirements.{name}"), F.array().cast("array<string>")), text.norm_eval), lambda x: x != "")
    needed, wished = normed("methods_required"), normed("methods_preferred")

    def known(x: Column) -> Column:
        hit = F.lit(False)
        for part in KNOWN_METHODS:
            hit = hit | F.contains(F.concat(F.lit(" "), x, F.lit(" ")), F.lit(part))
        return hit

    wet = F.lit(0)
    for p in WET_LAB:
        wet = wet + required(body, p).cast("int")
    blockers = _codes(
        *[(required(body, p), code) for code, p in METHOD_BLOCKERS.items()],
        (required(body, AI_SUBJECT) & body.rlike(AI_CENTRAL), "MANDATORY_ADVANCED_AI_ML"),
        (wet >= 2, "MANDATORY_SPECIALIST_WET_LAB"),
    )
    review = _codes(
        (body.rlike(ADVANCED_IMAGING) & required(body, "(?:fmri|neuroimaging)"), "ADVANCED_FMRI_ANALYSIS_NOT_ESTABLISHED"),
        (F.exists(needed, lambda x: ~known(x)), "METHOD_MISMATCH_UNCLEAR"),
    )
    status = (
        F.when(F.size(blockers) > 0, "MISMATCH")
        .when(F.size(review) > 0, "REVIEW")
        .when(F.size(needed) > 0, F.when(F.forall(needed, known), "STRONG").otherwise("ACCEPTABLE"))
        .when(F.size(wished) > 0, "ACCEPTABLE")
        .otherwise("UNKNOWN")
    )
    return F.struct(status.alias("status"), review.alias("review"), blockers.alias("blockers"))


def language() -> Column:
    body = F.col("body")
    teaching = (text.norm_eval(F.col("requirements.teaching_requirement_text")) != "") | body.rlike(TEACHING)
    none = F.array().cast("array<struct<language:string,level:string,mandatory:boolean,raw_text:string>>")
    items = F.coalesce(F.col("requirements.language_requirements"), none)

    def blocking(x: Column) -> Column:
        level_ = F.concat_ws(" ", text.norm_eval(x["level"]), text.norm_eval(x["raw_text"]))
        return (text.norm_eval(x["language"]) == "german") & F.coalesce(x["mandatory"], F.lit(False)) & level_.rlike("c1|c2") & teaching

    other = lambda x: (text.norm_eval(x["language"]) != "english") & F.coalesce(x["mandatory"], F.lit(False)) & ~blocking(x)
    unsaid = F.size(items) == 0
    by_text = unsaid & body.rlike(GERMAN_LEVEL) & body.rlike(TEACHING) & required(body, "german")
    local = unsaid & ~by_text & body.rlike(LOCAL_LANGUAGE) & required(body, "(?:dutch|french|german)")
    blockers = _codes((F.exists(items, blocking) | by_text, "MANDATORY_GERMAN_C1_C2_TEACHING"))
    # each language that is not established counts, so its code is repeated; the union of codes is distinct
    review = _codes((F.exists(items, other) | local, "LOCAL_LANGUAGE_MANDATORY_UNCONFIRMED"))
    status = F.when(F.size(blockers) > 0, "BLOCKED").when(F.size(review) > 0, "REVIEW").otherwise("CLEAR")
    return F.struct(status.alias("status"), review.alias("review"), blockers.alias("blockers"))


def mobility(policy: Policy) -> Column:
    req, country = F.col("requirements"), F.col("country")
    said = F.concat_ws(" ", text.norm_eval(req["sponsorship_text"]), text.norm_eval(req["work_rights_text"]), F.col("body"))
    default = first_of([(country == c, s) for c, s in policy.mobility.items()], "VERIFY_CURRENT_RULES")
    no, rights = said.rlike(SPONSOR_NO), said.rlike(WORK_RIGHTS)
    what = first_of(
        [
            ((country == "AU") & no & rights, "AU_NO_SPONSORSHIP_WORK_RIGHTS_REQUIRED"),
            (said.rlike(SPONSOR_YES) | said.rlike("hosting agreement"), "FAVORABLE"),
            (said.rlike(SPONSOR_MAYBE), "POTENTIALLY_VIABLE"),
            (no, "VISA_AMBIGUOUS"),
            (rights, "WORK_RIGHTS_RESTRICTION"),
            (default == "REVIEW", "SPONSORSHIP_UNSTATED"),
            (default == "VERIFY_CURRENT_RULES", "VERIFY_CURRENT_MOBILITY_RULES"),
        ],
        "DEFAULT",
    )
    blocked = what == "AU_NO_SPONSORSHIP_WORK_RIGHTS_REQUIRED"
    reviewed = what.isin("VISA_AMBIGUOUS", "WORK_RIGHTS_RESTRICTION", "SPONSORSHIP_UNSTATED", "VERIFY_CURRENT_MOBILITY_RULES")
    status = (
        F.when(blocked, "BLOCKED")
        .when(what.isin("FAVORABLE", "POTENTIALLY_VIABLE"), what)
        .when(what.isin("VISA_AMBIGUOUS", "WORK_RIGHTS_RESTRICTION"), "REVIEW")
        .otherwise(default)
    )
    return F.struct(status.alias("status"), F.when(reviewed, F.array(what)).otherwise(F.array().cast("array<string>")).alias("review"), F.when(blocked, F.array(what)).otherwise(F.array().cast("array<string>")).alias("blockers"))


def registration() -> Column:
    raw = text.norm_eval(F.col("requirements.professional_registration_text"))
    said = F.concat_ws(" ", raw, F.col("body"))
    hard = required(said, REGISTERED) | said.rlike(REGISTERED_HARD)
    status = F.when(said.rlike(REGISTERED_SOFT), "CLEAR").when(hard, "BLOCKED").when(raw.rlike("registration|registered|licen[cs]e"), "REVIEW").otherwise("CLEAR")
    return F.struct(
        status.alias("status"),
        _codes((status == "REVIEW", "PROFESSIONAL_REGISTRATION_AMBIGUOUS")).alias("review"),
        _codes((status == "BLOCKED", "MANDATORY_PROFESSIONAL_REGISTRATION")).alias("blockers"),
    )


def qualification() -> Column:
    """Blockers: a degree that is asked for."""
    said = F.concat_ws(" ", text.norm_eval(F.col("requirements.degree_text")), F.col("body"))
    return _codes((required(said, DEGREES[0]) | required(said, DEGREES[1]), "MANDATORY_MEDICAL_OR_NURSING_DEGREE"))


def contract() -> Column:
    term, employment = _upper(F.col("contract.term_type"), "UNKNOWN"), _upper(F.col("position.employment_type"), "UNKNOWN")
    casual = employment.isin("CASUAL", "SESSIONAL")
    fixed = ~casual & term.isin("FIXED_TERM", "TEMPORARY")
    short = fixed & F.coalesce(F.col("contract.duration_months") < 12, F.lit(False))
    status = F.when(casual | short, "REVIEW").when(term.isin("PERMANENT", "TENURE_TRACK"), "ATTRACTIVE").when(fixed, "ACCEPTABLE").otherwise("UNKNOWN")
    return F.struct(status.alias("status"), _codes((casual, "CASUAL_OR_SESSIONAL_ROLE"), (short, "SHORT_FIXED_TERM")).alias("review"))


def prior() -> Column:
    """What was decided before: disposition and codes."""
    none = F.array().cast("array<string>")
    c = F.col("classification")
    return F.struct(
        F.coalesce(F.nullif(c["pre_evaluation_disposition"], F.lit("")), F.lit("ELIGIBLE_FOR_EVALUATION")).alias("disposition"),
        F.coalesce(c["review_codes"], none).alias("review"),
        F.coalesce(c["blocker_codes"], none).alias("blockers"),
    )


#: The exits of the route in order: (name, recommendation).
EXITS = (
    ("blocker", "SKIP"), ("detail_missing", "REVIEW"), ("dimension", "REVIEW"), ("ambiguous", "REVIEW"), ("role", "REVIEW"),
    ("adjacent", "REVIEW"), ("weak", "LOW_PRIORITY"), ("contract", "REVIEW"), ("strong", "STRONG_APPLY"), ("apply", "APPLY"),
    ("codes", "REVIEW"), ("default", "LOW_PRIORITY"),
)


def route_exit() -> Column:
    """The first exit that holds, from the dimensions' columns and the codes."""
    s = lambda x: F.col(f"{x}.status")
    open_ = F.lit(False)
    for x in ("methods", "language", "mobility", "registration"):
        open_ = open_ | s(x).isin("REVIEW", "BLOCKED", "VERIFY_CURRENT_RULES")
    primary, sci, lev = s("role") == "PRIMARY", s("scientific"), s("level")
    holds = {
        "blocker": F.size("blocker_codes") > 0,
        "detail_missing": F.col("detail_missing"),
        "dimension": open_,
        "ambiguous": lev.isin("REVIEW", "UNKNOWN") | (sci == "UNCLEAR"),
        "role": s("role").isin("SECONDARY", "CONDITIONAL", "AMBIGUOUS"),
        "adjacent": sci == "ADJACENT",
        "weak": (sci == "WEAK") | (lev == "MISMATCH"),
        "contract": s("contract") == "REVIEW",
        "strong": primary & (sci == "STRONG") & (lev == "STRONG") & s("methods").isin("STRONG", "ACCEPTABLE", "UNKNOWN"),
        "apply": primary & sci.isin("STRONG", "GOOD") & lev.isin("STRONG", "ACCEPTABLE"),
        "codes": F.size("review_codes") > 0,
    }
    return first_of([(holds[name], name) for name, _ in EXITS[:-1]], EXITS[-1][0])


def dimensions(postings: DataFrame, policy: Policy) -> DataFrame:
    """``postings`` with the assembled text and one struct column for each dimension."""
    out = assembled(postings).withColumns({"role": role(policy), "scientific": scientific(policy)})
    return out.withColumns(
        {
            "level": level(), "methods": methods(), "language": language(), "mobility": mobility(policy), "registration": registration(),
            "qualification": qualification(), "contract_": contract(), "prior": prior(),
        }
    ).drop("contract").withColumnRenamed("contract_", "contract")


def evaluated(postings: DataFrame, policy: Policy) -> DataFrame:
    """The dimensions, ``blocker_codes``, ``review_codes``, ``exit``, ``recommendation`` and ``disposition``."""
    d = dimensions(postings, policy)
    outside = F.col("role.family") == "OUT_OF_SCOPE"
    blockers = F.concat(
        "prior.blockers", "methods.blockers", "language.blockers", "mobility.blockers", "registration.blockers", "qualification",
        _codes(
            (outside & _student(), "ROLE_STUDENT"),
            (outside & _french_faculty(), "FR_FACULTY_OUT_OF_SCOPE"),
            ((F.col("scientific.status") == "WEAK") & F.col("has_detail"), "HIGH_CONFIDENCE_UNRELATED_DOMAIN"),
        ),
    )
    reviews = F.concat(
        "prior.review", "scientific.review", "level.review", "methods.review", "language.review", "mobility.review",
        "registration.review", "contract.review", _codes((F.col("detail_missing"), "FULL_JD_UNAVAILABLE")),
    )
    out = d.withColumns({"blocker_codes": F.array_distinct(blockers), "review_codes": F.array_distinct(reviews)})
    out = out.withColumn("exit", route_exit())
    out = out.withColumn("recommendation", first_of([(F.col("exit") == name, to) for name, to in EXITS]))
    disposition = (
        F.when(F.size("blocker_codes") > 0, "POLICY_SKIP")
        .when(F.col("detail_missing"), "NEEDS_DETAIL_REVIEW")
        .when((F.size("review_codes") > 0) | (F.col("recommendation") == "REVIEW"), "POLICY_REVIEW")
        .otherwise("ELIGIBLE_FOR_EVALUATION")
    )
    return out.withColumn("disposition", disposition)
