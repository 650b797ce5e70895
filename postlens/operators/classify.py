"""Market and fit labels as column expressions over the rules of ``ontology``.

The market rules judge owned duties (clauses of the description); the fit rules
keep labels of their own and never read the market's. Nothing here leaves the
JVM: clauses are array columns, decisions are ``when`` chains over flags that an
earlier ``select`` computes once.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clauses, content_sha256, folded, has, matched_terms, needed, possible, rx, segments, tags, text_of, words_in
from .ontology import EVIDENCE, EXCLUSION_LABELS, EXCLUSION_ORDER, FIT, MARKET, MARKET_CASES, NON_QA_ROLES, SECURITY_TECHNIQUES, SKILLS

c = F.col
UNKNOWN = "CONTENT_CLASSIFICATION_UNKNOWN"


def first_of(*cases: tuple[Column, object], otherwise: object = None) -> Column:
    """The value of the first case that holds."""
    value = lambda v: v if isinstance(v, Column) else F.lit(v)
    chain = None
    for condition, result in cases:
        chain = F.when(condition, value(result)) if chain is None else chain.when(condition, value(result))
    return chain.otherwise(value(otherwise))


#: Words one of which a text must have for a pattern of the rules to occur in it: texts are gone through for all of them once.
WORDS = tuple(sorted({w for p in (*MARKET.values(), *MARKET_CASES.values(), *FIT.values(), *EVIDENCE.values(), *SECURITY_TECHNIQUES, *(p for _, p in SKILLS)) for w in needed(p)}))


# seen: the words of WORDS that a posting has, where they are known


def market(text: Column, rule: str, seen: Column | None = None) -> Column:
    return has(text, MARKET[rule], "i", seen)


def fit(text: Column, rule: str, seen: Column | None = None) -> Column:
    return has(text, FIT[rule], "", seen)


def some(values: Column) -> Column:
    return F.size(values) > 0


def owned(clause: Column, seen: Column | None = None) -> Column:
    """A duty the posting's holder answers for, not one they help with."""
    rule = partial(market, clause, seen=seen)
    return rule("owner") & (rule("independent") | (~rule("weak") & ~rule("helper")))


def product_evidence(duty: Column, asked: Column, seen: Column | None = None) -> Column:
    """Clauses that show a product manager: experience, research and planning, and no ownership of testing; else none.

    duty, asked: columns with the clauses of description and requirements, as each is gone through more than once.
    """
    experience = F.filter(asked, lambda s: has(s, EVIDENCE["product_years"]) & ~has(s, EVIDENCE["preferred"]))
    research = F.filter(duty, lambda s: has(s, EVIDENCE["research"]))
    planning = F.filter(duty, lambda s: has(s, EVIDENCE["planning"]))
    whole = some(experience) & some(research) & some(planning) & ~F.exists(duty, lambda s: has(s, EVIDENCE["qa_owner"]))
    if seen is not None:
        whole = reduce(Column.__and__, [possible(EVIDENCE[k], seen) for k in ("product_years", "research", "planning")]) & whole
    return F.when(whole, F.concat(research, planning, experience)).otherwise(F.slice(duty, 1, 0))


def security_duties(duty: Column, seen: Column | None = None) -> Column:
    found = F.filter(duty, lambda s: has(s, EVIDENCE["security_duty"]) & ~has(s, EVIDENCE["security_no_duty"]))
    return found if seen is None else F.when(possible(EVIDENCE["security_duty"], seen), found).otherwise(F.slice(duty, 1, 0))


def security_evidence(duty: Column) -> Column:
    """Clauses that show security as the main business, or at least two of its techniques; else none. duty: a column of ``security_duties``."""
    matched = F.filter(duty, lambda s: reduce(Column.__or__, [has(s, p) for p in SECURITY_TECHNIQUES]))
    shown = lambda p: F.exists(duty, lambda s: has(s, p)).cast("int")
    breadth = reduce(Column.__add__, [shown(p) for p in SECURITY_TECHNIQUES])
    business = F.filter(duty, lambda s: has(s, EVIDENCE["security_business"]))
    return F.when(some(business) | (breadth >= 2), F.concat(business, matched)).otherwise(F.slice(duty, 1, 0))


def seniority(title: Column, description: Column, requirements: Column, seen: Column | None = None) -> Column:
    rule = partial(fit, seen=seen)
    return first_of(
        (rule(title, "intern_title"), "intern"),
        (rule(title, "lead_title") | rule(description, "management_duty") | rule(requirements, "management_requirement"), "expert_lead"),
        (rule(title, "senior_title") | rule(requirements, "six_years"), "senior"),
        otherwise="regular",
    )


#: Title rules in their order: family, reason to exclude (or none), rule.
_TITLES = (
    ("product", "role_product", "product_title"),
    ("operations", "role_operations", "operations_title"),
    ("domain_expert", "role_domain_expert", "domain_title"),
    ("development", "role_agent_development", "agent_title"),
    ("quality_engineering", None, "quality_title"),
    ("qa_test", None, "qa_title"),
    ("development", "role_general_rnd", "rnd_title"),
    ("algorithm_research", "role_algorithm_or_research", "algorithm_title"),
    ("evaluation_engineering", None, "eval_title"),
)


def title_role(title: Column) -> tuple[Column, Column]:
    """Family by title, and the reason it excludes for."""
    family = first_of(*[(fit(title, rule), name) for name, _, rule in _TITLES], otherwise="development")
    reason = first_of(*[(fit(title, rule), F.lit(why).cast("string")) for _, why, rule in _TITLES], otherwise="role_general_rnd")
    return family, reason


def hard_domain(title: Column, guarded: Column) -> Column:
    """guarded: a column of ``security_duties``."""
    return first_of(
        (fit(title, "hardware"), "domain_hardware"),
        (fit(title, "game"), "domain_game"),
        (fit(title, "security_title") | some(security_evidence(guarded)), "domain_security"),
        otherwise=F.lit(None).cast("string"),
    )


def relation(title: Column, description: Column, requirements: Column, role: Column, domain: Column, seen: Column | None = None) -> Column:
    """The fit rules' AI relation, ``value``, and the ``rule`` that gave it: one chain for both, as its patterns are long."""
    rule = partial(fit, seen=seen)
    context = rule(F.concat_ws("\n", title, description, requirements), "context")
    near = F.when(context, "ai_context_only").otherwise("none")
    core_duty, testing, product = (rule(description, k) for k in ("core_duty", "testing_duty", "product_duty"))
    eval_title, strong = rule(title, "eval_title"), rule(description, "testing_strong")
    lead = strong & rule(F.coalesce(F.try_element_at(segments(description), F.lit(1)), F.lit("")), "testing_strong")
    measured = role.isin("evaluation_engineering", "algorithm_research")
    other = role.isin(*NON_QA_ROLES)
    no = F.lit(False)
    cases = (
        (F.coalesce(domain == "domain_security", no), "none", "hard_security_non_ai_evaluation"),
        (F.coalesce(domain == "domain_hardware", no), near, "hardware_context_not_ai_quality"),
        (measured & context & (eval_title | core_duty), "core_ai_evaluation", "evaluation_role_primary"),
        (measured, near, "evaluation_role_without_ai_evaluation_duty"),
        (other & (role == "development") & rule(title, "agent_title"), "ai_for_testing", "agent_development_for_testing"),
        (other & (eval_title | core_duty), "core_ai_evaluation", "non_target_evaluation_role"),
        (other & testing, "ai_for_testing", "non_target_ai_for_testing"),
        (other, near, "non_target_context_only"),
        (core_duty & (rule(title, "core_title") | rule(description, "core_decision")), "core_ai_evaluation", "model_evaluation_primary"),
        (rule(title, "product_primary") & rule(description, "primary_quality_duty"), "ai_product_quality", "title_primary_ai_product_quality"),
        (lead, "ai_for_testing", "ai_testing_capability_primary"),
        (product, "ai_product_quality", "ai_product_quality_primary"),
        (strong, "ai_for_testing", "ai_testing_capability_primary"),
        (testing & rule(title, "context"), "ai_for_testing", "title_supported_ai_for_testing"),
        (rule(title, "product_words") & rule(description, "ordinary_quality_duty"), "ai_product_quality", "title_supported_ai_product_quality"),
        (context, "ai_context_only", "ai_context_not_primary"),
    )
    both = lambda value, name: F.struct((value if isinstance(value, Column) else F.lit(value)).alias("value"), F.lit(name).alias("rule"))
    return first_of(*[(when, both(value, name)) for when, value, name in cases], otherwise=both("none", "no_ai_relation"))


def pool(role: Column, ai_relation: Column, level: Column, role_reason: Column, domain: Column, research_hard: Column) -> tuple[Column, Column]:
    """Career pool and the reason code, null for none."""
    research = role == "algorithm_research"
    cases = (
        (domain.isNotNull(), "X", domain),
        (role.isin(*NON_QA_ROLES), "X", F.coalesce(role_reason, F.lit("role_general_rnd"))),
        (level == "intern", "X", "level_intern"),
        (research & (research_hard | (ai_relation != "core_ai_evaluation")), "X", "role_algorithm_or_research"),
        (ai_relation.isin("ai_context_only", "none"), "X", "ai_not_primary_duty"),
        (level == "expert_lead", "REF", "level_expert_lead"),
        (role.isin("qa_test", "quality_engineering"), "P1", F.lit(None).cast("string")),
    )
    reason = first_of(*[(when, why) for when, _, why in cases], otherwise=F.when(research, "role_algorithm_or_research"))
    return first_of(*[(when, value) for when, value, _ in cases], otherwise="P2"), reason


def with_inputs(jobs: DataFrame) -> DataFrame:
    """Adds ``_title, _body, _req``, the only fields the rules read, and the clauses ``_parts, _asks`` of the latter two."""
    fields = jobs.withColumns({"_title": text_of(c("title")), "_body": text_of(c("description")), "_req": text_of(c("requirements"))})
    return fields.withColumns({"_parts": clauses(c("_body")), "_asks": clauses(c("_req"))})


def add_labels(jobs: DataFrame) -> DataFrame:
    """Adds ``market``, ``fit`` and ``skill_tags``. Texts are gone through for WORDS once, and only patterns that these allow are tried.

    A filter on the labels would be pushed through to the words, for each pattern anew: write the labels before filtering them.
    """
    rows = jobs.withColumn("label_text", folded(F.concat_ws("\n", *[text_of(c(k)) for k in ("title", "description", "requirements")])))
    rows = rows.withColumn("label_words", words_in(c("label_text"), WORDS)).drop("label_text")
    seen = c("label_words")
    return add_skills(add_fit(add_market(rows, seen), seen), seen).drop("label_words")


def add_fit(jobs: DataFrame, seen: Column | None = None) -> DataFrame:
    """Adds ``fit``: role_family, ai_relation, seniority_level, career_pool, reason_codes, rule_id, triggered_rules, reason."""
    title, body, req = c("_title"), c("_body"), c("_req")
    own, own_reason = title_role(title)
    jobs = with_inputs(jobs).withColumns({"_product": product_evidence(c("_parts"), c("_asks"), seen), "_role": own, "_why": own_reason})
    role = first_of((some(c("_product")), "product"), ((c("_role") == "qa_test") & fit(body, "management_duty", seen), "quality_engineering"), otherwise=c("_role"))
    jobs = jobs.withColumns({"_why": F.when(some(c("_product")), "role_product").otherwise(c("_why")), "_role": role, "_level": seniority(title, body, req, seen)})
    target = ~c("_role").isin(*NON_QA_ROLES)
    jobs = jobs.withColumn("_guarded", F.when(target, security_duties(c("_parts"), seen)))
    jobs = jobs.withColumn("_domain", F.when(target, hard_domain(title, c("_guarded"))))
    jobs = jobs.withColumn("_both", relation(title, body, req, c("_role"), c("_domain"), seen))
    jobs = jobs.withColumns({"_rel": c("_both.value"), "_rule": c("_both.rule"), "_research": fit(F.concat_ws("\n", title, body, req), "research_hard", seen)})
    chosen, reason = pool(c("_role"), c("_rel"), c("_level"), c("_why"), c("_domain"), c("_research"))
    jobs = jobs.withColumns({"_pool": chosen, "_reason": reason})
    label = first_of(*[(c("_reason") == code, text) for code, text in EXCLUSION_LABELS.items()], otherwise="")
    told = F.when(c("_pool") == "X", F.concat(label, F.lit("。"))).otherwise(
        F.concat(F.lit("三字段证据判定岗位主职能为 "), c("_role"), F.lit("；AI 关系为 "), c("_rel"), F.lit("；层级为 "), c("_level"), F.lit("；进入 "), c("_pool"), F.lit(" 池。"))
    )
    codes = F.array_compact(F.array("_reason"))
    out = F.struct(
        c("_role").alias("role_family"),
        c("_rel").alias("ai_relation"),
        c("_level").alias("seniority_level"),
        c("_pool").alias("career_pool"),
        codes.alias("reason_codes"),
        F.concat_ws("_", "_role", "_rel", F.lower("_pool")).alias("rule_id"),
        F.concat(F.array("_rule"), codes).alias("triggered_rules"),
        told.alias("reason"),
    )
    return jobs.withColumn("fit", out).drop("_product", "_role", "_why", "_level", "_domain", "_rel", "_rule", "_research", "_pool", "_reason", "_title", "_body", "_req", "_parts", "_asks", "_guarded", "_both")


def add_market(jobs: DataFrame, seen: Column | None = None) -> DataFrame:
    """Adds ``market``: in_scope, market_relevance, role_family, secondary_role_families, ai_relation, seniority_level, reason_codes, evidence."""
    title, body, req = c("_title"), c("_body"), c("_req")
    said = lambda text, pattern: has(text, pattern, seen=seen)
    isaid = lambda text, pattern: has(text, pattern, "i", seen)
    rule = partial(market, seen=seen)
    jobs = with_inputs(jobs).withColumn("_ai", rule(F.concat_ws("\n", title, body, req), "ai"))
    # a posting without any AI term is out of scope whatever its duties, so they are not looked through
    distinct = lambda parts: F.when(c("_ai"), F.array_sort(F.array_distinct(parts))).otherwise(F.array().cast("array<string>"))
    jobs = jobs.withColumns({"_duties": distinct(c("_parts")), "_asked": distinct(c("_asks")), "_product": product_evidence(c("_parts"), c("_asks"), seen), "_level": seniority(title, body, req, seen)})
    duties = c("_duties")
    jobs = jobs.withColumn("_owned", F.filter(duties, lambda s: owned(s, seen)))
    own = lambda name: F.filter("_owned", lambda s: rule(s, name))
    mixed = said(body, MARKET_CASES["mixed_duty"])
    jobs = jobs.withColumn("_mixed", mixed)
    measuring = F.filter(own("eval"), lambda s: ~said(s, MARKET["test_metric"]) & ~(c("_mixed") & said(s, MARKET_CASES["mixed_platform"])))
    methods = F.filter(duties, lambda s: rule(s, "test_method") & (~said(s, MARKET_CASES["tool_search"]) | said(s, MARKET_CASES["tool_in_use"])))
    none = F.slice(duties, 1, 0)
    jobs = jobs.withColumns({"_eval": measuring, "_quality": own("quality_work"), "_systems": own("quality_system"), "_methods": methods, "_infra": F.when(c("_mixed"), none).otherwise(own("eval_infra"))})
    quality_title, qa_title, eval_title = (rule(title, k) for k in ("quality_title", "qa_title", "eval_title"))
    qa_asked = rule(req, "qa_requirement")
    jobs = jobs.withColumns(
        {
            "_dedicated": some(c("_infra")) | (eval_title & isaid(title, MARKET_CASES["infra_title"])),
            "_qa": quality_title | qa_title | qa_asked,
            "_eval_id": eval_title & (some(c("_eval")) | ((rule(body, "ai") | said(body, MARKET_CASES["measured_model"])) & said(body, MARKET_CASES["measuring_words"]))),
        }
    )
    jobs = jobs.withColumn("_tasks", F.when(c("_qa"), F.filter(duties, lambda s: rule(s, "quality_work"))).otherwise(c("_quality")))
    explicit = F.exists("_tasks", lambda s: rule(s, "product_object"))
    traditional = F.exists("_tasks", lambda s: said(s, MARKET_CASES["other_products"]))
    jobs = jobs.withColumn("_pq", c("_mixed") | explicit | (some(c("_tasks")) & rule(title, "product_title") & ~(some(c("_methods")) & traditional)))
    jobs = jobs.withColumn("_in", c("_ai") & (some(c("_eval")) | some(c("_infra")) | c("_eval_id") | ((c("_qa") | some(c("_systems"))) & (some(c("_methods")) | c("_pq")))))
    profession = rule(req, "eval_profession")
    role = first_of(
        (some(c("_product")) | isaid(title, MARKET_CASES["product_title"]), "product"),
        (said(title, MARKET_CASES["operations_title"]), "operations"),
        (isaid(title, MARKET_CASES["expert_title"]) | (said(title, MARKET_CASES["security_research"]) & said(req, MARKET_CASES["security_requirement"])), "domain_expert"),
        (quality_title | (qa_asked & some(c("_quality")) & ~qa_title), "quality_engineering"),
        (qa_title & said(body, MARKET_CASES["team_duty"]), "quality_engineering"),
        (qa_title & some(c("_eval")) & rule(body, "model_decision") & profession, "evaluation_engineering"),
        (qa_title, "qa_test"),
        (c("_dedicated") & said(title, MARKET_CASES["infra_algorithm"]) & profession, "evaluation_engineering"),
        (rule(title, "model_research"), "algorithm_research"),
        (said(title, MARKET_CASES["backend_title"]), "development"),
        (eval_title, "evaluation_engineering"),
        otherwise="development",
    )
    jobs = jobs.withColumn("_role", role)
    platform = said(body, MARKET_CASES["testing_platform"]) & ~said(body, MARKET_CASES["model_ability"])
    system = isaid(body, MARKET_CASES["testing_system"])
    measured = some(c("_eval"))
    alone = F.when((c("_role") == "development") & measured & ~c("_dedicated"), said(F.array_join("_eval", "\n"), MARKET_CASES["measure_words"])).otherwise(measured)
    jobs = jobs.withColumns({"_platform": platform, "_alone": alone})
    rel = first_of(
        (c("_dedicated") | (measured & isaid(title, MARKET_CASES["ai_eval_title"]) & ~said(title, MARKET_CASES["no_eval_title"])), "core_ai_evaluation"),
        (c("_platform"), "ai_for_testing"),
        (c("_role").isin("qa_test", "quality_engineering") & c("_pq"), "ai_product_quality"),
        ((c("_role") == "product") & c("_pq") & ~said(body, MARKET_CASES["product_research"]), "ai_product_quality"),
        (system & ~c("_pq"), "ai_for_testing"),
        ((c("_role") == "development") & measured & ~c("_alone"), "ai_product_quality"),
        (measured | c("_eval_id"), "core_ai_evaluation"),
        otherwise="ai_for_testing",
    )
    reliability = said(title, MARKET_CASES["observability"]) & ~said(body, MARKET_CASES["eval_words"])
    also_eval = (c("_role") != "evaluation_engineering") & (measured | c("_dedicated")) & ~reliability & ~c("_platform")
    also_quality = ~c("_role").isin("qa_test", "quality_engineering") & F.exists("_systems", lambda s: ~said(s, MARKET_CASES["data_quality"]))
    second = F.array_compact(F.array(F.when(also_eval, "evaluation_engineering"), F.when(also_quality, "quality_engineering")))
    jobs = jobs.withColumns({"_rel": rel, "_second": second})
    two_sided = said(body, MARKET_CASES["ability_limits"]) & said(body, MARKET_CASES["eval_training"])
    development, research, operations = (c("_role") == x for x in ("development", "algorithm_research", "operations"))
    near = first_of(
        (development & measured & ~c("_dedicated") & ~c("_alone"), True),
        (research & ~eval_title, ~two_sided),
        (operations & (c("_rel") == "ai_for_testing"), True),
        ((c("_role") == "domain_expert") & said(body, MARKET_CASES["real_risks"]), True),
        otherwise=False,
    )
    jobs = jobs.withColumn("_relevance", F.when(near, "adjacent").otherwise("core"))
    codes = F.array_compact(
        F.array(
            F.concat(F.lit("MARKET_"), F.upper("_relevance"), F.lit("_ACCOUNTABLE_WORK")),
            F.concat(F.lit("PRIMARY_"), F.upper("_role")),
            F.concat(F.lit("RELATION_"), F.upper("_rel")),
            F.when(c("_dedicated"), "DEDICATED_EVALUATION_INFRA"),
            F.when(some(c("_second")), "SUBSTANTIAL_SECONDARY_DELIVERABLES"),
        )
    )
    # where the fit rules' own labels agree, their rule is the reason told
    fit_role, _ = title_role(title)
    fit_role = F.when((fit_role == "qa_test") & fit(body, "management_duty", seen), "quality_engineering").otherwise(fit_role)
    jobs = jobs.withColumns({"_fit_role": fit_role, "_codes": codes})
    jobs = jobs.withColumn("_both", F.when(c("_in"), relation(title, body, req, c("_fit_role"), F.lit(None).cast("string"), seen)))
    agree = (c("_fit_role") == c("_role")) & (c("_both.value") == c("_rel"))
    inside = c("_in")
    quotes = F.array_sort(F.array_distinct(F.concat("_eval", "_quality", "_systems", "_methods", "_infra", F.filter("_product", lambda s: F.array_contains("_duties", s)))))
    asked = F.array_sort(F.array_distinct(F.concat(F.filter("_asked", lambda s: rule(s, "qa_requirement") | rule(s, "eval_profession")), F.filter("_product", lambda s: F.array_contains("_asked", s)))))
    no_text = F.array().cast("array<string>")
    out = F.struct(
        inside.alias("in_scope"),
        F.when(inside, c("_relevance")).alias("market_relevance"),
        F.when(inside, c("_role")).alias("role_family"),
        F.when(inside, c("_second")).otherwise(no_text).alias("secondary_role_families"),
        F.when(inside, c("_rel")).alias("ai_relation"),
        c("_level").alias("seniority_level"),
        first_of((~inside, F.array(F.lit("AI_EVALUATION_NOT_ESTABLISHED"))), (agree, F.array("_both.rule")), otherwise=c("_codes")).alias("reason_codes"),
        F.struct(
            F.when(inside & (title != ""), F.array(title)).otherwise(no_text).alias("title"),
            F.when(inside, quotes).otherwise(no_text).alias("description"),
            F.when(inside, asked).otherwise(no_text).alias("requirements"),
        ).alias("evidence"),
    )
    jobs = jobs.withColumn("market", out)
    return jobs.drop(*[x for x in jobs.columns if x.startswith("_")])


def add_skills(jobs: DataFrame, seen: Column | None = None) -> DataFrame:
    joined = F.concat_ws("\n", *[text_of(c(k)) for k in ("title", "description", "requirements")])
    return jobs.withColumn("skill_tags", tags(joined, SKILLS, seen))


def invalid_market(jobs: DataFrame) -> DataFrame:
    """Rows whose ``market`` breaks the output's contract, with the first broken rule; empty when all is well."""
    from .ontology import AI_RELATIONS, ROLE_FAMILIES

    m, second = c("market"), c("market.secondary_role_families")
    families = F.array(*[F.lit(x) for x in ROLE_FAMILIES])
    bad_second = second.isNull() | (F.size(second) > 2) | (F.size(F.array_distinct(second)) != F.size(second)) | some(F.array_except(second, families))
    broken = first_of(
        (m["in_scope"].isNull(), "INVALID_MARKET_SCOPE"),
        (bad_second, "INVALID_MARKET_SECONDARY"),
        (m["in_scope"] & (F.coalesce(~m["role_family"].isin(*ROLE_FAMILIES), F.lit(True)) | F.coalesce(~m["ai_relation"].isin(*AI_RELATIONS), F.lit(True))), "INVALID_MARKET_ENUM"),
        (m["in_scope"] & (F.coalesce(~m["market_relevance"].isin("core", "adjacent"), F.lit(True)) | F.array_contains(second, m["role_family"])), "INVALID_MARKET_ROLE_STRUCTURE"),
        (~m["in_scope"] & (m["market_relevance"].isNotNull() | m["role_family"].isNotNull() | m["ai_relation"].isNotNull() | some(second)), "MARKET_STOP_SEMANTICS_VIOLATION"),
        (F.coalesce(F.exists(m["reason_codes"], lambda x: x.isNull() | (x == "")), F.lit(True)), "INVALID_MARKET_REASONS"),
        otherwise=F.lit(None).cast("string"),
    )
    return jobs.withColumn("broken", broken).where("broken IS NOT NULL")


def ordered_reasons(codes: Column) -> Column:
    """Known exclusion reasons in the order they are told."""
    return F.filter(F.array(*[F.lit(x) for x in EXCLUSION_ORDER]), lambda x: F.array_contains(codes, x))


def explain(jobs: DataFrame, in_scope: Column | None = None) -> DataFrame:
    """Adds ``selected`` and, for the others, ``exclusion_codes`` and ``exclusion_reason``; needs ``fit``."""
    inside = F.lit(True) if in_scope is None else in_scope
    codes = ordered_reasons(F.concat(F.when(~inside, F.array(F.lit("outside_config_scope"))).otherwise(F.array().cast("array<string>")), c("fit.reason_codes")))
    chosen = inside & (c("fit.career_pool") != "X")
    labels = F.create_map(*[x for pair in EXCLUSION_LABELS.items() for x in map(F.lit, pair)])
    reason = F.concat(F.array_join(F.transform(codes, lambda x: labels[x]), "；"), F.lit("。"))
    return jobs.withColumns({"selected": chosen, "exclusion_codes": F.when(~chosen, codes), "exclusion_reason": F.when(~chosen, reason)})


def classification_unknown(status: Column, market_codes: Column) -> Column:
    return (status == "review_required") & F.array_contains(market_codes, UNKNOWN)


def market_reliable(status: Column, market_codes: Column, fit_codes: Column) -> Column:
    """A need to replay fit or skills does not undo an inherited market fact."""
    return (status != "review_required") | (F.array_contains(market_codes, "CONTENT_CARRIED_FORWARD") & (fit_codes == F.array(F.lit("REPLAY_REQUIRED"))))


def spread(jobs: DataFrame) -> DataFrame:
    """``jobs`` over all cores where it comes in fewer partitions than there are: labels cost milliseconds a text, its shuffle microseconds.

    jobs: rows straight from a table; of a plan with shuffles, asking for its partitions would run them.
    """
    cores = jobs.sparkSession.sparkContext.defaultParallelism
    return jobs.repartition(cores) if jobs.rdd.getNumPartitions() < 2 * cores else jobs


#: What a classification row says, in the order of its columns.
_LABELS = ("market_relevance", "role_family", "ai_relation", "seniority_level")
_OWN = ("content_sha256", "in_scope", *_LABELS, "secondary_role_families", "career_pool", "market_codes", "fit_codes", "evidence", "skill_tags", "classification_status")
_IDENTITY = ("snapshot_date", "platform", "job_id", "company", "title", "url")


def labelled(jobs: DataFrame) -> DataFrame:
    """Dated postings with the labels of their own text, ``reliable``, ``failed`` (their detail page did) and ``anchor``.

    anchor: what later days whose detail page fails may inherit; null where this day's failed. A fresh row is ``usable``,
    a reliable posting out of scope or a doubtful row is not, and ends what was held before.
    """
    none, content = F.array().cast("array<string>"), c("content_reliable")
    failed = ~content & F.arrays_overlap("health_reasons", F.array(F.lit("DETAIL_FAILED_JOB_ID"), F.lit("PROBABLE_DETAIL_FAILURE")))
    own = {
        "content_sha256": content_sha256(),
        "in_scope": c("market.in_scope"),
        **{k: c(f"market.{k}") for k in _LABELS},
        "secondary_role_families": c("market.secondary_role_families"),
        "career_pool": F.when(content, c("fit.career_pool")),
        "market_codes": c("market.reason_codes"),
        "fit_codes": F.when(content, c("fit.reason_codes")).otherwise(F.array(F.lit("INSUFFICIENT_CONTENT"))),
        "evidence": c("market.evidence"),
        "skill_tags": F.when(content, c("skill_tags")).otherwise(none),
        "classification_status": F.when(content, "fresh").otherwise("review_required"),
    }
    cities = c("city_norm") if "city_norm" in jobs.columns else none.alias("city_norm")
    rows = add_skills(add_fit(add_market(jobs))).select(*_IDENTITY, cities, content.alias("reliable"), failed.alias("failed"), *[v.alias(k) for k, v in own.items()])
    return rows.withColumn("anchor", F.when(~c("failed"), F.struct((c("reliable") & c("in_scope")).alias("usable"), *_OWN)))


def carried(rows: DataFrame, market_version: str, fit_version: str, skills_version: str) -> DataFrame:
    """Classification rows of ``labelled`` rows with ``held``, the anchor that holds before their day (or null).

    Only observations that are in scope, unknown or carried have a row.
    """
    none, text = F.array().cast("array<string>"), F.lit(None).cast("string")
    inherits = c("failed") & F.coalesce(c("held.usable"), F.lit(False))
    rows = rows.withColumn("_state", F.when(inherits, "carried").when(c("failed"), "unknown").when(c("in_scope"), "today")).where("_state IS NOT NULL")
    old = lambda k: c(f"held.{k}")
    verify = F.when(old("career_pool").isin("P1", "P2"), F.array_union(old("fit_codes"), F.array(F.lit("DETAIL_VERIFICATION_REQUIRED")))).otherwise(old("fit_codes"))
    kept = {"classification_status": F.lit("carried_forward"), "market_codes": F.array_union(old("market_codes"), F.array(F.lit("CONTENT_CARRIED_FORWARD"))), "fit_codes": verify}
    no_quotes = F.struct(none.alias("title"), none.alias("description"), none.alias("requirements"))
    unknown = {
        **{k: text for k in (*_LABELS, "career_pool")},
        "in_scope": F.lit(None).cast("boolean"),
        "secondary_role_families": none,
        "skill_tags": none,
        "classification_status": F.lit("review_required"),
        "market_codes": F.array(F.lit(UNKNOWN)),
        "fit_codes": F.array(F.lit("INSUFFICIENT_CONTENT")),
        "evidence": no_quotes,
    }
    state = lambda x: c("_state") == x
    out = {k: F.when(state("carried"), kept.get(k, old(k))).when(state("unknown"), unknown.get(k, c(k))).otherwise(c(k)) for k in _OWN}
    codes = F.struct(out.pop("market_codes").alias("market"), out.pop("fit_codes").alias("fit"))
    versions = F.struct(F.lit(market_version).alias("market"), F.lit(fit_version).alias("fit"), F.lit(skills_version).alias("skills"))
    return rows.select(*_IDENTITY, "city_norm", *[v.alias(k) for k, v in out.items()], codes.alias("reason_codes"), versions.alias("versions"))


def classify_snapshots(jobs: DataFrame, market_version: str, fit_version: str, skills_version: str) -> DataFrame:
    """Classification rows of dated postings, with labels carried over days whose detail page failed.

    jobs: postings with ``snapshot_date``, and the resolved health columns ``content_reliable`` and ``health_reasons``.
    """
    # labels are computed once, before the one shuffle that carries them along each identity's days
    rows = labelled(jobs).repartition("platform", "job_id")
    before = Window.partitionBy("platform", "job_id").orderBy("snapshot_date").rowsBetween(Window.unboundedPreceding, -1)
    return carried(rows.withColumn("held", F.last("anchor", ignorenulls=True).over(before)), market_version, fit_version, skills_version)


def workplace_match(jobs: DataFrame) -> DataFrame:
    """Adds ``workplace``: whether location or title names the wanted city as a workplace; a negation in either vetoes."""
    from .ontology import CITY_ALIASES, CITY_PATTERN, WORKPLACE, WORKPLACE_NEGATED, WORKPLACE_OTHER_SENSE

    alias = F.create_map(*[x for pair in CITY_ALIASES.items() for x in map(F.lit, pair)])
    fields = {k: F.coalesce(c(k), F.lit("")) for k in ("location", "title")}
    negated = {k: has(t, WORKPLACE_NEGATED) for k, t in fields.items()}
    # mentions inside a negation or a name are blanked out; what is left names a workplace
    left = {k: F.regexp_replace(F.regexp_replace(t, rx(WORKPLACE_NEGATED), "#"), rx(WORKPLACE_OTHER_SENSE), "#") for k, t in fields.items()}
    named = {k: has(t, WORKPLACE) for k, t in left.items()}
    cities = {k: F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(CITY_PATTERN), 0), lambda x: alias[x]))) for k, t in fields.items()}
    yes, no = named["location"] | named["title"], negated["location"] | negated["title"]
    listed = lambda flags: F.array_compact(F.array(*[F.when(v, k) for k, v in flags.items()]))
    conflict = (yes & no) | (some(cities["location"]) & some(cities["title"]) & (cities["location"] != cities["title"]))
    out = F.struct((yes & ~no).alias("matches"), listed(named).alias("positive_fields"), listed(negated).alias("negative_fields"), conflict.alias("location_conflict"), ((yes & ~no) | (yes & no)).alias("needs_verification"))
    return jobs.withColumn("workplace", out)


def select_candidates(rows: DataFrame) -> DataFrame:
    """P1 and P2 rows with a matching workplace."""
    return workplace_match(rows).where(c("career_pool").isin("P1", "P2") & c("workplace.matches"))


def evidence_terms(text: Column, rule: str) -> Column:
    """The words that made a fit rule hold, as in reports."""
    return matched_terms(text, FIT[rule])
