"""Postings made up for the label rules, with the labels that the rules' wording gives them: one at least for each branch."""

#: title, description, requirements; role family, AI relation, seniority, pool, rule of the relation.
FIT = [
    ("安全评测工程师", "负责大模型安全评测", "", "evaluation_engineering", "none", "regular", "X", "hard_security_non_ai_evaluation"),
    ("AI芯片测试工程师", "执行用例", "", "qa_test", "ai_context_only", "regular", "X", "hardware_context_not_ai_quality"),
    ("芯片测试工程师", "执行用例", "", "qa_test", "none", "regular", "X", "hardware_context_not_ai_quality"),
    ("大模型评测工程师", "制定模型评测标准", "", "evaluation_engineering", "core_ai_evaluation", "regular", "P2", "evaluation_role_primary"),
    ("广告效果评估专员", "负责广告投放效果分析", "", "evaluation_engineering", "none", "regular", "X", "evaluation_role_without_ai_evaluation_duty"),
    ("推荐算法工程师", "负责大模型应用", "", "algorithm_research", "ai_context_only", "regular", "X", "evaluation_role_without_ai_evaluation_duty"),
    ("AI Agent开发工程师", "负责接口开发", "", "development", "ai_for_testing", "regular", "X", "agent_development_for_testing"),
    ("AI产品经理（评测方向）", "负责需求分析", "", "product", "core_ai_evaluation", "regular", "X", "non_target_evaluation_role"),
    ("后端开发工程师", "搭建测试Agent，支持用例自动生成", "", "development", "ai_for_testing", "regular", "X", "non_target_ai_for_testing"),
    ("AI应用后端开发工程师", "负责接口开发与维护", "", "development", "ai_context_only", "regular", "X", "non_target_context_only"),
    ("大模型评测测试工程师", "构建评测集", "", "qa_test", "core_ai_evaluation", "regular", "P1", "model_evaluation_primary"),
    ("AI软件测试工程师", "负责功能测试", "", "qa_test", "ai_product_quality", "regular", "P1", "title_primary_ai_product_quality"),
    ("测试开发工程师", "搭建测试Agent；维护接口用例", "", "quality_engineering", "ai_for_testing", "regular", "P1", "ai_testing_capability_primary"),
    ("测试工程师", "负责日常回归；负责AI产品的质量保障", "", "qa_test", "ai_product_quality", "regular", "P1", "ai_product_quality_primary"),
    ("测试工程师", "负责日常回归；落地测试Agent", "", "qa_test", "ai_for_testing", "regular", "P1", "ai_testing_capability_primary"),
    ("AI测试工程师", "推进AI驱动的质量提升", "", "qa_test", "ai_for_testing", "regular", "P1", "title_supported_ai_for_testing"),
    ("智能助手测试工程师", "负责功能测试", "", "qa_test", "ai_product_quality", "regular", "P1", "title_supported_ai_product_quality"),
    ("测试工程师", "了解AI技术；执行用例", "", "qa_test", "ai_context_only", "regular", "X", "ai_context_not_primary"),
    ("测试工程师", "执行用例", "", "qa_test", "none", "regular", "X", "no_ai_relation"),
    ("测试实习生", "负责AI产品的质量保障", "", "qa_test", "ai_product_quality", "intern", "X", "ai_product_quality_primary"),
    ("测试专家", "负责AI产品的质量保障", "", "quality_engineering", "ai_product_quality", "expert_lead", "REF", "ai_product_quality_primary"),
    ("高级测试工程师", "负责AI产品的质量保障", "", "qa_test", "ai_product_quality", "senior", "P1", "ai_product_quality_primary"),
    ("测试工程师", "负责AI产品的质量保障", "6年以上测试经验", "qa_test", "ai_product_quality", "senior", "P1", "ai_product_quality_primary"),
    ("测试工程师", "负责AI产品的质量保障；培养团队成员", "", "quality_engineering", "ai_product_quality", "expert_lead", "REF", "ai_product_quality_primary"),
    ("游戏AI测试工程师", "负责AI产品的质量保障", "", "qa_test", "ai_product_quality", "regular", "X", "ai_product_quality_primary"),
    ("测试工程师", "负责漏洞挖掘和渗透测试；负责AI产品的质量保障", "", "qa_test", "none", "regular", "X", "hard_security_non_ai_evaluation"),
    ("医学领域专家", "负责标注", "", "domain_expert", "none", "expert_lead", "X", "non_target_context_only"),
    ("测试开发工程师", "负责用户调研；负责产品规划", "3年以上产品经验", "product", "none", "regular", "X", "non_target_context_only"),
]

#: title, description, requirements; in scope, relevance, role family, AI relation, secondary families.
MARKET = [
    ("大模型评测工程师", "负责搭建大模型评测体系和评测集", "", True, "core", "evaluation_engineering", "core_ai_evaluation", []),
    ("平台开发工程师", "负责大模型评测平台开发", "", True, "adjacent", "development", "ai_product_quality", ["evaluation_engineering"]),
    ("平台开发工程师", "负责大模型评测平台开发，建设评测集", "", True, "core", "development", "core_ai_evaluation", ["evaluation_engineering"]),
    ("大模型算法工程师", "负责构建大模型评测集", "", True, "adjacent", "algorithm_research", "core_ai_evaluation", ["evaluation_engineering"]),
    ("大模型算法工程师", "负责构建大模型评测集，研究能力边界，以评测反哺数据和训练", "", True, "core", "algorithm_research", "core_ai_evaluation", ["evaluation_engineering"]),
    ("AI测试平台运营", "负责AI测试平台运营，制定评测标准", "", True, "adjacent", "operations", "ai_for_testing", []),
    ("医学领域专家", "负责制定大模型评测标准；识别真实业务场景中的安全问题", "", True, "adjacent", "domain_expert", "core_ai_evaluation", ["evaluation_engineering"]),
    ("医学领域专家", "负责制定大模型评测标准", "", True, "core", "domain_expert", "core_ai_evaluation", ["evaluation_engineering"]),
    ("大模型测试开发工程师", "负责AI产品质量保障", "", True, "core", "quality_engineering", "ai_product_quality", []),
    ("软件测试工程师", "负责利用AI提升测试效率", "", True, "core", "qa_test", "ai_for_testing", []),
    ("AI产品经理", "负责AI产品评测体系搭建", "", True, "core", "product", "ai_product_quality", ["evaluation_engineering"]),
    ("评测平台后端开发", "负责评测执行系统建设，支撑大模型", "", True, "core", "development", "core_ai_evaluation", ["evaluation_engineering"]),
    ("后端开发工程师", "负责接口开发", "", False, None, None, None, []),
    ("招聘专员", "负责大模型人才招聘", "", False, None, None, None, []),
    ("大模型评测工程师", "协助评测标准整理", "", False, None, None, None, []),
]
