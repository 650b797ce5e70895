"""Rules as data. The patterns, names and lists in this module are fixed values."""

from __future__ import annotations

# Locations.
CITY_ALIASES = {"北京": "北京", "北京市": "北京", "上海": "上海", "上海市": "上海", "杭州": "杭州", "杭州市": "杭州", "深圳": "深圳", "深圳市": "深圳", "广州": "广州", "广州市": "广州"}
PROVINCE_ALIASES = {"广东": "广东省", "广东省": "广东省"}
REGION_ALIASES = {"中国香港": "香港", "香港特别行政区": "香港", "香港": "香港"}
COUNTRY_ALIASES = {"中国": "中国"}

# Labels.
ROLE_FAMILIES = ("qa_test", "quality_engineering", "evaluation_engineering", "algorithm_research", "development", "product", "operations", "domain_expert")
NON_QA_ROLES = ("product", "development", "operations", "domain_expert")
AI_RELATIONS = ("core_ai_evaluation", "ai_product_quality", "ai_for_testing")
SENIORITY = ("regular", "senior", "expert_lead", "intern")
POOLS = ("P1", "P2", "REF", "X")
EXCLUSION_LABELS = {
    "outside_config_scope": "不在 config.yaml 启用的平台/公司范围",
    "role_product": "产品岗位，不是 QA/测试主职能",
    "role_agent_development": "Agent 开发岗位，不是 QA/测试主职能",
    "role_algorithm_or_research": "算法、模型训练或研究岗位",
    "role_general_rnd": "普通研发或平台研发岗位，不是 QA/测试主职能",
    "role_operations": "运营或运维岗位，不是 QA/测试主职能",
    "role_domain_expert": "领域专家岗位，不是 QA/测试主职能",
    "domain_hardware": "硬件、芯片、GPU、服务器或基础设施测试方向",
    "domain_game": "游戏业务方向不进入个人候选池",
    "domain_security": "安全业务方向不进入个人候选池",
    "level_expert_lead": "专家、架构师、负责人或人员管理岗位进入 REF 池",
    "level_intern": "实习岗位不进入个人候选池",
    "ai_not_primary_duty": "AI 只作为背景、偏好或弱探索，不是岗位主责",
}
#: Order in which a posting's exclusion reasons are told.
EXCLUSION_ORDER = tuple(EXCLUSION_LABELS)

# Skills, in the order of the tags.
SKILLS = (
    ("评测体系与指标设计", r"(?i)(?:评测体系|评估体系|评价体系|指标体系|评测指标|评估指标|evaluation framework|evaluation metric)"),
    ("Agent/智能体", r"(?i)(?:智能体|多智能体|(?<![A-Za-z])Agent(?:ic|s)?(?![A-Za-z]))"),
    ("Python", r"(?i)(?:(?<![A-Za-z])Python(?![A-Za-z])|PyTorch|TensorFlow)"),
    ("数据分析与处理", r"(?i)(?:数据分析|数据处理|数据挖掘|数据清洗|数据标注|数据构建|数据治理|\bPandas\b|\bNumPy\b)"),
    ("Benchmark与评测集", r"(?i)(?:\bBenchmark(?:ing|s)?\b|评测集|评估集|测评集|测试集|基准测试|黄金集|golden set)"),
    ("评测平台与自动化工具链", r"(?i)(?:自动化评测|自动化测试|评测平台|评估平台|测试平台|评测工具|评估工具|测试工具|工具链|evaluation pipeline)"),
    ("大语言模型/LLM", r"(?i)(?:大语言模型|大模型|\bLLMs?\b|语言模型)"),
    ("机器学习/深度学习", r"(?i)(?:机器学习|深度学习|\bML\b|\bPyTorch\b|\bTensorFlow\b|\bTransformer\b)"),
    ("Prompt工程", r"(?i)(?:(?<![A-Za-z])Prompt(?:ing)?(?![A-Za-z])|提示词)"),
    ("测试与质量保障", r"(?i)(?:软件测试|功能测试|性能测试|自动化测试|测试用例|质量保障|质量保证|\bQA\b|quality assurance)"),
    ("安全评测与红队", r"(?i)(?:安全评测|安全测试|模型安全|内容安全|红队|对抗测试|越狱攻击|\bRed[ -]?Team(?:ing)?\b|\bAlignment\b|对齐)"),
    ("NLP", r"(?i)(?:自然语言处理|\bNLP\b)"),
    ("多模态与计算机视觉", r"(?i)(?:多模态|计算机视觉|\bCV\b|视觉语言模型|\bVLM\b)"),
    ("RAG与检索", r"(?i)(?:\bRAG\b|检索增强|信息检索|向量检索|知识库)"),
    ("强化学习/RLHF", r"(?i)(?:强化学习|\bRLHF\b|\bRLAIF\b|奖励模型)"),
    ("SQL", r"(?i)\bSQL\b"),
)
REQUIREMENTS = (
    ("评测/测试相关经验", r"(?is)(?:评测|测评|评估|测试|质量).{0,28}(?:经验|经历|背景|能力)|(?:经验|经历|背景).{0,28}(?:评测|测评|评估|测试|质量)"),
    ("沟通协作能力", r"(?:沟通|协作|合作|跨团队|团队协同|表达能力|协调能力)"),
    ("本科及以上学历", r"(?:本科及以上|本科或以上|大学本科|本科以上|本科.?学历)"),
    ("AI/大模型相关经验", r"(?is)(?:AI|人工智能|大模型|大语言模型|LLM|Agent|智能体|机器学习|深度学习).{0,32}(?:经验|经历|背景|能力|理解|知识)|(?:经验|经历|背景).{0,32}(?:AI|人工智能|大模型|LLM|Agent|智能体)"),
    ("编程与工程能力", r"(?i)(?:编程能力|代码能力|工程能力|工程实践|开发经验|\bPython\b|\bC\+\+\b|\bJava\b)"),
    ("数据分析能力", r"(?i)(?:数据分析|数据处理|数据挖掘|数据建模|统计分析|\bSQL\b|\bPandas\b)"),
    ("计算机/数学等相关专业", r"(?:计算机|软件工程|人工智能|数学|统计学|数据科学|电子信息|自动化).{0,16}(?:专业|背景)"),
    ("产品与业务理解", r"(?:产品思维|产品能力|业务理解|业务洞察|用户需求|用户体验)"),
    ("自驱力与责任心", r"(?i)(?:自驱|主动性|责任心|ownership|主人翁|抗压)"),
    ("英语能力", r"(?i)(?:英语|英文|CET[- ]?[46]|TOEFL|IELTS)"),
    ("硕士/博士优先", r"(?:硕士|博士|研究生).{0,12}(?:优先|及以上|以上)"),
    ("论文/竞赛/开源成果", r"(?:顶会|论文|竞赛|比赛|开源项目|GitHub|学术成果)"),
    ("三年以上经验", r"(?:3|三)\s*(?:年|年以上|年及以上|年以上)"),
    ("五年以上经验", r"(?:5|五)\s*(?:年|年以上|年及以上|年以上)"),
)
EDUCATION = (
    ("博士", r"博士"),
    ("硕士及以上", r"(?:硕士|研究生).{0,8}(?:及以上|以上)"),
    ("本科及以上", r"本科.{0,8}(?:及以上|以上|或以上)"),
    ("大专及以上", r"(?:大专|专科).{0,8}(?:及以上|以上|或以上)"),
    ("学历不限", r"学历不限|不限学历"),
)
MAJORS = (
    ("计算机/软件工程", r"(?:计算机|软件工程|计算机科学|网络工程).{0,16}(?:专业|背景|相关)"),
    ("人工智能/数据科学", r"(?:人工智能|数据科学|机器学习).{0,16}(?:专业|背景|相关)"),
    ("数学/统计学", r"(?:数学|统计学|应用统计).{0,16}(?:专业|背景|相关)"),
    ("电子信息/自动化", r"(?:电子信息|电子工程|通信工程|自动化).{0,16}(?:专业|背景|相关)"),
    ("语言学/心理学/认知科学", r"(?:语言学|心理学|认知科学).{0,16}(?:专业|背景|相关)"),
)
PROJECTS = (
    ("明确要求项目经验", r"(?:项目经验|项目经历|项目实践|实际项目|完整项目)"),
    ("AI/大模型落地经验", r"(?is)(?:AI|人工智能|大模型|LLM|Agent|智能体).{0,30}(?:落地|项目).{0,16}(?:经验|经历|实践)|(?:落地|项目).{0,20}(?:AI|大模型|LLM|Agent|智能体).{0,12}(?:经验|经历|实践)"),
    ("从0到1/完整交付", r"(?i)(?:从\s*0\s*到\s*1|0\s*[-到]\s*1|端到端|完整交付)"),
    ("开源项目经历", r"(?i)(?:开源项目|GitHub).{0,20}(?:经验|经历|贡献|项目)?"),
)
EDUCATION_ALIASES = {"doctorate": "博士", "other": "其他"}
EXPERIENCE_ALIASES = {"一年以上工作经验": "1年以上", "两年以上工作经验": "2年以上", "三年以上工作经验": "3年以上", "五年以上工作经验": "5年以上"}

# Market rules, all case-insensitive.
MARKET = {
    "ai": r"(?<![A-Za-z])AI(?![A-Za-z])|AIGC|人工智能|大模型|语言模型|LLM|\bVLM\b|Agent|智能体|机器学习|MaaS",
    "owner": r"负责|主导|统筹|建立|搭建|构建|建设|设计|制定|沉淀|丰富|完善|维护|开发|研发|输出|保障|\b(?:own|lead|build|design|develop)\b",
    "weak": r"^(?:[\d\s、.\-（）()]+)?(?:参与|协助|配合|了解|熟悉|有机会|探索(?:和|并)?(?:落地)?AI辅助开发)",
    "independent": r"负责|主导|统筹|独立|设计并|设计和|设计、|设计专项|负责自动化",
    "helper": r"(?:参与|协助|配合).{0,24}(?:评测|benchmark|回归)",
    "eval": r"(?:评测|评估|评价|效果测试).{0,8}(?:体系|框架|基准|标准|指标|方案|方法|集合|数据集|系统|平台|流水线)|评测集|评测任务集|评测运行底座|评估打分|评测基线|打分标准|判分策略|能力测量|\bBenchmark\b|\bRubric\b|\bJudge\b|\bEvaluator\b|\bEval(?:uation)?\s*(?:Infra|Platform|Pipeline|Set|System)\b",
    "test_metric": r"测试质量评估|AI\s*测试(?:效果)?评[估测]",
    "eval_infra": r"评测.{0,12}(?:基础设施|Infra|执行系统|流水线)|(?:数据生产和评测|评测和数据生产).{0,12}基础设施|\bEval(?:uation)?\s*(?:Infra|Platform|Pipeline|Execution System)\b|Judge\s*(?:Infrastructure|system)",
    "quality_system": r"质量(?:保障|保证|工程|管理|评估与管理)?体系|质量平台|质量度量|质量标准与度量体系|质量门禁|自动化测试基建",
    "quality_work": r"质量保障|质量保证|业务质量|产品质量|功能测试|测试策略|测试设计|测试执行|测试方法|专项测试|测试工作|回归测试|质量风险|端到端质量|测试质量|体验和质量|测试项目|项目质量|质量专项|性能压测|功能正确性|测试技术|评测工作|质量与效能|产品评测|效果评测|评测能力|质量闭环",
    "test_method": r"(?:AI|LLM|大模型|Agent).{0,70}(?:测试提效|提升测试效率|测试效率|用例生成|测试用例|测试助手|测试平台|测试工具|测试全流程|测试能力|质量保障领域|在.{0,12}测试|运营与测试)|(?:利用|引入|借助|应用).{0,12}(?:AI|LLM|大模型).{0,35}(?:测试|质量)|测试.{0,12}(?:Agent|智能化|AI提效)|AI.{0,12}(?:辅助|驱动).{0,16}(?:质量|测试)",
    "product_object": r"(?:AI|人工智能|大模型|LLM|(?<!测试)Agent|智能体)\s*(?:(?:原生|Native|软件|等|的|相关|相关的)\s*)?(?:产品|工作台|应用|业务|助手|服务|模块|质量保障|能力及\s*SaaS\s*产品)|(?:Prompt|Agent|Chain)(?:[/、](?:Prompt|Agent|Chain))+(?:等)?相关模块|(?:业务质量|产品评测|负责.{0,12}评测能力).{0,30}(?:Agent|AIGC)|智能助手|模型服务|MaaS|大模型相关的评测工作|大模型生产平台(?:的)?(?:质量保障|测试)",
    "product_title": r"大模型|LLM|多模态测试|Agent.{0,8}(?:产品|质量)|智能助手|手机助手|MaaS|基模生产平台|AI应用|AI产品",
    "quality_title": r"测试开发|测开|测试专家|测试架构|质量工程|质量保障|质量效能|质量架构|质效|工具质量|Agent质量|可观测性工程师",
    "qa_title": r"测试工程师|软件测试|(?<![A-Za-z])QA(?![A-Za-z])|\bSDET\b|\btest engineer\b",
    "eval_title": r"评测|评估|测评|\bEvaluation\b",
    "qa_requirement": r"(?:\d|三|五).{0,16}(?:测试开发|质量工程|质量保障|软件测试).{0,12}经验",
    "eval_profession": r"独立.{0,16}评测平台.{0,12}(?:架构|实现)|评测平台核心模块|评估基础设施|评测.{0,8}研发流程",
    "model_decision": r"模型与策略选型|模型.{0,8}选型决策|模型能力边界|模型缺陷归因|评测驱动Agent|模型内在机理|能力衰减",
    "model_research": r"算法.{0,8}(?:工程师|研究员)|研究科学家|数据算法|预训练.{0,8}算法|算法研究",
}

# What decides single cases of the market rules.
MARKET_CASES = {
    "mixed_duty": r"数据生产.{0,12}训练.{0,12}评测平台.{0,12}质量",
    "mixed_platform": r"评测平台.{0,12}质量",
    "tool_search": r"探索\s*AI测试工具",
    "tool_in_use": r"落地|实现|持续使用",
    "infra_title": r"Infra|基础设施|评测平台",
    "measured_model": r"模型.{0,12}评测|模型效果测试",
    "measuring_words": r"评测|评估打分|训练数据交付验收",
    "other_products": r"客户端性能|服务端产品|传统软件|非AI业务",
    "product_title": r"产品.{0,8}(?:经理|负责人|专家)|Product Manager",
    "operations_title": r"运营",
    "expert_title": r"领域专家|行业专家|医师|医生",
    "security_research": r"安全研究",
    "security_requirement": r"逆向工程|漏洞发现|渗透测试",
    "team_duty": r"团队成员招聘|招聘和培养|制定测试团队工作目标",
    "infra_algorithm": r"基础设施.{0,8}算法",
    "backend_title": r"后台开发|后端开发|服务端开发",
    "testing_platform": r"AI测试平台",
    "model_ability": r"模型能力|Agent任务评测",
    "testing_system": r"(?:设计|开发|搭建|建设|落地|主导).{0,30}(?:测试\s*Agent|Test Agent|AI\s*测试(?:能力|评测|平台|工具))",
    "measure_words": r"打分标准|效果度量标准|评测框架|评测集",
    "ai_eval_title": r"(?:AI|模型|Agent).{0,8}评测",
    "no_eval_title": r"产品质量保障|研发效能",
    "product_research": r"策略.{0,16}训练|支撑策略与训练|模型效果.{0,16}系统性分析",
    "observability": r"可观测性",
    "eval_words": r"评测(?:方法|指标|标准|集)",
    "data_quality": r"数据.{0,20}质量|标注.{0,20}质检",
    "ability_limits": r"能力边界",
    "eval_training": r"评测.{0,12}数据.{0,12}训练",
    "real_risks": r"真实业务场景.{0,40}安全|安全风险.{0,30}安全水位",
}

# Rules of the personal pools.
FIT = {
    "qa_title": r"(?i)(?:(?<![A-Za-z])QA(?![A-Za-z])|(?<![A-Za-z])SDET(?![A-Za-z])|测试工程师|系统集成测试|软件测试|测试实习生)",
    "quality_title": r"(?i)(?:测试开发|测试专家|测试架构师|质量工程师|质量保障(?:工程师)?|质量平台|质量工具|质量负责人|质量架构师|质量效能|质效)",
    "eval_title": r"(?i)(?:评测|测评|评估)",
    "product_title": r"(?:产品.{0,8}(?:经理|负责人|专家|运营)|(?:经理|负责人).{0,8}产品)",
    "agent_title": r"(?i)(?:(?:AI\s*|质量)?Agent开发|智能体开发)",
    "algorithm_title": r"(?:算法.{0,8}(?:工程师|研究员|研究科学家)|(?:工程师|研究员).{0,8}算法|模型训练|研究科学家)",
    "rnd_title": r"(?:后台开发|后端开发|AI产品研发|数据质量研发|搜索质量算法研发|质效研发|平台研发|研发架构师|普通研发工程师)",
    "operations_title": r"(?:运营|运维工程师)",
    "domain_title": r"(?:领域专家|行业专家|医学影像科医生|临床医生|医师)",
    "lead_title": r"(?i)(?:专家|架构(?:师|工程师)|负责人|(?<![A-Za-z])Lead(?:er)?(?![A-Za-z]))",
    "senior_title": r"(?i)(?:高级|资深|(?<![A-Za-z])Senior(?![A-Za-z]))",
    "intern_title": r"(?:实习|校招实习)",
    "hardware": r"(?i)(?:SSD|AI\s*芯片|芯片|硬件|GPU|NPU|服务器|驱动|固件|编译器|加速器|加速卡|系统集成测试)",
    "game": r"(?:游戏|手游|端游|电竞)",
    "security_title": r"(?i)^(?:[\w-]+)?(?:安全评测工程师|Security(?:\s+Evaluation)?\s+Engineer)",
    "management_duty": r"(?:招聘(?:团队)?成员|团队成员招聘|培养(?:团队)?成员|团队成员培养|人才梯队(?:建设)?|团队资源分配|制定测试团队工作目标|制定团队目标|对(?:团队|组织)(?:的)?(?:交付|结果)负责|组织并管理.{0,12}团队)",
    "management_requirement": r"(?:具备|具有|要求|至少).{0,16}(?:团队管理.{0,8}梯队建设|团队管理和梯队建设|人员管理|团队资源分配)",
    "six_years": r"(?:6|六)\s*(?:年|年以上|年及以上)",
    "core_duty": r"(?i)(?:模型能力评测|Agent任务评测|模型缺陷归因|评测驱动|评测结果.{0,24}(?:模型|算法).{0,12}(?:优化|迭代)|(?:AI算法|模型|Agent).{0,16}评测(?:标准|流程|体系|指标|方法)|(?:评测标准|评测流程|评测体系|评测指标|Benchmark|评测集).{0,24}(?:AI算法|模型|Agent|智能体)|(?:构建|建设|制定|设计).{0,16}(?:Benchmark|评测集|评测标准|评测指标|评测框架))",
    "core_title": r"(?i)(?:(?:AI|算法|模型|大模型|Agent|智能体).{0,12}(?:评测|测评)|(?:评测|测评).{0,12}(?:AI|算法|模型|大模型|Agent|智能体))",
    "core_decision": r"(?:支撑模型与策略选型|影响框架演进|评测驱动Agent|模型内在机理|模型失效点|模型缺陷归因)",
    "testing_duty": r"(?is)(?:测试\s*Agent|Test\s*Agent|Agentic\s*QA|智能测试机器人|AI\s*自动化测试|用例(?:智能|自动)生成|测试用例生成|脚本生成|测试自愈|智能回归|智能(?:执行|诊断|归因)|缺陷(?:智能)?(?:诊断|归因|修复)|AI(?:赋能|驱动|辅助).{0,36}(?:测试|质量|研发效能)|(?:AI|大模型).{0,30}在(?:测试|质量保障|质量工程).{0,12}(?:领域)?(?:的)?应用|(?:AI|Agent|智能体).{0,96}(?:支撑|实现).{0,24}(?:用例生成|脚本生成|缺陷修复)|(?:AI|大模型|LLM|Agent|智能体).{0,24}(?:应用|落地|融入|用于).{0,24}(?:测试|质量保障|质量工程)|(?:测试|质量保障|质量工程).{0,24}(?:应用|落地|引入|使用).{0,20}(?:AI|大模型|LLM|Agent|智能体)|(?:提升测试效率|测试提效|提效提质).{0,24}(?:AI|大模型|Agent)|(?:AI|大模型|Agent).{0,24}(?:提升测试效率|测试提效|提效提质)|从[“\"]?自动化.{0,16}智能化|AI测试工具|AI自动化测试)",
    "testing_strong": r"(?is)(?:(?:设计|搭建|构建|开发|落地|实现|建设|推动).{0,20}(?:测试\s*Agent|Test\s*Agent|Agentic\s*QA|智能测试)|(?:测试\s*Agent|Test\s*Agent|Agentic\s*QA|智能测试).{0,20}(?:设计|搭建|构建|开发|落地|实现|建设|推动)|测试用例(?:的)?(?:自动|智能)?生成|用例自动生成|用例与脚本生成|AI\s*Agent.{0,96}(?:用例生成|缺陷修复)|测试自愈|探索并(?:实践|落地).{0,28}(?:AI|大模型|Agent).{0,28}(?:测试|质量保障|质量工程))",
    "product_duty": r"(?is)(?:(?:负责|保障|开展|覆盖|面向|结合).{0,28}(?:AI\s*(?:产品|应用|工作台)|大模型产品|大模型业务|模型服务|基础模型生产平台|基模生产平台|大模型生产平台|Agent\s*(?:产品|服务|平台|运行链路)|智能助手|MaaS|AIGC).{0,72}(?:测试|质量保障|质量体系|质量|稳定性|可靠性|验收|验证)|(?:AI\s*(?:产品|应用|工作台)|大模型产品|大模型业务|模型服务|基础模型生产平台|基模生产平台|大模型生产平台|Agent\s*(?:产品|服务|平台|运行链路)|智能助手|MaaS|AIGC).{0,20}(?:全链路|端到端).{0,20}(?:测试|质量|保障|验证)|(?:AIGC|大模型|Agent|智能体|算法).{0,28}(?:效果评测|评测工作|评测能力建设|自动化评估)|(?:大模型|模型|Agent)\s*(?:服务|产品|平台).{0,28}(?:质量保障|质量体系|稳定性|可靠性|测试)|(?:小程序Agent|Agent\s*服务).{0,120}(?:测试|质量保障|质量体系|稳定性|可靠性|验证|功能正确性|高可用性|性能压测|系统稳定)|(?:AI产品业务特点|AI质量体系|大模型相关质量体系|Prompt/Agent/Chain).{0,64}(?:测试|质量|评测|稳定性)|基于AIGC技术.{0,28}(?:质量保证体系|优化测试过程)|产品评测.{0,48}(?:评测标准|评测Agent|评测数据集)|大模型应用效果.{0,24}(?:性能|稳定性|质量))",
    "product_words": r"(?i)(?:MaaS|基模生产平台|AI\s*(?:产品|应用|助手)|智能助手|大模型方向|大模型测试|多模态测试|Agent稳定性测试|Agent测试工程师)",
    "product_primary": r"(?i)(?:MaaS|基模生产平台|AI方向|AI效能与质量保障|AI测试架构师|大模型测试开发|大模型方向|AI\s*软件测试|AI智能化方向)",
    "context": r"(?i)(?:AI|AIGC|大模型|LLM|Agent|智能体|机器学习|深度学习)",
    "research_hard": r"(?is)(?:算法研究员|研究科学家|模型结构.{0,24}训练过程|深度参与.{0,20}(?:预训练|SFT|RLHF)|基模.{0,20}(?:评测和优化|设计评测和优化)|(?:扎实的研究|论文经验).{0,20}(?:机器学习|多模态|评测)|(?:机器学习|多模态|评测).{0,20}(?:扎实的研究|论文经验))",
    "primary_quality_duty": r"(?:测试|质量保障|质量体系|质量闭环|评测|验收|稳定性)",
    "ordinary_quality_duty": r"(?:测试|质量保障|质量体系|质量闭环|验收|稳定性)",
}

# Narrow evidence of an occupation.
EVIDENCE = {
    "product_years": r"(?:\d+|[一二三四五六七八九十]+)\s*年(?:以上)?(?:的)?(?:互联网|AI|平台)?产品(?:工作|管理)?经验",
    "preferred": r"优先|加分",
    "research": r"用户调研|市场研究",
    "planning": r"(?:负责|主导|规划|制定).{0,24}(?:产品规划|产品路线|产品交付|规划方向|方向)",
    "qa_owner": r"(?:负责|主导).{0,24}(?:质量保障|测试开发|测试执行|自动化测试)",
    "security_duty": r"负责|主导|开展|独立完成",
    "security_no_duty": r"协助|配合|无需|不负责|不涉及",
    "security_business": r"(?:负责|主导)(?:[^，,：:]{0,12})?安全(?:系统|产品|业务)(?:的)?(?:测试|质量保障)|(?:负责|主导)[^，,]{0,16}安全能力评测",
}
SECURITY_TECHNIQUES = (r"漏洞挖掘", r"渗透测试", r"漏洞分析|沙箱逃逸")

# A workplace named in location or title.
CITY_PATTERN = "|".join(sorted(CITY_ALIASES, key=len, reverse=True))
WORKPLACE = r"深圳(?:市)?"
WORKPLACE_NEGATED = r"(?:非|不在|不含|不包括|不包含|不招|不考虑|排除|除)\s*深圳(?:市)?|深圳(?:市)?\s*(?:除外|以外|不招聘|不招人|不招|无岗位|没有岗位|无名额|不设岗位|不提供岗位)"
WORKPLACE_OTHER_SENSE = r"深圳(?:市)?(?:大学|客户|市场|业务)"

# Latin-script rules for texts without CJK characters.
LATIN_TAGS = (
    ("email", r"[a-z0-9._]+@[a-z0-9.]+"),
    ("phone", r"[0-9]{3}-[0-9]{4}"),
    ("license", r"license"),
    ("secret", r"token = "),
    ("that", r"(^|[^A-Za-z])that([^A-Za-z]|$)"),
    ("with", r"(^|[^A-Za-z])with([^A-Za-z]|$)"),
)
