"""Word lists and patterns of the role classifier."""

# Fixed values, which must equal those that the inventory has always been classified by.
SENIOR_TERMS = (
    "senior",
    "sr",
    "staff",
    "principal",
    "lead",
)
BACKEND_ROLE_TERMS = (
    "backend",
    "back end",
    "back-end",
    "api",
    "apis",
    "server",
    "server-side",
    "platform",
    "infrastructure",
    "infra",
    "distributed",
    "cloud",
    "database",
    "data platform",
    "data infrastructure",
    "etl",
    "pipeline",
    "pipelines",
    "integration",
    "integrations",
    "devops",
    "site reliability",
    "sre",
    "python",
    "node",
    "fastapi",
)
SOFTWARE_ROLE_TERMS = (
    "software engineer",
    "software engineering",
    "software developer",
    "sde",
    "swe",
)
FULL_STACK_TERMS = (
    "full stack",
    "full-stack",
    "fullstack",
)
FOUNDING_TERMS = (
    "founding engineer",
    "founding software engineer",
)
FRONTEND_ONLY_TITLE_TERMS = (
    "frontend",
    "front end",
    "front-end",
    "ui engineer",
    "react engineer",
    "react developer",
    "ui developer",
    "web developer",
    "design engineer",
)
AI_ENGINEERING_TITLE_PATTERNS = (
    r"\b(?:ai|artificial intelligence|applied ai|generative ai|genai|llm|machine learning|ml|mlops)\b.{0,40}\b(?:developer|engineer)\b",
    r"\b(?:developer|engineer)\b.{0,40}\b(?:ai|artificial intelligence|applied ai|generative ai|genai|llm|machine learning|ml|mlops)\b",
)
EXCLUDED_ROLE_TERMS = (
    "designer",
    "product designer",
    "sales",
    "account executive",
    "customer success",
    "support",
    "intern",
    "internship",
    "apprentice",
    "chief of staff",
    "product manager",
    "program manager",
    "project manager",
    "finance",
    "counsel",
    "legal",
    "recruiter",
    "recruiting",
    "talent acquisition",
    "human resources",
    "people partner",
    "account manager",
    "freelance",
)
ENGINEERING_DOMAIN_MODIFIER_TERMS = (
    "marketing",
    "growth",
    "operations",
    "partnerships",
)
EXCLUDED_ENGINEERING_TITLE_TERMS = (
    "sales engineer",
    "solutions engineer",
    "solution engineer",
    "support engineer",
    "customer engineer",
    "field engineer",
    "qa engineer",
    "quality engineer",
    "test engineer",
    "engineering manager",
    "manager, engineering",
    "director of engineering",
    "director of software engineering",
    "director, engineering",
    "engineering director",
    "director, software engineering",
    "director software engineering",
    "head of engineering",
    "vp of engineering",
    "vice president of engineering",
    "developer advocate",
    "developer relations",
    "community engineer",
    "software engineer in test",
    "software development engineer in test",
    "sde manager",
    "manager, sde",
    "sdet",
)
ENGINEERING_TITLE_TERMS = (
    "engineer",
    "developer",
    "architect",
    "site reliability",
    "sre",
    "devops",
    "member of technical staff",
    "sde",
)
RESEARCH_ONLY_TERMS = (
    "research scientist",
    "ml researcher",
    "ai researcher",
    "machine learning researcher",
)
DATA_ANALYST_TERMS = (
    "data analyst",
    "business analyst",
    "analytics analyst",
)
JUNIOR_TITLE_PATTERNS = (
    r"\b(?:junior|jr\.?)\b",
    r"\bentry[- ]level\b",
    r"\b(?:new|recent)[- ]grad(?:uate)?\b",
    r"\bgraduate\s+(?:backend|full[- ]stack|platform|software|systems?)\s+(?:developer|engineer)\b",
    r"\b(?:developer|engineer)\s*(?:[-–—,/:()]\s*)graduate\b",
)
QUALITY_ENGINEERING_TITLE_PATTERNS = (
    r"\b(?:software (?:development )?engineer|software developer)\b.{0,40}\b(?:qa|quality(?: assurance)?|test(?: automation|ing)?)\b",
    r"\b(?:qa|quality(?: assurance)?|test(?: automation|ing)?)\b.{0,40}\b(?:software engineer|software developer)\b",
)
ENGINEERING_LEADERSHIP_TITLE_PATTERNS = (
    r"\b(?:avp|evp|svp|vp|vice president)\b.{0,80}\b(?:backend|engineering|engineer|infrastructure|platform|software|technology)\b",
    r"\b(?:backend|engineering|engineer|infrastructure|platform|software|technology)\b.{0,80}\b(?:avp|evp|svp|vp|vice president)\b",
    r"\b(?:senior|sr\.?)\s+(?:director|head|manager)\b.{0,60}\b(?:backend|engineering|infrastructure|platform|software)\b",
    r"\b(?:director|head|manager)\b.{0,40}\b(?:backend|infrastructure|platform|software)\s+engineering\b",
    r"\b(?:backend|infrastructure|platform|software)\s+engineering\b.{0,40}\b(?:director|head|manager)\b",
    r"\b(?:senior|sr\.?)\s+(?:backend|infrastructure|platform|software)\s+(?:director|head|manager)\b",
    r"\bhead\s+of\s+(?:backend|infrastructure|platform|software)(?:\s+engineering)?\b",
    r"\b(?:engineer|engineering)\s+team\s+lead\b",
    r"\b(?:director|head|manager)\b.{0,40}\b(?:ai|backend|data|front[ -]?end|full[ -]?stack|infrastructure|machine learning|platform|software)\s+(?:engineer|engineering)\b",
)
BUSINESS_DEVELOPMENT_TITLE_PATTERNS = (
    r"^\s*(?:(?:founding|global|lead|principal|regional|senior|sr\.?|strategic|technical)\s+)*business development\b.{0,60}\b(?:developer|engineer(?:ing)?|technical)\b",
    r"\bbusiness development\s+(?:associate|director|engineer|executive|lead|manager|representative|specialist)\b",
    r"\b(?:director|head|lead|manager|vice president|vp)\s+(?:of\s+)?business development\b",
    r"\bbusiness developer\b",
)
PHYSICAL_ENGINEERING_TITLE_PATTERNS = (
    r"\b(?:mechanical|stress|structural)\s+(?:(?:analysis|design|systems?)\s+)?engineer(?:ing)?\b",
    r"\bengineer(?:ing)?\s*(?:[-–—,/:(]\s*|\s+)(?:mechanical|stress|structural)\b",
    r"\bscada\b.{0,40}\bengineer(?:ing)?\b",
    r"\bengineer(?:ing)?\b.{0,24}\bscada\b",
    r"\b(?:project\s+)?commissioning\s+engineer(?:ing)?\b",
    r"\bdrilling\s+engineer(?:ing)?\b",
    r"\bplm\b.{0,32}\bengineer(?:ing)?\b",
    r"\bradar\s+systems?\s+engineer(?:ing)?\b",
    r"\bfpga\b.{0,48}\b(?:verification\s+)?engineer(?:ing)?\b",
    r"\bmission\s+architect\b",
    r"\bconverged\s+packet\s+optical\b",
)
DESIGN_PROCESS_TITLE_PATTERNS = (
    r"\bdesign\s*(?:&|and)\s*engineering\s+process\s+lead\b",
)
PHYSICAL_IT_IMPLEMENTATION_TITLE_PATTERNS = (
    r"\bsystems?\s+engineer\s+(?:i{1,3}|l{2}|[123])\b",
)
PHYSICAL_IT_CABLING_CONTEXT_PATTERNS = (
    r"\b(?:cable\s+management|cabling)\b",
)
PHYSICAL_IT_EQUIPMENT_CONTEXT_PATTERNS = (
    r"\bphysical\s+(?:setup|installation)\b.{0,120}\b(?:access\s+points?|firewalls?|sans?|servers?|switches?)\b",
    r"\b(?:access\s+points?|firewalls?|sans?|servers?|switches?)\b.{0,120}\bphysical\s+(?:setup|installation)\b",
)
NON_OPENING_CONTEXT_PATTERNS = (
    r"\bjoin\s+(?:our|the)\s+(?:contractor|freelance)\s+(?:pool|network)\b",
    r"\b(?:contractor|freelance)\s+network\b.{0,240}\bproject\s+invitations?\b",
    r"\bproject\s+invitations?\b.{0,160}\bwhen\s+they\s+arise\b",
    r"\bnot\s+(?:a|an|the)\s+(?:job|opening|position|role)\s+(?:that\s+)?we(?:'re|\s+are)?\s+currently\s+hiring\s+for\b",
    r"\bwe(?:'re|\s+are)\s+not\s+currently\s+hiring\s+for\s+(?:a|the|this)\s+(?:job|opening|position|role)\b",
    r"\baccepting\s+(?:applications?|resumes?)\s+for\s+(?:a\s+)?(?:potential\s+)?future\s+(?:job|opening|opportunit(?:y|ies)|position|role)\b",
)
