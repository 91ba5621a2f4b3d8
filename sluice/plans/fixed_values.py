"""Lists and lookup tables that results depend on.

Every constant here must keep its exact spelling and order. They are rule *data*; the
operators take them as parameters, so another rule set is another table, not other code.
"""

# Entity types and their scores, in detection order.
DETECTOR_SCORES = {
    "SSN": 0.99,
    "ROUTING": 0.98,
    "PASSPORT": 0.97,
    "MRN": 0.99,
    "PHI_HINT": 0.9,
}
SSN_WORD_SCORE = 0.9
ALT_DETECTOR_SCORES = {"SSN": 0.99, "MRN": 0.95, "ADDRESS": 0.9}
MRN_VALUE = "unknown"
PHI_HINT_VALUE = "medical_context"
SSN_WORD_VALUE = "SSN"

# Prompt-injection phrases.
INJECTION_PHRASES = [
    "ignore previous instructions",
    "override system",
    "jailbreak",
    "forget rules",
    "act as",
]

# Entity types behind the two sensitive text labels.
PHI_TYPES = ["MRN", "PHI_HINT"]
PII_TYPES = ["SSN", "ROUTING", "ACCOUNT", "PII_HINT"]

# The three prompt hops, in order.
PROMPT_HOPS = [
    ("user", "dlp_gateway"),
    ("dlp_gateway", "rag_orchestrator"),
    ("rag_orchestrator", "pinecone"),
]

# The default flow rules (id, from, to, allowed, conditions).
NOT_RESTRICTED = "classification_label not_in [RESTRICTED_PII, RESTRICTED_PHI]"
ALLOW_OR_MASK = "policy_decision.action in [allow,mask]"
DEFAULT_FLOWS = [
    ("user_to_gateway_internal", "user", "dlp_gateway", True, [NOT_RESTRICTED, ALLOW_OR_MASK]),
    ("gateway_to_rag_internal", "dlp_gateway", "rag_orchestrator", True, [NOT_RESTRICTED, ALLOW_OR_MASK]),
    ("rag_to_pinecone_internal", "rag_orchestrator", "pinecone", True, [NOT_RESTRICTED, ALLOW_OR_MASK]),
]

# Reason texts of moves that no flow decides.
POLICY_MISSING = "policy files missing: flows.json not found"
POLICY_UNREADABLE = "failed to load flows.json: not JSON"
POLICY_NO_LIST = "invalid flows.json structure: 'flows' must be a list"
REASON_NO_FLOW = "no matching flow definition in policy"
REASON_NO_POLICY = "policy files missing: flows.json not found"

# The full flow set (id, from, to, allowed, conditions or None, requires).
FULL_FLOWS = [
    ("FLOW-INGRESS-001", "user", "dlp_gateway", True, None, ["classification", "policy_eval"]),
    ("FLOW-INGRESS-002", "dlp_gateway", "rag_orchestrator", True,
     ["classification_label not_in [RESTRICTED_PHI]", "policy_decision.action in [allow, mask]"], []),
    ("FLOW-INGRESS-003", "rag_orchestrator", "pinecone", True,
     ["classification_label not_in [RESTRICTED_PHI, RESTRICTED_PII]", "redaction_applied == true"], []),
    ("FLOW-INGRESS-004", "rag_orchestrator", "llm", True,
     ["classification_label not_in [RESTRICTED_PHI, RESTRICTED_PII]",
      "policy_decision.action in [allow, mask]"], []),
    ("FLOW-EGRESS-001", "llm", "dlp_gateway", True, None, ["outbound_scan", "classification", "policy_eval"]),
    ("FLOW-EGRESS-002", "dlp_gateway", "user", True, ["policy_decision.action in [allow, mask]"], []),
    ("FLOW-EVIDENCE-001", "dlp_gateway", "evidence_s3", True, None, ["kms_encryption", "immutable_logging"]),
]

# Runtime risk of entity types, and roles that may see them raw.
PII_RISK = {
    "SSN": "high",
    "PASSPORT": "high",
    "DRIVERS_LICENSE": "high",
    "CREDIT_CARD": "high",
    "DOB": "medium",
    "PHONE_NUMBER": "medium",
    "EMAIL_ADDRESS": "medium",
    "ADDRESS": "medium",
    "IP_ADDRESS": "low",
}
ROLES_ALLOW_HIGH = ["admin"]
ROLES_ALLOW_MEDIUM = ["admin", "professional"]

# Taxonomies (ruleset -> entity type -> label), label priority and handling.
POLICY_TAXONOMY = {
    "MRN": "PHI", "MEDICAL_RECORD": "PHI", "ICD10": "PHI",
    "HEALTH_PLAN_BENEFICIARY": "PHI", "PRESCRIPTION": "PHI",
    "SSN": "RESTRICTED_PII", "DL": "RESTRICTED_PII", "PASSPORT": "RESTRICTED_PII",
    "BANK_ACCOUNT": "RESTRICTED_PII", "CREDIT_CARD": "RESTRICTED_PII",
    "EMAIL": "CONFIDENTIAL_PII", "PHONE_NUMBER": "CONFIDENTIAL_PII",
    "ADDRESS": "CONFIDENTIAL_PII", "DOB": "CONFIDENTIAL_PII",
}
POLICY_PRIORITY = ["PHI", "RESTRICTED_PII", "CONFIDENTIAL_PII", "INTERNAL"]
LEGACY_TAXONOMY = {"SSN": "RESTRICTED_PII", "MRN": "PHI", "ADDRESS": "MODERATE_PII"}
LEGACY_PRIORITY = ["PHI", "RESTRICTED_PII", "MODERATE_PII", "INTERNAL"]
CATALOG_TAXONOMY = {
    "MRN": "RESTRICTED_PHI", "ICD10_CODE": "RESTRICTED_PHI", "MEDICATION": "RESTRICTED_PHI",
    "SSN": "RESTRICTED_PII", "PASSPORT": "RESTRICTED_PII", "DRIVERS_LICENSE": "RESTRICTED_PII",
    "CREDIT_CARD": "RESTRICTED_PII", "DOB": "RESTRICTED_PII", "PHONE_NUMBER": "RESTRICTED_PII",
    "EMAIL_ADDRESS": "RESTRICTED_PII", "IP_ADDRESS": "CONFIDENTIAL", "ADDRESS": "RESTRICTED_PII",
}
CATALOG_PRIORITY = ["RESTRICTED_PHI", "RESTRICTED_PII", "CONFIDENTIAL", "INTERNAL", "PUBLIC"]
CATALOG_NO_ENTITIES = "INTERNAL"
CATALOG_FALLBACK = "PUBLIC"
CATALOG_HANDLING = {
    "PUBLIC": ["allow"],
    "INTERNAL": ["allow", "log"],
    "CONFIDENTIAL": ["mask", "log"],
    "RESTRICTED_PII": ["mask", "log", "evidence"],
    "RESTRICTED_PHI": ["block", "log", "evidence"],
}

# Fields that logs and evidence records must carry.
LOG_FIELDS = ["timestamp", "user", "action", "decision", "classification"]
EVIDENCE_FIELDS = ["opa_decision", "classification", "raw_prompt"]

# Violation messages of the rule packs.
MSG_SSN_INPUT = "Restricted PII detected — SSN not allowed in prompts."
MSG_MRN_INPUT = "PHI detected — blocking inference."
MSG_INJECTION = "Prompt injection attempt detected: "
MSG_OUTPUT_LEAK = "Sensitive data leaked in LLM output"
MSG_DIAGNOSIS = "Unapproved medical diagnosis"
MSG_AGENT = "Unauthorized agentic action"
MSG_FLOW = "Unapproved data flow detected"
MSG_TOKEN = "Unknown classification token"
MSG_EVIDENCE = "Missing evidence field"
MSG_SOURCE = "Untrusted data source"

# Answers of the gateway.
ANSWER_BLOCKED = "Response blocked by DLP policy."
ANSWER_MASK_PREFIX = "[PII REDACTED] "
ERROR_BLOCKED = "Prompt blocked by DLP policy."
ERROR_NO_PROMPT = "Missing 'prompt' in request body"

# Environment variables a gateway function must declare.
REQUIRED_ENV = ["OPA_POLICY_PATH", "FLOWS_JSON_PATH"]

# Policy -> control links (policy id, package, rule, control ids).
POLICY_CONTROL_LINKS = [
    ("OPA-DLP-RUNTIME-DECISION", "dlp.runtime", "decision",
     ["ISO27001-A.9.1.1", "ISO27001-A.9.2.3", "ISO27001-A.18.1.3", "ISO42001-6.3.2", "OWASP-LLM-01"]),
    ("OPA-DLP-DATA-MOVEMENT", "data.movement", "allow",
     ["ISO27001-A.13.2.1", "ISO27001-A.13.2.3", "ISO42001-8.4.3", "OWASP-LLM-08"]),
    ("OPA-TF-ISO27001-ACCESS", "terraform.controls.iso27001_access", "deny",
     ["ISO27001-A.9.1.1", "ISO27001-A.9.2.1"]),
    ("OPA-TF-ISO27001-CHANGE-SUPPLIER", "terraform.controls.iso27001_change_supplier", "deny",
     ["ISO27001-A.15.1.1", "ISO27001-A.15.2.1"]),
    ("OPA-TF-ISO27001-CRYPTO-LOGGING", "terraform.controls.iso27001_crypto_logging", "deny",
     ["ISO27001-A.10.1.1", "ISO27001-A.12.4.1"]),
    ("OPA-TF-ISO42001-AI-RISK-DATA", "terraform.controls.iso42001_ai_risk_data", "deny",
     ["ISO42001-6.3.2", "ISO42001-8.2.3"]),
    ("OPA-TF-GENERAL-GUARDRAILS", "terraform_guardrails", "deny",
     ["ISO27001-A.6.1.5", "ISO27001-A.12.1.2", "ISO42001-5.3.1"]),
]

# Scanner check -> control links (check id, control ids).
CHECK_CONTROL_LINKS = [
    ("CKV_AWS_252", ["ISO27001-A.12.4.1", "ISO27001-A.16.1.2"]),
    ("CKV2_AWS_10", ["ISO27001-A.12.4.1", "ISO27001-A.12.4.3"]),
    ("CKV2_AWS_64", ["ISO27001-A.10.1.1", "ISO27001-A.9.1.2"]),
    ("CKV2_AWS_62", ["ISO27001-A.12.4.1", "ISO27001-A.16.1.1"]),
    ("CKV2_AWS_6", ["ISO27001-A.9.4.1", "ISO27001-A.13.1.1"]),
    ("CKV2_AWS_61", ["ISO27001-A.18.1.3", "ISO27001-A.11.2.7"]),
    ("CKV_AWS_18", ["ISO27001-A.12.4.1", "ISO27001-A.15.1.3"]),
    ("CKV_AWS_144", ["ISO27001-A.17.1.2", "ISO27001-A.17.2.1"]),
]

# Plan check -> framework entry (check id, framework, control or threat, name).
CHECK_FRAMEWORKS = [
    ("CKV_DLP_001", "ISO27001", "A.8.24", "Information security in use of cloud services"),
    ("CKV_DLP_002", "ISO27001", "A.8.13", "Information backup"),
    ("CKV_DLP_003", "ISO27001", "A.8.20", "Network security"),
    ("CKV_DLP_004", "ISO27001", "A.5.15", "Access control"),
    ("CKV_DLP_005", "ISO27001", "A.8.21", "Security of network services"),
    ("CKV_DLP_006", "ISO27001", "A.5.1", "Policies for information security"),
    ("CKV_DLP_001", "ISO42001", "8.5", "AI system security & data protection"),
    ("CKV_DLP_004", "ISO42001", "8.6", "AI system monitoring & safeguards"),
    ("CKV_DLP_006", "ISO42001", "6.2", "Documented controls for AI risk treatment"),
    ("CKV_DLP_001", "OWASP_LLM_TOP10", "LLM06:2025", "Sensitive Information Disclosure"),
    ("CKV_DLP_004", "OWASP_LLM_TOP10", "LLM01:2025", "Prompt Injection"),
    ("CKV_DLP_005", "OWASP_LLM_TOP10", "LLM02:2025", "Insecure Output Handling"),
    ("CKV_DLP_006", "OWASP_LLM_TOP10", "LLM07:2025", "System Prompt Leakage"),
    ("CKV_DLP_002", "OWASP_LLM_TOP10", "LLM08:2025", "Vector and Embedding Weaknesses"),
]

# Evidence keys of a control record, of which one must be filled.
EVIDENCE_KEYS = ["opa_policy", "checkov_check", "terraform_guardrail", "test_case"]
TOOL_KEYS = ["opa_policies", "checkov_checks", "evidence_sources"]
REASON_NO_EVIDENCE = "no evidence mapping"
REASON_EMPTY_EVIDENCE = "evidence fields empty"
