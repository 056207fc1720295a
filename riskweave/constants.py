"""Fixed values that results depend on: weights, vocabularies and labels."""

DIMENSIONS = ("security_posture", "operational_maturity", "service_reliability", "governance")

# Starting weight of each score dimension.
DEFAULT_WEIGHTS = {
    "security_posture": 0.40,
    "operational_maturity": 0.25,
    "service_reliability": 0.20,
    "governance": 0.15,
}

# Weight change per regulatory framework, in DIMENSIONS order.
FRAMEWORK_DELTAS = {
    "FedRAMP": (0.10, -0.08, -0.07, 0.05),
    "GDPR": (0.02, -0.05, -0.05, 0.08),
    "HIPAA": (0.05, -0.07, -0.05, 0.07),
    "ISO27001": (0.03, -0.05, -0.03, 0.05),
    "PCI-DSS": (0.08, -0.06, -0.06, 0.04),
    "SOC2": (-0.05, 0.02, -0.02, 0.05),
}

# Lower-case phrases that show a framework in a text.
FRAMEWORK_SYNONYMS = {
    "FedRAMP": ("fedramp", "federal risk"),
    "GDPR": ("gdpr", "general data protection"),
    "HIPAA": ("hipaa", "health insurance portability"),
    "ISO27001": ("iso 27001", "iso27001", "iso/iec 27001"),
    "PCI-DSS": ("pci dss", "pci-dss", "payment card industry"),
    "SOC2": ("soc 2", "soc2", "service organization"),
}

# Discount rate of each compensating control.
CONTROL_RATES = {
    "data_encryption_at_rest": 0.02,
    "endpoint_detection": 0.03,
    "incident_response_plan": 0.02,
    "mfa_enforced": 0.05,
    "network_segmentation": 0.03,
    "vulnerability_scanning": 0.03,
    "waf_deployed": 0.04,
}

CONFIDENCE_PENALTY = 0.75
HALF_LIFE_DAYS = 365
MIN_CVES_FULL = 3
LOOKBACK_DAYS = 180
WINDOW_DAYS = 119
MAX_CHUNK_CHARS = 2048

# Severity ordinals of the policy score; any other word is 0.1.
SEVERITY_ORDINALS = {"CRITICAL": 1.0, "HIGH": 0.75, "MEDIUM": 0.5, "LOW": 0.25}
OTHER_SEVERITY_ORDINAL = 0.1

# Incident severities that count as major.
MAJOR_SEVERITIES = ("critical", "high", "major", "p1", "sev1", "sev2")

# Incident severity scores of the model aggregate; any other word is 0.
INCIDENT_SEVERITY_SCORES = {"critical": 4, "high": 3, "medium": 2, "low": 1}

# Severity vocabulary per feed; any other word is NONE.
SEVERITY_WORDS = {
    "nvd": {"CRITICAL": "CRITICAL", "HIGH": "HIGH", "MEDIUM": "MEDIUM", "LOW": "LOW", "NONE": "NONE"},
    "osv": {"CRITICAL": "CRITICAL", "HIGH": "HIGH", "MEDIUM": "MEDIUM", "LOW": "LOW", "NONE": "NONE"},
    "ghsa": {"CRITICAL": "CRITICAL", "HIGH": "HIGH", "LOW": "LOW", "MODERATE": "MEDIUM", "UNKNOWN": "NONE"},
}

# Package ecosystem names.
ECOSYSTEM_NAMES = {
    "cargo": "Cargo",
    "composer": "Composer",
    "go": "Go",
    "maven": "Maven",
    "npm": "npm",
    "nuget": "NuGet",
    "pip": "PyPI",
    "pypi": "PyPI",
    "rubygems": "RubyGems",
    "rust": "Cargo",
}

# Documentation-quality words.
DOC_QUALITY_TERMS = (
    "alert", "audit", "authentication", "authorization", "breach", "certificate", "credential",
    "cve", "cvss", "encryption", "incident", "log", "monitor", "password", "patch", "secret",
    "ssl", "tls", "token", "update", "vulnerability",
)

# Security-guidance words.
GUIDANCE_TERMS = (
    "access control", "compliance", "dast", "ddos", "firewall", "gdpr", "hardening", "hipaa",
    "intrusion", "iso 27001", "least privilege", "mfa", "multi-factor", "pci",
    "penetration test", "pentest", "sast", "security", "soc 2", "waf", "zero trust",
)

# Line patterns dropped from pages (case-insensitive).
DOCS_BOILERPLATE = (
    "all rights reserved", "cookie", r"copyright \d{4}", "create account", "privacy policy",
    "sign in", "subscribe to newsletter", "terms of service",
)
TRUST_BOILERPLATE = (
    "all rights reserved", "cookie", r"copyright \d{4}", "create account", "privacy policy",
    "sign in", "terms of service",
)

# Patterns of which a trust page must match one (case-insensitive).
COMPLIANCE_PATTERNS = (
    "attestation", "audit report", "CCPA", "certif", "compliance", "CSA STAR", "FedRAMP", "GDPR",
    "HIPAA", "ISO 27001", "ISO 27017", "ISO 27018", "NIST", "PCI DSS", "PCI-DSS", "SOC 2", "SOC2",
    "third.party audit",
)

# Framework tags of a trust page, in tag order (case-insensitive).
FRAMEWORK_TAG_PATTERNS = {
    "SOC 2": r"SOC\s*2|SOC-2",
    "ISO 27001": r"ISO\s*27001",
    "ISO 27017": r"ISO\s*27017",
    "ISO 27018": r"ISO\s*27018",
    "GDPR": r"GDPR|General Data Protection",
    "HIPAA": r"HIPAA",
    "PCI-DSS": r"PCI[\s-]DSS|Payment Card Industry",
    "FedRAMP": r"FedRAMP",
    "CCPA": r"CCPA|California Consumer Privacy",
    "NIST": r"NIST",
}

# Default thresholds of the high-risk label and of the bands.
HIGH_RISK_THRESHOLDS = {"cvss_min": 7.0, "kev_min": 1, "epss_min": 0.1, "incident_min": 3}
BAND_LOW, BAND_HIGH = 0.40, 0.70

RISK_CATEGORIES = (
    "vulnerability_severity", "vulnerability_volume", "active_exploitation",
    "incident_history", "repository_health", "cwe_attack_types",
)

# Category of each model feature; CWE columns fall to cwe_attack_types.
FEATURE_CATEGORIES = {
    "vulnerability_volume": ("open_vulns", "total_vulns", "vuln_density"),
    "incident_history": ("avg_severity", "recurrence_rate", "total_downtime"),
    "repository_health": (
        "commit_count_90d", "contributor_count_90d", "open_issues", "security_issues_open",
        "mean_days_close_security", "days_since_last_release", "has_security_policy", "patch_debt",
    ),
}
METADATA_FEATURES = ("vendor_enc", "ecosystem_enc", "is_oss_enc", "is_saas_enc")

# Features that define the label and so stay out of training.
LEAKING_FEATURES = (
    "mean_cvss", "max_cvss", "exploit_count", "mean_epss", "incident_count",
    "epss_risk", "exploit_ratio", "risk_velocity",
)

# Model input columns before the CWE columns.
MODEL_FEATURES = (
    "total_vulns", "open_vulns", "vuln_density",
    "commit_count_90d", "contributor_count_90d", "open_issues",
    "security_issues_open", "mean_days_close_security",
    "days_since_last_release", "has_security_policy", "patch_debt",
    "avg_severity", "recurrence_rate", "total_downtime",
    "vendor_enc", "ecosystem_enc", "is_oss_enc", "is_saas_enc",
)

# Weakness names.
CWE_LABELS = {
    "CWE-20": "Improper Input Validation",
    "CWE-22": "Path Traversal",
    "CWE-74": "Injection",
    "CWE-78": "OS Command Injection",
    "CWE-79": "Cross-Site Scripting (XSS)",
    "CWE-89": "SQL Injection",
    "CWE-90": "LDAP Injection",
    "CWE-94": "Code Injection",
    "CWE-119": "Buffer Overflow",
    "CWE-125": "Out-of-Bounds Read",
    "CWE-190": "Integer Overflow",
    "CWE-200": "Information Exposure",
    "CWE-269": "Improper Privilege Management",
    "CWE-276": "Incorrect Default Permissions",
    "CWE-287": "Authentication Bypass",
    "CWE-295": "Improper Certificate Validation",
    "CWE-306": "Missing Authentication",
    "CWE-310": "Cryptographic Issues",
    "CWE-319": "Cleartext Transmission",
    "CWE-326": "Inadequate Encryption Strength",
    "CWE-327": "Use of Broken Algorithm",
    "CWE-330": "Insufficient Random Values",
    "CWE-338": "Weak PRNG",
    "CWE-352": "Cross-Site Request Forgery (CSRF)",
    "CWE-362": "Race Condition",
    "CWE-369": "Divide by Zero",
    "CWE-400": "Uncontrolled Resource Consumption",
    "CWE-416": "Use After Free",
    "CWE-434": "Unrestricted File Upload",
    "CWE-476": "Null Pointer Dereference",
    "CWE-502": "Deserialization of Untrusted Data",
    "CWE-601": "Open Redirect",
    "CWE-611": "XML External Entity (XXE)",
    "CWE-639": "Insecure Direct Object Reference",
    "CWE-787": "Out-of-Bounds Write",
    "CWE-798": "Hard-coded Credentials",
    "CWE-862": "Missing Authorization",
    "CWE-863": "Incorrect Authorization",
    "CWE-918": "Server-Side Request Forgery (SSRF)",
    "CWE-943": "NoSQL Injection",
}

# Display names of model features.
FEATURE_LABELS = {
    "total_vulns": "Total Vulnerabilities",
    "open_vulns": "Open High/Critical Vulns",
    "vuln_density": "Vulnerability Density",
    "commit_count_90d": "Commits (90d)",
    "contributor_count_90d": "Contributors (90d)",
    "open_issues": "Open Issues",
    "security_issues_open": "Open Security Issues",
    "mean_days_close_security": "Avg Days to Close Security Issue",
    "days_since_last_release": "Days Since Last Release",
    "has_security_policy": "Has Security Policy",
    "patch_debt": "Patch Debt Score",
    "avg_severity": "Avg Incident Severity",
    "recurrence_rate": "Unresolved Incident Rate",
    "total_downtime": "Total Downtime (min)",
    "vendor_enc": "Vendor",
    "ecosystem_enc": "Ecosystem",
    "is_oss_enc": "Is OSS",
    "is_saas_enc": "Is SaaS",
}

# Score table columns in table order, with their SQL types.
SCORE_TABLE = (
    ("run_id", "string"), ("scored_at", "timestamp_ntz"), ("service_name", "string"),
    ("vendor", "string"), ("ecosystem", "string"),
    ("final_risk_score", "decimal(5,1)"), ("raw_score", "decimal(5,1)"),
    ("security_posture_score", "decimal(5,1)"), ("operational_maturity_score", "decimal(5,1)"),
    ("service_reliability_score", "decimal(5,1)"), ("governance_score", "decimal(5,1)"),
    ("cve_count", "int"), ("highest_cvss", "decimal(4,1)"), ("is_kev_present", "int"),
    ("critical_cve_count", "int"), ("high_cve_count", "int"), ("medium_cve_count", "int"),
    ("low_cve_count", "int"), ("major_incident_count_12m", "int"),
    ("total_incident_hours_12m", "decimal(8,2)"), ("commit_count_90d", "int"),
    ("contributor_count_90d", "int"), ("days_since_release", "int"), ("has_security_policy", "int"),
    ("doc_quality_score", "decimal(5,4)"), ("security_guidance_score", "decimal(5,4)"),
    ("trust_coverage_score", "decimal(5,4)"), ("incident_sentiment_score", "decimal(5,4)"),
    ("data_confidence", "string"), ("ospc_org_name", "string"), ("active_controls", "string"),
)
