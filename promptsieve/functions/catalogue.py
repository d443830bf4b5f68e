"""The rule catalogue: what counts as a finding, and how much it weighs.

Every regular expression, term, score, confidence and reason text below is a
fixed value: reviewed output depends on it character for character.  The
`needs` and `holds` of a pattern are ours.  They let Spark skip the regular
expression on texts that cannot match (see `operators.detect`).
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Pattern:
    """A regular expression and, to save time, what any match of it contains:
    one of the lower-case words in `needs` (runs of a-z and 0-9, whole) or one
    of the lower-case substrings in `holds`.  With neither, it is always tried.
    """

    regex: str
    needs: tuple[str, ...] = ()
    holds: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rule:
    """A category raised once per match of any of its patterns.

    `kind` is "regex" for a plain rule, "card" where the match must also pass
    a Luhn check and "contact" where the words around it must be sensitive.
    """

    category: str
    score: int
    confidence: str
    reason: str
    source: str
    patterns: tuple[Pattern, ...]
    kind: str = "regex"


INTERNAL = "internal_policy"
ACCEPTABLE_USE = "acceptable_use_policy"
USAGE = "usage_policy"

# A `holds` entry standing for "any decimal digit".
DIGIT = "\\digit"

# --- Fixed values: personal data and secrets, in reporting order -------------

PERSONAL_DATA_RULES = (
    Rule(
        "pii_ssn", 95, "high",
        "Prompt contains an SSN-like value.",
        INTERNAL,
        (Pattern(r"\b\d{3}-\d{2}-\d{4}\b", holds=(DIGIT,)),),
    ),
    Rule(
        "pii_ein", 90, "high",
        "Prompt contains an EIN-like value.",
        INTERNAL,
        (
            Pattern(
                r"\b(?:ein|employer identification number)\b.{0,40}\b\d{2}-\d{7}\b",
                holds=(DIGIT,),
            ),
            Pattern(r"\b\d{2}-\d{7}\b", holds=(DIGIT,)),
        ),
    ),
    Rule(
        "pii_credit_card", 95, "high",
        "Prompt contains a credit-card-like number that passes a Luhn check.",
        INTERNAL,
        (Pattern(r"\b(?:\d[ -]*?){13,19}\b", holds=(DIGIT,)),),
        kind="card",
    ),
    Rule(
        "financial_account_or_routing_number", 90, "high",
        "Prompt appears to contain a bank account or routing number.",
        INTERNAL,
        (
            Pattern(r"\b(routing number|aba)\b.{0,40}\b\d{9}\b", ("routing", "aba")),
            Pattern(
                r"\b(account number|acct number|bank account)\b.{0,40}\b\d{6,17}\b",
                ("account", "acct"),
            ),
        ),
    ),
    Rule(
        "credentials_or_secrets", 95, "high",
        "Prompt appears to contain credentials, API keys, passwords, tokens, or secrets.",
        USAGE,
        (
            Pattern(
                r"\b(api[_ -]?key|secret|password|passwd|token|private key)\b.{0,60}\b[^\s]{8,}\b",
                ("key", "apikey", "secret", "password", "passwd", "token"),
            ),
            Pattern(
                r"\b(sk-[A-Za-z0-9_-]{20,}|ghp_[A-Za-z0-9_]{20,}|AKIA[0-9A-Z]{16})\b",
                ("sk", "ghp"),
                holds=("akia",),
            ),
            Pattern(
                r"-----BEGIN (?:RSA |OPENSSH |EC )?PRIVATE KEY-----",
                ("private",),
            ),
        ),
    ),
    Rule(
        "date_of_birth", 88, "high",
        "Prompt appears to include a date of birth.",
        INTERNAL,
        (
            Pattern(
                r"\b(?:date of birth|dob)\b.{0,40}\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b",
                ("birth", "dob"),
            ),
            Pattern(
                r"\b(?:date of birth|dob)\b.{0,40}\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?\s+\d{1,2},?\s+\d{4}\b",
                ("birth", "dob"),
            ),
        ),
    ),
    Rule(
        "pii_email_with_sensitive_context", 82, "high",
        "Prompt contains an email address paired with client, tax, medical, financial, or other sensitive context.",
        INTERNAL,
        (Pattern(r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", holds=("@",)),),
        kind="contact",
    ),
    Rule(
        "pii_phone_with_sensitive_context", 82, "high",
        "Prompt contains a phone number paired with client, tax, medical, financial, or other sensitive context.",
        INTERNAL,
        (Pattern(r"\b(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]\d{3}[-.\s]\d{4}\b", holds=(DIGIT,)),),
        kind="contact",
    ),
)

# --- Fixed values: health-information terms ----------------------------------

PHI_TERMS = (
    "phi", "protected health information", "hipaa", "patient", "diagnosis",
    "treatment", "prescription", "medical record", "health insurance",
    "icd-10", "cpt code", "mrn", "lab result",
)
PHI_STRONG_TERMS = ("phi", "protected health information", "hipaa", "mrn")
PHI_CATEGORY = "restricted_phi"
PHI_REASON = (
    "Prompt appears to contain or reference PHI/medical information that "
    "requires approved safeguards."
)
PHI_STRONG = (94, "high")
PHI_WEAK = (68, "medium")

# --- Fixed values: client-data term groups -----------------------------------

CLIENT_TERMS = ("client", "customer", "engagement", "taxpayer", "patient")
SENSITIVE_DOCUMENT_TERMS = (
    "1040", "1099", "w-2", "k-1", "tax return", "financial statement",
    "financial statements", "balance sheet", "income statement", "cash flow",
    "trial balance", "general ledger", "workpaper", "work paper", "audit file",
    "engagement letter", "bank statement", "bank statements", "payroll",
)
SENSITIVE_DATA_TERMS = (
    "ssn", "social security", "ein", "date of birth", "dob",
    "driver's license", "passport", "confidential", "proprietary",
    "internal use only", "do not distribute",
)
ANALYSIS_TERMS = (
    "analyze", "summarize", "review", "extract", "compare", "classify",
    "calculate", "compute", "reconcile", "validate",
)
CONTACT_CONTEXT_TERMS = (
    CLIENT_TERMS + SENSITIVE_DOCUMENT_TERMS + SENSITIVE_DATA_TERMS
    + ("tax", "medical", "financial")
)
# The evidence of a client-data finding is looked up by group label.
CLIENT_GROUP_LABELS = ("client", "sensitive_document", "sensitive_data", "analysis_action")

CLIENT_STRONG = (
    "confidential_client_data", 74, "medium",
    "Prompt references client context together with sensitive documents, identifiers, "
    "restricted data, or financial/tax records.",
)
CLIENT_WEAK = (
    "possible_client_sensitive_data", 46, "low",
    "Prompt has client context plus an analysis/review action; review to confirm whether "
    "client-sensitive data is present.",
)

# --- Fixed values: internal policy -------------------------------------------

INTERNAL_POLICY_RULES = (
    Rule(
        "audit_evidence", 82, "high",
        "Prompt appears to ask AI to generate or validate audit evidence, substantive testing, or professional-standard support.",
        ACCEPTABLE_USE,
        (
            Pattern(
                r"\b(generate|create|validate|verify|provide|support)\b.{0,90}\b(audit evidence|audit support|evidence for audit)\b",
                ("audit",),
            ),
            Pattern(
                r"\b(substantive testing|substantive audit procedure|risk assessment|gaas|workpaper support)\b",
                ("substantive", "assessment", "gaas", "workpaper"),
            ),
        ),
    ),
    Rule(
        "tax_or_accuracy_calculation", 80, "high",
        "Prompt appears to request a tax, reconciliation, or audit calculation requiring accuracy.",
        ACCEPTABLE_USE,
        (
            Pattern(
                r"\b(calculate|compute|determine|prepare|finalize)\b.{0,90}\b(tax liability|tax due|tax calculation|reconciliation|substantive audit)\b",
                ("tax", "reconciliation", "substantive"),
            ),
            Pattern(
                r"\b(reconcile|reconciliation)\b.{0,90}\b(bank|ledger|trial balance|financial statement|tax)\b",
                ("reconcile", "reconciliation"),
            ),
        ),
    ),
    Rule(
        "final_deliverable_without_review", 72, "medium",
        "Prompt appears to request a final deliverable or client-ready output without documented review/sign-off.",
        ACCEPTABLE_USE,
        (
            Pattern(
                r"\b(final|finalize|ready to send|send to client)\b.{0,120}\b(without|no need for|skip)\b.{0,90}\b(review|sign[- ]?off|approval)\b",
                ("without", "need", "skip"),
            ),
            Pattern(
                r"\b(final deliverable|client deliverable|final report|opinion letter)\b.{0,120}\b(without review|no review)\b",
                ("review",),
            ),
        ),
    ),
    Rule(
        "replace_professional_judgment", 80, "high",
        "Prompt appears to use AI to replace professional judgment, quality control, review, or standards.",
        ACCEPTABLE_USE,
        (
            Pattern(
                r"\b(replace|bypass|skip|avoid|work around)\b.{0,90}\b(professional judgment|human review|qc|quality control|approval|gaas|professional standards)\b",
                ("professional", "human", "qc", "quality", "approval", "gaas"),
            ),
            Pattern(
                r"\b(do not tell|hide from|avoid logging|avoid audit trail)\b",
                ("tell", "hide", "avoid"),
            ),
        ),
    ),
)

# --- Fixed values: usage policy ----------------------------------------------

USAGE_POLICY_RULES = (
    Rule(
        "malware_or_phishing", 95, "high",
        "Prompt appears related to malware, phishing, credential theft, ransomware, or abusive cyber activity.",
        USAGE,
        (
            Pattern(
                r"\b(phishing|credential theft|steal credentials|keylogger|ransomware|malware|exploit kit|botnet)\b",
                ("phishing", "credential", "credentials", "keylogger", "ransomware", "malware", "exploit", "botnet"),
            ),
            Pattern(
                r"\b(bypass|evade)\b.{0,90}\b(edr|antivirus|detection|mfa|authentication)\b",
                ("bypass", "evade"),
            ),
            Pattern(
                r"\b(sql injection|xss|privilege escalation)\b.{0,90}\b(without permission|unauthorized|stealth)\b",
                ("permission", "unauthorized", "stealth"),
            ),
        ),
    ),
    Rule(
        "illegal_or_fraud", 82, "high",
        "Prompt appears related to fraud, scams, impersonation, illegal activity, or deception.",
        USAGE,
        (
            Pattern(
                r"\b(scam|fraud|impersonate|fake identity|spam campaign|money laundering|forge|forgery)\b",
                ("scam", "fraud", "impersonate", "fake", "spam", "laundering", "forge", "forgery"),
            ),
            Pattern(
                r"\b(trick|deceive|manipulate)\b.{0,90}\b(user|customer|voter|employee|person)\b",
                ("trick", "deceive", "manipulate"),
            ),
        ),
    ),
    Rule(
        "threats_harassment_or_hate", 88, "high",
        "Prompt appears related to threats, harassment, intimidation, hate, or violent harm.",
        USAGE,
        (
            Pattern(
                r"\b(threaten|harass|intimidate|doxx|swat)\b",
                ("threaten", "harass", "intimidate", "doxx", "swat"),
            ),
            Pattern(
                r"\b(terrorism|terrorist|violent attack|mass casualty)\b",
                ("terrorism", "terrorist", "attack", "casualty"),
            ),
            Pattern(
                r"\b(hate speech|racial slur|dehumanize)\b",
                ("hate", "racial", "dehumanize"),
            ),
        ),
    ),
    Rule(
        "weapons_or_physical_harm", 92, "high",
        "Prompt appears to request weapons, explosives, poison, or physical-harm enablement.",
        USAGE,
        (
            Pattern(
                r"\b(make|build|assemble|obtain|use)\b.{0,90}\b(bomb|explosive|firearm|weapon|poison|chemical weapon|biological weapon)\b",
                ("bomb", "explosive", "firearm", "weapon", "poison"),
            ),
        ),
    ),
    Rule(
        "minor_sexual_content", 100, "high",
        "Prompt appears to involve sexual exploitation, grooming, or sexualized content involving minors.",
        USAGE,
        (
            Pattern(
                r"\b(minor|child|teen|under\s*18|underage)\b.{0,120}\b(sexual|nude|groom|explicit|violent roleplay)\b",
                ("sexual", "nude", "groom", "explicit", "violent"),
            ),
            Pattern(r"\b(csam|child sexual abuse)\b", ("csam", "abuse")),
        ),
    ),
    Rule(
        "self_harm_encouragement", 95, "high",
        "Prompt appears to encourage or facilitate suicide, self-harm, or disordered eating.",
        USAGE,
        (
            Pattern(
                r"\b(best|painless|effective|how to)\b.{0,90}\b(die|suicide|kill myself|self[- ]?harm|cut myself|starve myself|purge)\b",
                ("best", "painless", "effective", "how"),
            ),
            Pattern(r"\b(pro[- ]?ana|thinspo)\b", ("ana", "proana", "thinspo")),
        ),
    ),
    Rule(
        "safeguard_bypass_or_hidden_data", 82, "high",
        "Prompt appears to request bypassing safeguards, revealing hidden instructions, system prompts, or private data.",
        USAGE,
        (
            Pattern(
                r"\b(jailbreak|ignore previous instructions|bypass safety|bypass safeguards|developer mode)\b",
                ("jailbreak", "ignore", "bypass", "developer"),
            ),
            Pattern(
                r"\b(reveal|show|print|extract)\b.{0,90}\b(system prompt|hidden instructions|developer message|private data|confidential data)\b",
                ("system", "hidden", "developer", "private", "confidential"),
            ),
        ),
    ),
    Rule(
        "high_stakes_automation", 78, "medium",
        "Prompt appears to automate a high-stakes decision without human review.",
        USAGE,
        (
            Pattern(
                r"\b(auto[- ]?approve|auto[- ]?deny|automatically decide|make the final decision)\b.{0,120}\b(loan|credit|employment|hiring|insurance|housing|medical|legal|education|benefits)\b",
                ("auto", "autoapprove", "autodeny", "automatically", "decision"),
            ),
            Pattern(
                r"\b(without human review|no human review)\b.{0,120}\b(loan|credit|employment|hiring|insurance|housing|medical|legal|education|benefits)\b",
                ("human",),
            ),
        ),
    ),
)

# --- Fixed values: unparseable input lines -----------------------------------

INVALID_LINE = ("input_quality", 70, "high", "high")
INVALID_LINE_REASON = "Input line could not be parsed as JSON."

# --- Fixed values: scoring ----------------------------------------------------

LEVEL_FLOORS = (("critical", 90), ("high", 70), ("medium", 40), ("low", 15))
LEVELS = ("critical", "high", "medium", "low", "none")
CONFIDENCES = ("high", "medium", "low")
EXTRA_CATEGORY_POINTS = 2
MAX_EXTRA_POINTS = 10
MAX_SCORE = 100
MAX_EVIDENCE = 5
EXCERPT_CHARS = 260
WINDOW_WORDS = 8


@dataclass(frozen=True)
class Catalogue:
    """The rules of one review, in reporting order.  Pass your own to `detect`."""

    personal_data: tuple[Rule, ...] = PERSONAL_DATA_RULES
    internal_policy: tuple[Rule, ...] = INTERNAL_POLICY_RULES
    usage_policy: tuple[Rule, ...] = USAGE_POLICY_RULES
    phi_terms: tuple[str, ...] = PHI_TERMS
    phi_strong_terms: tuple[str, ...] = PHI_STRONG_TERMS
    client_terms: tuple[str, ...] = CLIENT_TERMS
    document_terms: tuple[str, ...] = SENSITIVE_DOCUMENT_TERMS
    data_terms: tuple[str, ...] = SENSITIVE_DATA_TERMS
    action_terms: tuple[str, ...] = ANALYSIS_TERMS
    contact_terms: tuple[str, ...] = CONTACT_CONTEXT_TERMS

    def only(self, *categories: str) -> Catalogue:
        """The rules of these categories; nothing else is looked for."""
        kept = {
            family: tuple(r for r in getattr(self, family) if r.category in categories)
            for family in ("personal_data", "internal_policy", "usage_policy")
        }
        if PHI_CATEGORY not in categories:
            kept["phi_terms"] = ()
        if not {CLIENT_STRONG[0], CLIENT_WEAK[0]} & set(categories):
            kept["client_terms"] = ()
        return replace(self, **kept)


DEFAULT = Catalogue()
