"""Column orders, vocabularies, templates and rules that results depend on."""

from __future__ import annotations

# Column orders of the tables.
QUERY_COLUMNS = ["query", "source_type", "iteration", "status"]
CANDIDATE_COLUMNS = ["url", "normalized_url", "domain", "title", "snippet", "query_used", "search_engine", "rank", "discovered_date", "source_type", "status", "notes"]
FRONTIER_COLUMNS = ["frontier_id", "url", "normalized_url", "domain", "priority", "status", "discovered_from", "query_used", "first_seen_date", "last_checked_date", "retry_count", "crawl_error", "notes"]
CRAWL_COLUMNS = ["url", "normalized_url", "domain", "crawl_status", "http_status", "content_type", "language", "title", "markdown_path", "html_path", "crawl_date", "error_message", "word_count", "char_count", "is_duplicate_content", "notes"]
DOMAIN_SUMMARY_COLUMNS = ["domain", "url_count", "priority", "sample_titles"]
SOURCE_COLUMNS = ["canonical_name", "source_url", "source_title", "source_domain", "evidence_text", "claim_status"]
ENTITY_COLUMNS = [
    "canonical_name", "aliases", "entity_type", "title", "overview", "locations", "supply_chain_categories", "facilities", "investment",
    "jobs", "workforce_programs", "related_organizations",
    "timeline", "key_facts", "source_count", "sources", "confidence_score", "publication_date_range", "claim_status", "currency", "as_of",
    "conflicts_or_uncertainties", "details",
]
ENTITY_JSON = {"aliases", "locations", "supply_chain_categories", "facilities", "investment", "jobs", "workforce_programs", "related_organizations", "timeline", "key_facts", "sources", "conflicts_or_uncertainties"}

# The fields of a record in a model's answer; in a section, whether a field is a text or a list.
RECORD_TEXTS = ["entity_name", "entity_type", "supply_chain_category", "title", "overview", "details", "evidence_text", "claim_status", "publication_date"]
RECORD_LISTS = ["aliases", "locations", "key_facts"]
RECORD_SECTIONS = {
    "facilities": {"name": "text", "county": "text"}, "investment": {"amount": "text", "date": "text"}, "jobs": {"hiring_goal": "text", "hiring_areas": "list"},
    "related_organizations": {"name": "text", "role": "text"},
}

# Statuses and vocabularies.
FRONTIER_STATUSES = ["new", "queued", "crawled", "failed", "duplicate", "rejected", "needs_review"]
PRIORITY_ORDER = ["high", "medium", "low", "skip"]
STATUS_OF_PRIORITY = {"high": "queued", "medium": "queued", "low": "needs_review", "skip": "rejected"}
ENTITY_TYPES = [
    "company", "facility", "joint_venture", "government_program", "investment_announcement", "supplier_relationship", "battery_material",
    "charging_infrastructure", "workforce_training",
    "research_center", "policy_or_incentive", "event", "person",
]
CATEGORIES = [
    "vehicle_manufacturing", "battery_cell_manufacturing", "battery_materials", "battery_recycling", "power_electronics",
    "thermal_management", "charging_infrastructure", "automotive_components",
    "logistics", "workforce_training", "government_support", "research_and_development", "unknown",
]
CLAIM_STATUSES = ["announced", "under_construction", "operational", "cancelled", "superseded"]
PAGE_CLAIM_STATUSES = ["announced", "under_construction", "operational"]
CURRENCY_BUCKETS = ["fresh", "aging", "stale", "undated"]

# Thresholds.
FRESH_MONTHS, STALE_MONTHS = 12, 24
MIN_CONFIDENCE, MAX_UNVALIDATED_CONFIDENCE = 0.3, 0.95
GROUNDING_THRESHOLD, MERGE_THRESHOLD, REVIEW_THRESHOLD = 85, 90, 80
MAX_RETRIES, MAX_NEW_QUERIES, MAX_ITERATIONS, MAX_ENTITIES = 3, 100, 3, 30
MAX_RESULTS, LANGUAGE_PREFIX, PROMPT_CHARS = 10, 2000, 30_000

# Query parameters that only track.
TRACKING_PARAMETERS = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "mc_cid", "mc_eid"]

# Host patterns by priority.
PRIORITY_RULES = {
    "skip": ["facebook.com", "instagram.com", "twitter.com", "x.com", "tiktok.com", "youtube.com", "linkedin.com", "reddit.com"],
    "high": [
        ".gov", "georgia.org", "georgiaquickstart.org", "selectgeorgia.com", "developmentauthority", "chooseaugusta", "savannahjda.com",
        "hyundai.com", "hyundaimotorgroup.com",
        "hyundainews.com", "kia.com", "kianewscenter.com", "rivian.com", "sk.com", "skbatteryamerica.com", "prnewswire.com",
        "businesswire.com", "globenewswire.com",
    ],
    "medium": [
        "ajc.com", "savannahnow.com", "bizjournals.com", "gpb.org", "11alive.com", "wsbtv.com", "wtoc.com", "georgiatrend.com",
        "electrek.co", "insideevs.com", "utilitydive.com",
        "canarymedia.com", "reuters.com", "apnews.com", ".edu",
    ],
    "low": ["blogspot.", "wordpress.", "medium.com", "substack.com", "indeed.com", "ziprecruiter.com", "glassdoor.com", "simplyhired.com", "yelp.com", "pinterest."],
}

# Query templates.
GENERAL_QUERIES = [
    '"Georgia" "electric vehicle" "supplier"', '"Georgia" "EV supplier"', '"Georgia" "battery manufacturer"',
    '"Georgia" "battery materials"', '"Georgia" "electric vehicle manufacturing"',
    '"Georgia" "automotive supplier" "EV"', '"Georgia" "Hyundai Metaplant" "supplier"', '"Georgia" "Rivian" "supplier"',
    '"Georgia" "Kia" "electric vehicle"', '"Georgia" "EV battery" "jobs"',
    '"Georgia" "EV battery" "investment"', '"Georgia" "charging infrastructure" "company"', '"Georgia" "electric mobility" "supplier"',
    '"Georgia" "battery recycling" "company"',
    '"Georgia" "cathode" "battery"', '"Georgia" "anode" "battery"', '"Georgia" "electrolyte" "battery"', '"Georgia" "copper foil" "battery"',
]
SITE_TERMS = ['"electric vehicle"', '"battery"', '"Hyundai Metaplant"', '"supplier"', '"electric mobility"', '"EV"', '"jobs" "battery"']
LOCATION_TEMPLATES = ['"{location}" "electric vehicle" "supplier"', '"{location}" "battery" "manufacturing"', '"{location}" "EV" "supplier"', '"{location}" "battery" "manufacturer"', '"{location}" "EV charging" "company"']
COMPANY_TEMPLATES = ['"{company}" "Georgia" "electric vehicle"', '"{company}" "Georgia" "EV"', '"{company}" "Georgia" "battery"', '"{company}" "Hyundai Metaplant"', '"{company}" "Georgia" "supplier"', '"{company}" "press release" "Georgia"']
FOLLOWUP_COMPANY_TEMPLATES = ['"{company}" "Georgia"', '"{company}" "Georgia" "EV"', '"{company}" "Georgia" "battery"', '"{company}" "supplier" "Georgia"', '"{company}" "jobs" "Georgia"']
FOLLOWUP_LOCATION_TEMPLATES = ['"{location}" "Georgia" "EV" "supplier"', '"{location}" "battery" "manufacturing"']

# Sentences of fine-tuning examples.
WHAT_QUESTION = "What does {name} do in Georgia's EV supply chain?"
WHERE_QUESTION = "Where does {name} operate in Georgia?"
WHERE_ANSWER = "{name} operates in {places} based on the sources."

# Known aliases of canonical names.
ENTITY_ALIASES = {"Hyundai Motor Group Metaplant America": ["HMGMA", "Hyundai Metaplant", "Hyundai Motor Group Metaplant"], "SK Battery America": ["SK On", "SKBA"]}

# Legal forms that a name may end with.
LEGAL_FORMS = ["inc", "incorporated", "llc", "ltd", "limited", "corp", "corporation", "co", "company", "gmbh", "plc", "lp", "llp", "sa", "ag"]
