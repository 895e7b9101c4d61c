"""Lists, texts and formats that define the results and must not change."""

# ---- fixed values: company catalogue, (canonical name, aliases) in lookup order ----
CATALOGUE = [
    ("OpenAI", ["openai", "open ai", "openai inc", "openai, inc.", "openai limited"]),
    ("Anthropic", ["anthropic", "anthropic pbc", "anthropic ai"]),
    ("Mistral AI", ["mistral", "mistral ai", "mistral.ai", "mistral ai sas"]),
    ("Cohere", ["cohere", "cohere inc", "cohere ai"]),
    ("Perplexity", ["perplexity", "perplexity ai", "perplexity inc"]),
    ("DeepMind", ["google deepmind", "deepmind technologies", "deep mind"]),
    ("Hugging Face", ["hugging face", "huggingface", "hugging face inc"]),
    ("Scale AI", ["scale ai", "scale computing", "scale.ai"]),
    ("Databricks", ["databricks", "databricks inc"]),
    ("Midjourney", ["midjourney", "midjourney inc"]),
    ("Stability AI", ["stability ai", "stability.ai", "stability ai ltd"]),
    ("ElevenLabs", ["elevenlabs", "eleven labs", "elevenlabs inc"]),
    ("Runway", ["runway", "runway ml", "runwayml", "runway ai, inc."]),
    ("Jasper", ["jasper", "jasper ai", "jasper.ai"]),
    ("Character.AI", ["character ai", "character.ai", "character technologies"]),
    ("Glean", ["glean", "glean technologies"]),
    ("Pinecone", ["pinecone", "pinecone systems", "pinecone io"]),
    ("Weaviate", ["weaviate", "weaviate b.v."]),
    ("Qdrant", ["qdrant", "qdrant solutions"]),
    ("LangChain", ["langchain", "langchain inc"]),
    ("LlamaIndex", ["llamaindex", "llama index", "runllama"]),
    ("Anysphere", ["anysphere", "cursor ai", "cursor"]),
    ("Poolside", ["poolside", "poolside ai"]),
    ("Together AI", ["together ai", "together computer"]),
    ("Groq", ["groq", "groq inc"]),
    ("Cerebras Systems", ["cerebras", "cerebras systems"]),
    ("SambaNova Systems", ["sambanova", "sambanova systems inc"]),
    ("Modular", ["modular", "modular ai", "modular inc"]),
    ("Harvey", ["harvey", "harvey ai"]),
    ("Decagon", ["decagon", "decagon ai"]),
    ("Cognition", ["cognition", "cognition labs", "devin ai"]),
    ("Synthesia", ["synthesia", "synthesia ltd"]),
    ("Shield AI", ["shield ai", "shield ai inc"]),
    ("Weights & Biases", ["wandb", "weights and biases", "weights & biases"]),
    ("Writer", ["writer", "writer ai", "writer inc"]),
    ("Adept", ["adept", "adept ai", "adept labs"]),
    ("Inflection AI", ["inflection", "inflection ai"]),
    ("Pika Labs", ["pika", "pika labs", "pika art"]),
    ("Suno", ["suno", "suno ai"]),
    ("Udio", ["udio", "uncharted labs"]),
    ("Phind", ["phind", "phind ai"]),
    ("Baseten", ["baseten", "baseten inc"]),
    ("Replicate", ["replicate", "replicate inc"]),
    ("Modal", ["modal", "modal labs"]),
    ("Fireworks AI", ["fireworks", "fireworks ai"]),
    ("Unstructured", ["unstructured", "unstructured io"]),
    ("CoreWeave", ["coreweave", "coreweave inc"]),
    ("Lambda Labs", ["lambda", "lambda labs"]),
]

# ---- fixed values: words dropped from a name before it is compared or titled ----
SUFFIX_WORDS = [
    "inc", "incorporated", "corp", "corporation", "ltd", "limited", "llc", "pbc", "gmbh", "sas",
    "technologies", "technology", "ai", "labs", "systems",
]

# ---- fixed values: topic keywords per source ----
STARTUP_KEYWORDS = ["artificial intelligence", "machine learning", "ai", "llm", "generative ai"]
BOARD_B_KEYWORDS = ["ai", "machine learning", "data", "python", "llm"]
BOARD_C_KEYWORDS = ["ai", "machine learning", "data", "ml"]
JOB_FEED_KEYWORDS = ["ai", "machine learning", "ml", "data", "python"]

# ---- fixed values: texts put in where a source has none ----
BOARD_A_HOME = "https://remotive.com"
BOARD_B_HOME = "https://arbeitnow.com"
BOARD_C_HOME = "https://jobicy.com"
JOB_FEED_HOME = "https://weworkremotely.com"
UNKNOWN_COMPANY = "Unknown"
UNTITLED = "Untitled"
NO_AUTHOR = "Community"
ROLE_FAMILY = "Engineering"

# ---- fixed values: source names and url templates ----
DIRECTORY_NAME = "Y Combinator"
DIRECTORY_PRODUCT_NAME = "Y Combinator Directory"
DIRECTORY_URL = "https://www.ycombinator.com/companies/"
SPACES_NAME = "Hugging Face Spaces"
SPACES_URL = "https://huggingface.co/spaces/"
REPO_URL = "https://github.com/"
NEWS_FEED_NAMES = [
    "TechCrunch AI", "VentureBeat AI", "Ars Technica Tech", "MIT Tech Review", "The Verge AI",
]

# ---- fixed values: patterns, marks and limits ----
REPO_PATTERN = r"https?://(?:www\.)?github\.com/([A-Za-z0-9_.-]+)/([A-Za-z0-9_.-]+)"
REPO_TRAILING = ".,;:!'\""
PAGE_NOISE_TAGS = ["script", "style", "nav", "footer", "aside"]
BOILERPLATE_TAGS = ["nav", "svg"]
INLINE_TAGS = ["a", "abbr", "b", "code", "em", "font", "i", "mark", "q", "s", "small", "span", "strong", "sub", "sup", "u"]
MIN_PARAGRAPH_CHARS = 30
MAX_TEXT_CHARS = 12000
TRUNCATION_MARK = "\n\n[...TRUNCATED_TO_PREVENT_413...]\n\n"
TARGET_ROWS = 1050
FRESH_HOURS = 24
PRICING_MODELS = ["FREE", "FREEMIUM", "PAID", "ENTERPRISE"]
SCHEMA_VERSION = "1.0"

# ---- fixed values: resolution methods with their confidence ----
METHOD_NONE = ("NONE", 0.0)
METHOD_EXACT = ("SEED_EXACT", 1.0)
METHOD_NORMALIZED = ("SEED_NORMALIZED", 0.95)
METHOD_SUBSTRING = ("SEED_SUBSTRING", 0.90)
METHOD_RULE = ("RULE_NORMALIZATION", 0.80)

# ---- fixed values: zone names of RFC 822 mail dates, with their offsets ----
ZONE_OFFSETS = {
    "Z": "+0000", "UT": "+0000", "UTC": "+0000", "GMT": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
    "WET": "+0000", "WEST": "+0100", "BST": "+0100", "CET": "+0100", "CEST": "+0200", "EET": "+0200", "EEST": "+0300",
}

# ---- fixed values: HTML void elements and the named entities that article text uses ----
VOID_TAGS = [
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
]
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "copy": "©",
    "reg": "®", "trade": "™", "middot": "·", "bull": "•", "hellip": "…",
    "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’",
    "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»",
    "euro": "€", "pound": "£", "cent": "¢", "deg": "°", "times": "×",
}

# ---- fixed values: export tabs, (stored column, header) in order ----
EXPORT_TABS = {
    "Startups": ("startups", [
        ("entity_name", "Canonical Name"), ("employee_count", "Employee Count"),
        ("source_name", "Source Name"), ("source_url", "Source URL"),
        ("collected_at", "Collected At (ISO-8601)")]),
    "Products": ("products", [
        ("startup_name", "Startup Name"), ("pricing_model", "Pricing Model"),
        ("source_name", "Source Name"), ("source_url", "Source URL"),
        ("collected_at", "Collected At (ISO-8601)")]),
    "Research_Papers": ("research_papers", [
        ("title", "Title"), ("authors", "Authors"), ("paper_url", "Paper URL"),
        ("github_url", "GitHub URL"), ("github_stars", "GitHub Stars"),
        ("published_date", "Published Date (ISO-8601)")]),
    "Jobs": ("jobs", [
        ("company", "Canonical Company"), ("date", "Date (ISO-8601)"), ("is_remote", "Is Remote"),
        ("role_family", "Role Family"), ("source_url", "Source URL")]),
    "News": ("news", [
        ("title", "Title"), ("source_name", "Source Name"), ("source_url", "Source URL"),
        ("published_date", "Published Date (ISO-8601)"), ("collected_at", "Collected At")]),
    "Entity_Mapping_Log": ("entity_mapping_logs", [
        ("raw_name", "Raw Input String"), ("canonical_name", "Canonical Entity"),
        ("method", "Resolution Method"), ("confidence", "Confidence Score"),
        ("resolved_at", "Timestamp")]),
}
