"""Rule-based classifiers and filters."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Titles by role family, tried in this order; the default is ENGINEERING.
ROLE_FAMILIES = {
    "PRODUCT": ["product manager", "product lead", "head of product", "group product manager", "director of product", "vp of product", "technical product manager", "pm "],
    "DESIGN": ["designer", "design lead", "ui/ux", "product designer", "creative director"],
    "RESEARCH": ["research scientist", "research engineer", "scientist", "phd", "fellow", "postdoc", "alignment researcher", "research fellow"],
    "DATA": ["data analyst", "data scientist", "analytics", "bi analyst", "business intelligence"],
    "SALES": ["sales", "account executive", "business development", "bdr", "sdr", "partnerships", "deal desk", "gtm "],
    "MARKETING": ["marketing", "growth", "content", "community", "developer advocate", "devrel"],
    "OPERATIONS": ["operations", "finance", "legal", "counsel", "hr", "recruiting", "talent", "people ops", "compliance"],
}
#: Statements on price.
FREE = ["open source", "open-source", "free to use", "free download", "mit license", "apache 2.0", "apache-2.0", "open weights", "free locally", "free tier"]
FREE_THEN_PAID = ["freemium", "free tier with paid upgrade", "free plan then paid"]
FREEMIUM = ["freemium", "free plan with pro", "free credits", "free tier with paid"]
ENTERPRISE = ["contact sales", "enterprise pricing", "demo upon request", "custom quote", "enterprise tier"]
PAID = ["paid plan", "paid subscription", "pricing starts", "per seat", "subscription plan", "commercial license", "/mo", "/month", "$"]
FREE_LICENSES = ["license:mit", "license:apache-2.0", "license:openrail", "license:gpl"]
#: Signs of a challenge page.
CHALLENGE_SIGNS = ["cf-browser-verification", "cf-challenge-running", "challenge-platform", "just a moment", "checking your browser", "verify you are human", "captcha", "recaptcha", "hcaptcha", "datadome", "access denied", "please complete the security check"]
#: Accounts known to be organisations, parts of names that point to one, and endings that do.
KNOWN_ORGS = [
    "mistralai", "meta-llama", "deepseek-ai", "qwen", "google", "openai", "anthropic", "stabilityai", "eleutherai", "nousresearch", "tiiuae",
    "cohere", "allenai", "bigcode", "unsloth", "openbmb", "vllm-project", "baai", "thudm", "01-ai", "nexusflow", "internlm", "deci", "writer",
    "replicate", "adept", "microsoft", "nvidia", "databricks", "salesforce", "ibm", "apple", "amazon", "huggingface", "upstage",
    "togethercomputer", "defog", "lmsys", "mosaicml", "kyutai", "black-forest-labs", "cartesia", "morph-labs", "sakanaai", "liquid-ai",
]
ORG_PARTS = [
    "ai", "lab", "labs", "research", "tech", "technologies", "org", "team", "systems", "robotics", "intelligence", "compute", "studio", "foundry",
    "ventures", "foundation", "institute", "llm", "nlp", "corporation", "community", "project", "data", "deep", "neural", "group", "soft", "corp",
]
ORG_ENDINGS = ["ai", "labs", "tech", "org", "research"]
#: Entities looked for in news.
KNOWN_ENTITIES = [
    "OpenAI", "Anthropic", "Google DeepMind", "Meta AI", "Mistral AI", "Cohere", "xAI", "Stability AI", "Midjourney", "Runway", "Hugging Face", "LangChain", "Pinecone",
    "NVIDIA", "AMD", "Databricks", "Snowflake", "Scale AI", "Perplexity AI", "Cursor", "DeepSeek", "Microsoft", "Amazon AWS", "Apple", "Groq",
]
#: Hosts whose links name no startup, words that make no name, and sections without entries.
IGNORED_HOSTS = [
    "github.com", "twitter.com", "x.com", "arxiv.org", "youtube.com", "medium.com", "linkedin.com", "facebook.com", "discord.gg", "discord.com",
    "reddit.com", "t.me", "huggingface.co", "google.com", "apple.com", "awesome.re",
]
NO_PRODUCT_NAMES = ["badge", "license", "arxiv", "paper", "contributing", "issue", "pull"]
NO_STARTUP_NAMES = [*NO_PRODUCT_NAMES, "http", "website", "link", "demo"]
IGNORED_SECTIONS = ["recommended reading", "milestones", "learning resources", "more lists", "contents"]
#: Companies by the host of their products.
HOST_COMPANIES = {
    "openai.com": "OpenAI", "anthropic.com": "Anthropic", "deepmind.google": "Google DeepMind", "x.ai": "xAI", "mistral.ai": "Mistral AI", "stability.ai": "Stability AI",
    "cohere.com": "Cohere", "llama.com": "Meta", "huggingface.co": "Hugging Face", "lmsys.org": "LMSYS", "github.com": "GitHub", "microsoft.com": "Microsoft",
    "google.com": "Google", "runwayml.com": "Runway", "midjourney.com": "Midjourney", "perplexity.ai": "Perplexity",
}
#: Phrases that name a maker, and words that start no name.
MAKERS = [r"(?i)(?:by|from|created by|developed by|trained by)\s+([A-Z][A-Za-z0-9\s.-]+?)(?:[\.,;\(\[]|$)", r"(?i)^([A-Z][A-Za-z0-9\s.-]+?)'s\s+"]
NO_MAKER_STARTS = ["a", "an", "the", "our", "your", "idea", "scratch", "text", "audio", "video", "code"]


def any_of(words: list[str]) -> str:
    """A Java pattern for any of the literals."""
    return "|".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in words)


def holds(text: Column, words: list[str]) -> Column:
    return F.lower(text).rlike(any_of(words))


def role_family(title: Column) -> Column:
    found = None
    for family, words in ROLE_FAMILIES.items():
        found = F.when(holds(title, words), family) if found is None else found.when(holds(title, words), family)
    return found.otherwise("ENGINEERING")


def pricing(text: Column) -> Column:
    """FREE, FREEMIUM, ENTERPRISE or PAID if the text says so, else null."""
    free = F.when(holds(text, FREE_THEN_PAID), "FREEMIUM").otherwise("FREE")
    return F.when(holds(text, FREE), free).when(holds(text, FREEMIUM), "FREEMIUM").when(holds(text, ENTERPRISE), "ENTERPRISE").when(holds(text, PAID), "PAID")


def license_pricing(tags: Column) -> Column:
    return F.when(F.arrays_overlap(tags, F.array(*map(F.lit, FREE_LICENSES))), "FREE")


def is_remote(text: Column) -> Column:
    return text.rlike(r"(?i)\b(remote|anywhere|wfh|telecommute|distributed)\b")


def is_challenge(html: Column) -> Column:
    return holds(html, CHALLENGE_SIGNS)


def captcha(html: Column) -> Column:
    text = F.lower(html)
    return (
        F.when(text.contains("recaptcha"), "reCAPTCHA").when(text.rlike("h-?captcha"), "hCaptcha").when(text.contains("cf-turnstile"), "Cloudflare Turnstile").when(text.contains("datadome"), "DataDome")
    )


def is_org(slug: Column) -> Column:
    """Whether an account's name points to an organisation."""
    name, parts = F.lower(slug), "|".join(ORG_PARTS)
    return name.isin(KNOWN_ORGS) | name.rlike(rf"-(?:{parts})$|^(?:{parts})-|-(?:{parts})-|(?:{'|'.join(ORG_ENDINGS)})$")


def mentions(text: Column) -> Column:
    """The known entities that a text names, in their fixed order."""
    return F.array_compact(F.array(*[F.when(text.rlike(rf"(?i)\b{re.escape(e)}\b"), e) for e in KNOWN_ENTITIES]))


def good_name(name: Column, unwanted: list[str]) -> Column:
    return F.length(name).between(2, 50) & ~name.startswith("!") & ~holds(name, unwanted)


def startup_host(host: Column) -> Column:
    return (host != "") & ~host.isin(IGNORED_HOSTS) & ~host.endswith(".edu") & ~host.endswith(".gov")


def host_company(host: Column) -> Column:
    """Company by host or parent host, the first in the fixed order."""
    return F.coalesce(*[F.when((host == h) | host.endswith("." + h), name) for h, name in HOST_COMPANIES.items()])


def maker(description: Column, host: Column) -> Column:
    """The company that a description names as the maker, else the one behind the host."""
    found = []
    for pattern in MAKERS:
        name = F.trim(F.regexp_extract(description, pattern, 1))
        phrase = F.split(F.lower(name), r"\s+")[0].isin(NO_MAKER_STARTS) & (F.size(F.split(name, r"\s+")) > 2)
        found.append(F.when(~phrase & F.length(name).between(3, 34), name))
    return F.coalesce(*found, host_company(host))
