"""Default keyword lists, tag names and spam patterns; all are operator parameters."""

# Keyword lists for classes 0 and 1, one pair per labelling rule.
WEAK_LABEL_SECURITY = [
    "api leak", "api key exposed", "rce", "remote code execution",
    "vulnerability", "exploit", "data breach", "accidental delete",
    "permission", "unauthorized", "security flaw", "hack", "injection",
    "privilege escalation", "token exposed", "credentials leaked",
]
WEAK_LABEL_PRODUCTIVITY = [
    "saves time", "automate", "faster", "workflow", "productivity",
    "efficient", "streamline", "no more manual", "automated",
    "10x faster", "game changer", "love this tool", "so useful",
    "deploy faster", "reduced time", "cut down", "improved",
]
FIRST_MATCH_SECURITY = [
    "security", "vulnerability", "exploit", "breach", "hack",
    "injection", "compromised", "attack", "malware", "threat",
]
FIRST_MATCH_PRODUCTIVITY = [
    "productivity", "efficient", "automat", "faster",
    "workflow", "streamline", "optim", "saves time",
]
BILINGUAL_SECURITY = FIRST_MATCH_SECURITY + ["安全", "漏洞", "攻击", "泄露"]
BILINGUAL_PRODUCTIVITY = FIRST_MATCH_PRODUCTIVITY + ["生产力", "效率", "自动化", "优化"]
LEAK_SECURITY = [
    "api", "leak", "vulnerability", "exploit", "breach",
    "hack", "injection", "compromised", "attack", "security",
]
LEAK_PRODUCTIVITY = [
    "productivity", "efficient", "automat", "faster",
    "workflow", "saves time", "streamline", "optimization",
]
SUPPLY_CHAIN_SECURITY = [
    "api", "leak", "vulnerability", "exploit", "breach",
    "hack", "injection", "compromised", "supply chain",
]
SUPPLY_CHAIN_PRODUCTIVITY = [
    "efficient", "productivity", "automate", "faster",
    "saves time", "workflow", "streamline", "optimization",
]
SHORT_SECURITY = ["security", "vulnerability", "compromised", "exploit"]
SHORT_PRODUCTIVITY = ["productivity", "efficient", "automate"]
MAJORITY_SECURITY = [
    "api", "leak", "rce", "vulnerability", "exploit",
    "breach", "delete", "permission", "hack", "injection",
]
MAJORITY_PRODUCTIVITY = [
    "saves", "time", "automate", "faster", "workflow",
    "efficient", "streamline", "manual", "productivity",
]

# Phrases that mark spam.
SPAM_PATTERNS = [
    "buy now",
    "click here",
    "free.*bitcoin",
    "make money fast",
    "check my profile",
]

# Long names of title tags.
TAG_NAMES = {
    "P": "Project",
    "D": "Discussion",
    "R": "Research",
    "Q": "Question",
    "N": "News",
    "I": "Issue",
    "Tutorial": "Tutorial",
}

# Words that name a class in a labeller's free-text reply.
REPLY_WORDS = {0: ["security", "risk", "安全"], 1: ["productivity", "gain", "生产力"]}
