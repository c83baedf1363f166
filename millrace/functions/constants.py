"""Values that define the data format.  Everything here is data, not logic."""

# The ordered keyword -> category list; the first keyword found in a lower-cased name decides.
CATEGORY_KEYWORDS = [
    ("conjunction", "conjunction"),
    ("connector", "connector"),
    ("modal", "modal"),
    ("pronoun", "pronoun"),
    ("possessive", "pronoun"),
    ("adjective", "adjective"),
    ("locative", "locative"),
    ("demonstrative", "demonstrative"),
    ("interrogative", "interrogative"),
    ("greeting", "greeting"),
    ("preposition", "preposition"),
    ("alphabet", "letter"),
    ("orthography", "letter"),
    ("phonology", "letter"),
    ("lexicon", "word"),
    ("infinitive", "verb"),
    ("verb", "verb"),
    ("number", "number"),
    ("noun", "noun"),
    ("continuous", "tense"),
    ("perfect", "tense"),
    ("going_to", "tense"),
    ("tense", "tense"),
    ("simple", "tense"),
    ("affirmative", "tense"),
    ("negation", "tense"),
    ("question", "tense"),
    ("past", "tense"),
    ("future", "tense"),
    ("present", "tense"),
]
DEFAULT_CATEGORY = "grammar item"

# The two instructions that name a translation direction, and what the types are called.
B2E = "Translate from Balanda to English"
E2B = "Translate from English to Balanda"
ITYPES = ["explain", "identify", "other", "translate_b2e", "translate_e2b"]
SPLITS = ["train", "val", "test"]

# Fixed value: the pattern of instructions that ask to identify a category (case-insensitive).
IDENTIFY_PATTERN = r"^Identify\s+(?:the\s+)?(?:Balanda\s+)?(.+)$"

# Fixed value: the system message of every chat.
SYSTEM_PROMPT = "You are a Balanda (Njo Viri) language expert. Follow the user's instruction precisely."

# The type of every header, texts of an inferred one and of one from metadata.
HEADER_TYPE = "grammar_rule"
METADATA_DESCRIPTION = "Balanda lexicon extracted from {file}."
INFERRED_NOTE = "Inferred from training records."
INFERRED_DESCRIPTION = "This file contains Balanda language training examples for {name}. "
INFERRED_ITEMS = "Items covered: {items}."

RECORD_KEYS = ["instruction", "input", "output"]
RULE_FIELDS = ["function", "structure", "notes"]

#: White space as Unicode-aware string methods see it, as a class both Java and RE2 regular expressions accept.
WS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
