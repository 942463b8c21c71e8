"""Fixed values that results depend on."""

# Words that make a difference trivial.
COMMON_WORDS = (
    "the a an and or but in on at to for of is it i we he she they you my your his her its our "
    "their this that was were be been has have had do does did will would could should may might "
    "not no so if then than just also very"
).split()

# Speech models from best to worst.
MODEL_ORDER = ["large", "distil-large-v3", "medium", "small", "base", "tiny"]

# Price of 1,000 tokens (input, output) by the start of a model's name, first match first; the default.
PRICES = [
    ("claude-opus-4", 0.015, 0.075),
    ("claude-sonnet-4", 0.003, 0.015),
    ("claude-sonnet-3", 0.003, 0.015),
    ("claude-haiku-4", 0.001, 0.005),
    ("claude-haiku-3", 0.0008, 0.004),
]
DEFAULT_PRICE = (0.003, 0.015)
IMAGE_PRICE, TOKENS_PER_WORD, WORDS_PER_SECOND = 0.02, 1.3, 2.5

# Lines that start a speaker's segment. Full-line forms have the text in the last group.
STRUCTURE = {
    "lex": (r"^([\p{L}\p{N}_][\p{L}\p{N}_\s]+?)\s*\[?\(([0-9]{1,2}:[0-9]{2}:[0-9]{2})\)\]?", None),
    "bracketed": (r"^\[([0-9]{1,2}:[0-9]{2}:[0-9]{2})\]\s+([\p{L}\p{N}_][\p{L}\p{N}_\s]+?):", r"^\[([0-9]{1,2}:[0-9]{2}:[0-9]{2})\]\s+([\p{L}\p{N}_][\p{L}\p{N}_\s]+?):\s*(.*)"),
    "speaker_only": (r"^([A-Z][\p{L}\p{N}_]+(?:\s+[A-Z][\p{L}\p{N}_]+)*)\s*:\s+\S", r"^([A-Z][\p{L}\p{N}_]+(?:\s+[A-Z][\p{L}\p{N}_]+)*)\s*:\s+(.*)"),
}

# How the closing matter of a published interview begins.
END_MATTER = ["You can listen to this conversation by following", "This episode of", "The Times is committed", "Follow the New York Times"]

# White space as in Unicode, as a character class that Java and RE2 read alike.
SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_WORD = r"[^\p{L}\p{N}_]"

CHUNK_WORDS, CONTEXT_WORDS, CLUSTER_DIFFS, INTRO_WORDS, NLP_TOKEN_SECONDS = 500, 30, 50, 500, 0.3
