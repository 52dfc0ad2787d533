"""Word lists, replacement tables and regular expressions.

The regular expressions spell out Unicode classes because Java's ``\\w``, ``\\s``
and ``\\b`` are ASCII-only by default.
"""

# Character classes (contents of a bracket expression).
WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x20\x{85}\p{Z}"

# Patterns over raw or lowercased text.  A match can only begin at
# the start of a word, and possessive quantifiers keep long words linear.
WORD_TOKEN = f"[{WORD}]+"
VECTOR_TOKEN = f"[{WORD}]{{2,}}"
HTML_TAG = r"<[^>]+>"
URL = f"https?://[^{SPACE}]+|www\\.[^{SPACE}]+"
EMAIL = f"(?<![{WORD}])[{WORD}][{WORD}.+-]*+@[{WORD}-]+\\.[{WORD}.-]*[{WORD}]"
DIGIT_TOKEN = f"(?<![{WORD}])[{WORD}&&[^\\p{{Nd}}]]*+\\p{{Nd}}[{WORD}]*+"
NOT_LETTER = f"[^a-z{SPACE}]"
LETTER_TOKEN = r"[a-z']+"
SYMBOL = f"[^{SPACE}{WORD}]"
PLACEHOLDER = r"\{[^}]+\}"
UPPERCASE = r"\p{Lu}"
DIGIT = r"[\p{Nd}\x{B2}\x{B3}\x{B9}\x{2070}-\x{2079}\x{2080}-\x{2089}]"
PUNCTUATION = f"[^\\p{{L}}\\p{{N}}{SPACE}]"
MIXED_TOKEN = (
    f"(?<![{WORD}])(?=[{WORD}&&[^\\p{{Nd}}]]*+\\p{{Nd}})(?=[{WORD}&&[^a-zA-Z]]*+[a-zA-Z])[{WORD}]++"
)
NON_SPACE_RUN = f"[^{SPACE}]+"

# Contractions, applied in this order.
CONTRACTIONS = (
    ("can't", "can not"),
    ("won't", "will not"),
    ("n't", " not"),
    ("'re", " are"),
    ("'ve", " have"),
    ("'ll", " will"),
    ("'d", " would"),
    ("'m", " am"),
    ("'s", " is"),
)

# Symbols that no morphology rule touches.
KEPT_SYMBOLS = ("!", "?", ".", ",", ":", ";", "#", "$", "%", "&", "*", "@")

# Web leftovers removed from the clustering view.
WEB_STOP_WORDS = ("nbsp", "http", "https", "www")

# The public 318-word English stop list.
ENGLISH_STOP_WORDS = tuple(
    """
a about above across after afterwards again against all almost alone along already also although always am
among amongst amoungst amount an and another any anyhow anyone anything anyway anywhere are around as at back
be became because become becomes becoming been before beforehand behind being below beside besides between
beyond bill both bottom but by call can cannot cant co con could couldnt cry de describe detail do done down
due during each eg eight either eleven else elsewhere empty enough etc even ever every everyone everything
everywhere except few fifteen fifty fill find fire first five for former formerly forty found four from front
full further get give go had has hasnt have he hence her here hereafter hereby herein hereupon hers herself
him himself his how however hundred i ie if in inc indeed interest into is it its itself keep last latter
latterly least less ltd made many may me meanwhile might mill mine more moreover most mostly move much must my
myself name namely neither never nevertheless next nine no nobody none noone nor not nothing now nowhere of
off often on once one only onto or other others otherwise our ours ourselves out over own part per perhaps
please put rather re same see seem seemed seeming seems serious several she should show side since sincere six
sixty so some somehow someone something sometime sometimes somewhere still such system take ten than that the
their them themselves then thence there thereafter thereby therefore therein thereupon these they thick thin
third this those though three through throughout thru thus to together too top toward towards twelve twenty
two un under until up upon us very via was we well were what whatever when whence whenever where whereafter
whereas whereby wherein whereupon wherever whether which while whither who whoever whole whom whose why will
with within without would yet you your yours yourself yourselves
    """.split()
)

# Names and order of the structural measures.
STRUCTURAL_FEATURES = (
    "char_count",
    "token_count",
    "average_token_length",
    "type_token_ratio",
    "repeated_token_ratio",
    "max_token_run",
    "lexical_entropy",
    "uppercase_ratio",
    "digit_ratio",
    "punctuation_ratio",
    "url_count",
    "email_count",
    "html_tag_count",
    "mixed_alnum_token_ratio",
    "placeholder_token_ratio",
    "bigram_type_token_ratio",
    "compression_ratio",
)

# Fixed value: keeps the entropy logarithms finite.
ENTROPY_EPSILON = 1e-9
