"""Fixed values and character classes.

Every regular expression here is written in the common subset of Java regex
(Spark) and RE2 (DuckDB, used by the SQL oracle), so both engines read the same
spelling.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Character classes (fixed values)
# ---------------------------------------------------------------------------

# Python's str whitespace in the BMP: \t \n \v \f \r, U+001C..U+001F, space,
# U+0085 and the Unicode separators (Zs, Zl, Zp).
WS = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}"
# Python's str \w: letters, numbers, underscore.
WORD = r"\p{L}\p{N}_"
# The Arabic block kept by the symbol filter.
ARABIC_BLOCK = r"\x{0600}-\x{06FF}"

TAG_RE = r"<[^\n]*?>"                      # '<.*?>' where '.' excludes only '\n'
URL_RE = rf"http[^{WS}]+"                  # 'http\S+'
SYMBOL_RE = rf"[^{WORD}{WS}{ARABIC_BLOCK}]"  # '[^\w\s؀-ۿ]'
WS_RUN_RE = rf"[{WS}]+"                    # '\s+'
NON_BLANK_RE = rf"[^{WS}]"                 # text.strip() != ''
TERM_RE = rf"[{WORD}]{{2,}}"               # '\b\w\w+\b' on lower-cased text

# Arabic diacritics removed by the optional Arabic normaliser: tanween, short
# vowels, shadda, sukun (U+064B..U+0652), superscript alef (U+0670), tatweel (U+0640).
ARABIC_DIACRITICS_RE = r"[\x{064B}-\x{0652}\x{0670}\x{0640}]"
# Arabic tokeniser: runs of word characters and marks, or single punctuation marks.
ARABIC_TOKEN_RE = r"[\p{L}\p{N}\p{M}_]+|[^\p{L}\p{N}\p{M}_\s]"

# Word-tokeniser contractions (fixed values): pairs split into two tokens when
# they form a whole word, case-insensitively. The last one only splits when a
# blank (or the end of the text) follows.
CONTRACTIONS = [
    ("can", "not"),
    ("gim", "me"),
    ("gon", "na"),
    ("got", "ta"),
    ("lem", "me"),
    ("wan", "na"),
]

# ---------------------------------------------------------------------------
# Stop-word lists (fixed values)
# ---------------------------------------------------------------------------

# English list used for every language other than Arabic, in its natural order.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Our own short Arabic list (no reference list is available to check against).
ARABIC_STOPWORDS = """
في من على إلى عن مع هذا هذه ذلك تلك التي الذي الذين هو هي هم نحن أنا أنت
كان كانت يكون قد لقد لا لم لن ما ماذا متى أين كيف ثم أو أم بل لكن إن أن
كل بعض غير بين حتى إذا عند منذ أي
""".split()

# ---------------------------------------------------------------------------
# Defaults of the reference's options (fixed values)
# ---------------------------------------------------------------------------
TARGET_LANGUAGES = ["ar", "en"]
QUOTA_PER_LANGUAGE = 150
PAGE_SIZE = 50
MAX_FEATURES = 5000
SPLIT_SEED = 42
SPLIT_CUTS = (0.7, 0.85)
EPOCHS = 2
SENTINEL_EMPTY = "EMPTY"
SENTINEL_ERROR = "ERROR"
