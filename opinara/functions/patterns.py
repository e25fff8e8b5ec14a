"""Character classes shared by the text functions (Java regex syntax).

``\\w`` and ``\\s`` differ between regex engines, so the classes are spelled out.
"""

WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
CJK = r"\u4e00-\u9fff"
EMOJI = r"\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}"
PUNCTUATION = ".,!?，。！？"

_KEPT = rf"{WORD}{CJK}{PUNCTUATION}"

BRACKETED = r"\[[^\[\]\n]*\]"
# A look-ahead on the few possible first characters rejects most positions at once.
NOISE = (
    rf"(?d)(?=[h@【《<{EMOJI}])"
    rf"(?:http[^{SPACE}]+|@[{WORD}]+|【.*?】|《.*?》|<.*?>|[{EMOJI}]+)"
)
# Cheap signs without which NOISE cannot match.
NOISE_MARKS = ("http", "@", "【", "《", "<")
NOISE_SYMBOLS = r"[\x{1F300}-\x{1F6FF}]"
# Runs to replace by one blank; a single blank between words is left alone.
NOT_KEPT = rf"[^{_KEPT} ][^{_KEPT}]*+| [^{_KEPT}]++"

LATIN_WORD = r"[A-Za-z]{2,}"
TWO_LATIN_WORDS = r"(?s)[A-Za-z]{2}[^A-Za-z].*?[A-Za-z]{2}"
# Eight letters that have a letter next to them; atomic, so it stops early and never backtracks.
EIGHT_LATIN_LETTERS = r"(?s)^(?>.*?(?:[A-Za-z](?=[A-Za-z])|(?<=[A-Za-z])[A-Za-z])){8}"
TWO_CJK = rf"(?s)[{CJK}].*?[{CJK}]"
# From the first to the last letter of a run: outer quotes and hyphens are trimmed,
# and words of one or two letters do not match.
ENGLISH_TOKEN = r"[a-z][a-z'\-]+[a-z]"
LEXICON_WORD = r"[a-z][a-z'\-]*"
PLAIN_ENGLISH = rf"""\A[a-zA-Z{SPACE}\p{{Nd}}.,!?;:'"()\-_/]+\z"""

LINE_BREAK = r"[\n\x0B\f\r\x1c-\x1e\x85\x{2028}\x{2029}]"
CLOCK = r"\p{Nd}{1,2}[:：]\p{Nd}{2}"


def quote(word: str) -> str:
    """The word as a literal piece of a regex."""
    return "".join(ch if ch.isalnum() or ch == "_" or ord(ch) > 127 else "\\" + ch for ch in word)


def any_of(words) -> str:
    """Alternation that finds any of the words, longest first."""
    ordered = sorted(dict.fromkeys(words), key=lambda w: (-len(w), w))
    return "|".join(quote(w) for w in ordered)
