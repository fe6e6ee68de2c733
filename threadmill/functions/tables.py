"""Values that decide results: word lists, patterns and rewrite rules, shared by column and plain-text functions."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, functions as F


class Rule(NamedTuple):
    """A rewrite: pattern and replacement in Python's notation (groups as \\1). literal: what the pattern stands for, if it is plain text."""

    pattern: str
    replacement: str
    fold_case: bool = False
    literal: str | None = None


def _java(pattern: str, fold_case: bool = False) -> str:
    """Java's classes are ASCII unless told otherwise; Python's are Unicode."""
    return ("(?iU)" if fold_case else "(?U)") + pattern


def rewritten(value: Column, rules: list[Rule]) -> Column:
    for r in rules:
        if r.literal is not None:
            value = F.replace(value, F.lit(r.literal), F.lit(r.replacement))
            continue
        replacement = re.sub(r"\\(\d)", r"$\1", r.replacement.replace("$", r"\$"))
        value = F.regexp_replace(value, _java(r.pattern, r.fold_case), replacement)
    return value


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value computed once however often f uses it; expressions that are copied into branches grow with each step."""
    return F.element_at(F.transform(F.array(value), f), 1)


def rewritten_if_any(value: Column, rules: list[Rule]) -> Column:
    """rewritten(), tried only where one of the patterns is found: where none is, no rule changes anything."""
    some = "|".join(f"(?i:{r.pattern})" if r.fold_case else f"(?:{r.pattern})" for r in rules)
    return bound(value, lambda v: F.when(v.rlike("(?U)" + some), rewritten(v, rules)).otherwise(v))


def found(value: Column, pattern: str, fold_case: bool = False) -> Column:
    return value.rlike(_java(pattern, fold_case))


def rewrite(text: str, rules: list[Rule]) -> str:
    for r in rules:
        text = re.sub(r.pattern, r.replacement, text, flags=re.IGNORECASE if r.fold_case else 0)
    return text


def _literal(old: str, new: str) -> Rule:
    return Rule(re.escape(old), new, literal=old)


# ---- Fixed values: these must stay as they are for results to agree. ----

#: Overlaps of words from which a bubble tells a row's side, is its text, is it in the same minute, covers it, or gives it its place.
SAME_SIDE, SAME_TEXT, SAME_MINUTE, COVERED, MATCHED = 0.72, 0.86, 0.66, 0.62, 0.48
#: Misreadings that mark a broken message, and words that stand where none of them can.
BROKEN = r"\b(?:I{2}l|1['’]?ll|Ijust|Iwill|Icant|yoU|sO)\b"
MISPLACED = r"\b(they|can|the|and|but)\s+(The|I|I'm|I'll|You|We|They)\b"
#: A long message, and what in it begins a sentence of its own.
LONG, RUN_ON = 220, r"[.!?].+\b(I|You|We|They|Please|Thank|The|There)\b"
CLOCK_SHAPE = r"\b\d{1,2}[:.,;]\d{2}\b"

IMAGE_EXTENSIONS = (".png", ".jpg", ".jpeg", ".webp", ".bmp", ".tif", ".tiff")
REPORT_EXTENSIONS = (".pdf", ".txt")
IGNORED_DIRS = ("__macosx", ".git", ".svn", ".hg", "node_modules", "__pycache__")

MONTHS = "Jan|January|Feb|February|Mar|March|Apr|April|May|Jun|June|Jul|July|Aug|August|Sep|Sept|September|Oct|October|Nov|November|Dec|December"
MONTH_NUMBERS = {"jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12}
CLOCK = r"(?<![A-Za-z0-9])\d{1,2}[:.,;]\d{2}(?![A-Za-z0-9])"
TICKS = r"\s*(vi|v|✓|✔|✔✔)+\s*$"
EMOJI = "[\U0001f1e6-\U0001f1ff\U0001f300-\U0001f5ff\U0001f600-\U0001f64f\U0001f680-\U0001f6ff\U0001f700-\U0001f77f\U0001f780-\U0001f7ff\U0001f800-\U0001f8ff\U0001f900-\U0001f9ff\U0001fa00-\U0001faff\u2600-\u26ff\u2700-\u27bf]+"

UI_FACEBOOK = (
    "active now", "messenger", "facebook", "you're friends on facebook", "you are friends on facebook", "wave to", "say hi",
    "sent", "delivered", "seen", "typing", "search conversation", "view profile", "voice call", "video call", "missed call",
    "started a call", "changed the chat", "end-to-end encrypted", "end-to-end encryption", "messages and calls are secured",
    "message...", "type a message", "write a message", "aa",
)
UI_VIBER = ("type a message", "messages in this chat are private", "end-to-end encryption", "learn more", "active now", "delivered", "seen", "typing")
ICONS_FACEBOOK = "like|thumbs up|gif|sticker|photo|camera|mic|microphone|send"
ICONS_VIBER = "gif|gıf|g1f"

NOISE = (r"\bTII\w*\b", r"\bI{2}l\b", r"\b1['’]?I[lI]\b", r"\bJi00\b", r"\$", r"\|", r"__", r"=", r"\byoU\b", r"\bsO\b")
FRAGMENT_STARTS = ("and", "but", "because", "so", "that", "which", "with", "without", "for", "to", "of", "in", "on", "at", "by", "from", "as", "than", "my", "your", "our", "their", "the", "a", "an", "there", "then", "right")
CONTINUATION_STARTS = ("and", "but", "because", "so", "that", "which", "with", "without", "for", "to", "of", "in", "on", "at", "by", "from", "as", "than", "my", "your", "our", "their", "the", "a", "an", "better")
LABELS = "name|country|city|option|account|iban|reference|mtcn|phone|email|amount|details|receiver|sender|beneficiary|bank|address|code|number|date|time"
_VERBS = (
    "am|was|will|can|can't|cannot|need|have|think|feel|want|would|could|should|do|don't|dont|love|trust|promise|know|hope|wish|believe|already|"
    "just|may|must|might|see|ask|tell|try|send|keep|call|go|complete|look|admire"
)
#: What follows an I that is glued to it, and what it is then.
GLUED = {
    "just": "just", "will": "will", "need": "need", "love": "love", "may": "may", "feel": "feel", "already": "already", "cant": "can't", "can't": "can't",
    "can": "can", "have": "have", "think": "think", "want": "want", "would": "would", "could": "could", "should": "should", "promise": "promise",
    "believe": "believe", "hope": "hope", "see": "see",
}

SPACES = [Rule(r"\s+", " "), Rule(r"^ | $", "")]
TRIM = [Rule(r"^\s+|\s+$", "")]
QUOTES = [Rule("[“”]", '"'), Rule("[‘’]", "'")]
PUNCTUATION = [Rule(r"\s+([,.;:!?])", r"\1"), Rule(r"([,.;:!?])(?=[A-Za-z])", r"\1 ")]

#: Cleaning of a message, first part, in order: the start, glued words, contractions and misread words, marks.
CLEAN_START = [
    *TRIM,
    _literal('\\"', '"'),
    *QUOTES,
    Rule("[\u200b\ufeff]", " "),
    Rule(CLOCK, " "),
    *SPACES,
    Rule(rf"(^|[\s,.;:!?])\|\s+({_VERBS})\b", r"\1I \2", True),
]
CLEAN_GLUED = [Rule(rf"\bI{re.escape(w)}\b", f"I {to}", True) for w, to in GLUED.items()]
CLEAN_CONTRACTED = [
    Rule(r"\bI\s*m\b", "I'm", True),
    Rule(r"\bIm\b", "I'm"),
    Rule(r"\bTm\b", "I'm"),
    Rule(r"\bI\s*ve\b", "I've", True),
    Rule(r"\bFve\b", "I've"),
    Rule(r"\bI\s*ll\b", "I'll", True),
    Rule(r"\bIll\b", "I'll"),
    Rule(r"\bIIl\b", "I'll"),
    Rule(r"\b1['’]?I[lI]\b", "I'll"),
    Rule(r"\b1['’]?ll\b", "I'll", True),
    Rule(r"\bTII\s*keep\b", "I'll keep", True),
]
CLEAN_DOLLARS = [
    Rule(r"\b([A-Za-z]+)'\$\b", r"\1's"),
    Rule(r"\bit\$\b", "it's", True),
    Rule(r"\bthat\$\b", "that's", True),
]
CLEAN_QUOTED = [
    Rule(r'\b([Ii])t\s*["]+\s*s\b', "It's"),
    Rule(r'\b([Tt])hat\s*["]+\s*s\b', "That's"),
    Rule(r'\b([Dd])on\s*["]+\s*t\b', "don't"),
    Rule(r'\b([Cc])an\s*["]+\s*t\b', "can't"),
]
CLEAN_WORDS = [
    Rule(r"\bIcant\b", "I can't", True),
    Rule(r"\bIcan't\b", "I can't", True),
    Rule(r"\bdont\b", "don't", True),
    Rule(r"\byoure\b", "you're", True),
    Rule(r"\bthats\b", "that's", True),
    Rule(r"\bits\b", "it's"),
]
CLEAN_MISREAD = [
    Rule(r"\bsO\b", "so"),
    Rule(r"\byoU\b", "you"),
    Rule(r"\bJi00\b", "I"),
    Rule(r"\bIı\b", "I"),
]
CLEAN_MARKS = [_literal("=", " "), _literal("__", "..."), _literal("_", "")]
CLEAN = [*CLEAN_START, *CLEAN_GLUED, *CLEAN_CONTRACTED, *CLEAN_DOLLARS, *CLEAN_QUOTED, *CLEAN_WORDS, *CLEAN_MISREAD, *CLEAN_MARKS]
#: Second part, where no label of LABELS stands before a colon.
CLEAN_UNLABELLED = [
    Rule(r";\s+(?=(I|I'm|I'll|you|we|it|that|this|the|they|there|but|and|more|please|thank)\b)", ", ", True),
    Rule(r":\s+(?=(I|I'm|I'll|you|we|it|that|this|the|they|there|but|and|because|so|please|thank)\b)", ". ", True),
]
#: Third part.
CLEAN_END = [_literal(":-", "..."), Rule(r"\.{4,}", "..."), *SPACES, *PUNCTUATION, Rule(r"\s+\.\.\.", "...")]
#: Cleaning of merged transcript rows.
FINAL = [*TRIM, *QUOTES, *SPACES, *PUNCTUATION]
GUARD = [
    Rule(r"\bim\b", "i am"), Rule(r"\bi'm\b", "i am"), Rule(r"\bcant\b", "can not"), Rule(r"\bcan't\b", "can not"), Rule(r"\bdont\b", "do not"), Rule(r"\bdon't\b", "do not"),
    Rule(r"\byoure\b", "you are"), Rule(r"\byou're\b", "you are"), Rule(r"\bthats\b", "that is"), Rule(r"\bthat's\b", "that is"),
]
ARTIFACTS = (r"\bI{2}l\b", r"\b1['’]?I[lI]\b", r"\bTII\b", r"\bJi00\b", r"\bIcant\b", r"\bIcan't\b", r"\bIjust\b", r"\bIwill\b", r"\bIlove\b", r"\byoU\b", r"\bsO\b", r"\|", r"__", r"=", CLOCK)
#: Pattern and what each hit adds to the artifact penalty.
ARTIFACT_WEIGHTS = [*[(p, 2.0) for p in ARTIFACTS], (r"\s+[,.;:!?]", 1.0), (r"[,.;:!?](?=[A-Za-z])", 0.5), (r"\.{4,}", 1.0), (r"[!?]{3,}", 1.0)]

REPORT_NAME_SCORES = ((r"cases?[_\s-]*overview", 100), ("overview", 60), ("allegation|initial", 45), ("case", 35), ("report", 30), ("complaint|complainant|victim", 25), ("statement", 15))
REPORT_NOISE = ("log", "ground_truth", "groundtruth", "accuracy", "result", "output", "debug", "extracted", "merged", "transcript")
FACEBOOK_PATHS, VIBER_PATHS = ("facebook", "messenger", "fb_", "/fb/", "/facebook/", "/messenger/"), ("viber", "/viber/")
PLATFORM_NAMES = {"facebook": ("facebook", "messenger", "facebook_messenger", "fb"), "viber": ("viber",), "non_chat": ("non_chat", "not_chat", "no_chat", "other", "irrelevant", "not_a_chat")}

VICTIM_PATTERNS = (r"VICTIM\s*/\s*COMPLAINANT:.*?Full Name:\s*([^\n\r•]+)", r"Full Name:\s*([^\n\r•]+)", r"Target/Victim:\s*([^\n\r•]+)")
SUSPECT = r"Suspect\s*\d+:\s*([^\n\r]+)(.*?)(?=(?:•\s*)?Suspect\s*\d+:|2\.\s*BACKGROUND|3\.\s*TECHNICAL|$)"
ALIASES = r"Scammer Names Used:\s*([^\n\r]+)"
REPORT_PHONE, ROW_PHONE = r"\+\d[\d\s().-]{5,}\d", r"\+?\d[\d\s().-]{5,}\d"
TIME_FORMATS = ("d/M/yyyy H:m", "d/M/yyyy, H:m", "d/M/yyyy,H:m")
FULL_TIME = r"\d{2}/\d{2}/\d{4}\s+\d{2}:\d{2}"
BLOCK = r"\[BLOCK\s+(\d+)\]\s+\[POS=(LEFT|RIGHT|CENTER)\]\s+\[X=(\d+)\]\s+\[Y=(\d+)\]\s+\[W=(\d+)\]\s+\[H=(\d+)\](?:\s+\[CONF=[^\]]+\])?\s+(.*)$"
SCREEN = r"^\[SCREEN\s+(\d+)\]"

# ---- End of fixed values. ----
