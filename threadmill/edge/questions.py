"""What models are asked, and how their answers are read. Answers are checked; a bad one counts as none."""

from __future__ import annotations

import json
import re

from ..functions import plain, tables as t

PLATFORMS = ("facebook", "viber", "non_chat")


def platform_question() -> str:
    return 'Which chat program is this picture from? Answer with JSON only: {"platform": "facebook", "viber" or "non_chat"}.'


def platform_answer(text: str) -> str:
    """The platform named in JSON, or else by a key word; unknown if none is."""
    try:
        named = str(json.loads(plain.json_part(text)).get("platform", ""))
    except (ValueError, AttributeError):
        named = ""
    key = named.strip().lower().translate(str.maketrans("- ", "__"))
    for p, names in t.PLATFORM_NAMES.items():
        if key in names:
            return p
    low = text.lower()
    return "facebook" if "facebook" in low or "messenger" in low else "viber" if "viber" in low else "non_chat" if "non_chat" in low or "not a chat" in low else "unknown"


def sides_question(evidence: str, people: list[str]) -> str:
    return f'Known people: {", ".join(people)}.\n{evidence}\nWho writes on the left, who on the right? Answer with JSON only: {{"LEFT": "...", "RIGHT": "..."}}.'


def sides_evidence(side: str, phones: list[str], texts: list[str]) -> str:
    return f"{side}: numbers {', '.join(phones) or 'none'}; texts {' | '.join(texts) or 'none'}"


def sides_answer(text: str) -> tuple[str, str]:
    """Left and right name; blank or equal names are an error."""
    data = json.loads(plain.json_part(text))
    left, right = (re.sub(r"\s*\([^)]*\)\s*$", "", plain.spaced(str(data.get(s, "")))).strip() for s in ("LEFT", "RIGHT"))
    if not left or not right or left.lower() == right.lower():
        raise ValueError(f"no two sides in the answer: {text[:80]!r}")
    return left, right


def date_question() -> str:
    return "Which date does the separator above the messages show? Answer as DD/MM/YYYY only, or NONE."


def date_answer(text: str) -> str:
    m = re.fullmatch(r"\s*(\d{2}/\d{2}/20\d{2})\s*", text)
    return m[1] if m else ""


def _known(image: str, screen: int, hints: str, allowed: list[str], visible_date: str) -> str:
    lines = [f"screen {screen} of {image}", f"date: {visible_date or 'not visible'}", f"visible times: {', '.join(allowed) or 'none'}", hints or "no bubbles known"]
    return "\n".join(lines)


def draft_question(image: str, screen: int, hints: str = "", allowed: list[str] | None = None, visible_date: str = "") -> str:
    return f"transcript of {_known(image, screen, hints, allowed or [], visible_date)}\nWrite CSV with Time,Side,Message, one row for each bubble; Side is LEFT or RIGHT; copy words as they stand."


def repair_question(image: str, screen: int, draft: str, hints: str = "", allowed: list[str] | None = None, visible_date: str = "") -> str:
    return f"repair of {_known(image, screen, hints, allowed or [], visible_date)}\nThese rows look broken. Read the picture again and write all rows anew, in the same form:\n{draft}"


def polish_question(image: str, screen: int, rows: str) -> str:
    return f"polish of screen {screen} of {image}\nCorrect misread letters and punctuation by the picture. Keep every row, its Time and its Side:\n{rows}"
