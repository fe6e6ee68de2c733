"""Interfaces to what looks at pictures, and deterministic stand-ins, so that everything behind them runs without models."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import NamedTuple, Protocol

import numpy as np

Box = tuple[int, int, int, int]


class Block(NamedTuple):
    x: int
    y: int
    w: int
    h: int
    conf: float
    text: str


class ImageReader(Protocol):
    def decode(self, content: bytes) -> np.ndarray: ...  # height x width x 3, BGR


class OcrEngine(Protocol):
    def blocks(self, picture: np.ndarray) -> list[Block]: ...


class Model(Protocol):
    def ask(self, prompt: str, image: bytes | None = None) -> str: ...


class ReportReader(Protocol):
    def text(self, content: bytes) -> str: ...  # of a PDF


class StubReader:
    """Pictures in a plain form: a line of JSON with width and height, then text lines 'x y w h text'."""

    def decode(self, content: bytes) -> np.ndarray:
        head = json.loads(content.split(b"\n", 1)[0] or b"{}")
        return np.full((int(head.get("height", 1600)), int(head.get("width", 800)), 3), 255, np.uint8)

    def lines(self, content: bytes) -> list[Block]:
        rows = [r.split(" ", 4) for r in content.decode("utf-8").split("\n")[1:] if r.strip()]
        return [Block(*map(int, r[:4]), 1.0, r[4]) for r in rows if len(r) == 5]


class StubModel:
    """Answers from a table of prompts' key words; the same question always has the same answer."""

    def __init__(self, answers: dict[str, str] | None = None):
        self.answers = answers or {}

    def ask(self, prompt: str, image: bytes | None = None) -> str:
        for key, answer in self.answers.items():
            if key in prompt:
                return answer
        return ""

    def digest(self, prompt: str) -> str:
        return hashlib.sha1(prompt.encode()).hexdigest()


def ask_with_image(model: Model, prompt: str, image: bytes) -> str:
    """With the picture; if that fails, once more by text alone."""
    try:
        return model.ask(prompt, image)
    except Exception as e:  # any client error: the text still holds most of the evidence
        print(f"[WARN] asking without the picture: {e}")
        return model.ask(prompt)


def tagged(screens: list[list[tuple[str, Block]]]) -> str:
    """Blocks as tagged text, screens numbered from 1."""
    out = []
    for k, blocks in enumerate(screens, 1):
        out.append(f"[SCREEN {k}]")
        out += [f"[BLOCK {n}] [POS={pos}] [X={b.x}] [Y={b.y}] [W={b.w}] [H={b.h}] [CONF={b.conf:.2f}] {b.text}" for n, (pos, b) in enumerate(blocks, 1)]
    return "\n".join(out)


def on_executors(make: Callable[[], Model]) -> Callable[[], Model]:
    """A model made once in each worker process."""
    held: list[Model] = []

    def get() -> Model:
        if not held:
            held.append(make())
        return held[0]

    return get
