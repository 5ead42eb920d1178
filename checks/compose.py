"""Puts a checking query together from named building blocks.

A block is the text of one common table expression. A query names the blocks it
reads; those, and what they read in turn, are put in front of it. A block may
read itself.
"""

from __future__ import annotations

import re


def with_blocks(body: str, blocks: dict[str, str]) -> str:
    names = sorted(blocks, key=len, reverse=True)
    pattern = re.compile(r"\b(" + "|".join(map(re.escape, names)) + r")\b")
    ordered: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for name in dict.fromkeys(pattern.findall(text)):
            if name not in ordered and name != own:
                visit(blocks[name], name)
                ordered.append(name)

    visit(body)
    if not ordered:
        return body
    parts = ",\n".join(f"{name} as (\n{blocks[name].strip()}\n)" for name in ordered)
    return f"with recursive {parts}\n{body.strip()}"
