r"""Wikitext math as TeX.

The text is read once into a tree of templates and of sub- and superscript
tags; what is inside is rendered before what holds it, by tables of names. So
nothing depends on the order of rules, templates may hold each other and
themselves, and what was written as TeX or stands in brackets is left alone.
"""

from __future__ import annotations

import re

#: Templates that only set their content, and those that put something around it.
PLAIN = ("var", "nobreak", "nowrap", "mvar", "linktext", "em", "italics correction", "math")
AROUND = {
    "overline": (r"\overline{", "}"), "overbar": (r"\overbar{", "}"), "overarc": (r"\overarc{", "}"), "radic": (r"\sqrt{", "}"), "radical": (r"\sqrt{", "}"), "sqrt": (r"\sqrt{", "}"),
    "prime": ("", "'"), "′": ("", "'"), "mathcal": (r"\mathcal{", "}"), "mathbb": (r"\mathbb{", "}"), "strong": (r"\mathbf{", "}"), "ceil": (r"\ceil{", "}"), "floor": (r"\floor{", "}"),
    "norm": (r"\|", r"\|"), "abs": ("|", "|"), "mabs": ("|", "|"), "mset": (r"\{", r"\}"), "brace": (r"\{", r"\}"), "bra": (r"\langle ", "|"), "ket": ("|", r"\rangle "),
    "angle bracket": (r"\langle ", r"\rangle "), "anglebracket": (r"\langle ", r"\rangle "), "open-closed": ("(", "]"), "open-open": ("(", ")"), "closed-closed": ("[", "]"), "closed-open": ("[", ")"),
    "sup": ("^{", "}"), "sub": ("_{", "}"), "vec": (r"\vec{", "}"), "hat": (r"\hat{", "}"),
}
FRACTIONS = ("frac", "sfrac", "fract", "fraction", "fract/sandbox", "fraction/sandbox", "sfrac/sandbox")
#: Templates that stand for a character or a symbol.
SYMBOLS = {
    "=": "=", "!": "|", "(": "(", ")": ")", "phi": r"\phi", "delta": r"\delta", "pi": r"\pi", "gamma": r"\gamma", "epsilon": r"\epsilon", "sigma": r"\sigma", "theta": r"\theta",
    "varepsilon": r"\epsilon", "varphi": r"\phi", "varsigma": r"\sigma", "vartheta": r"\theta", "ell": r"\ell",
}
#: Characters that TeX writes as a macro.
CHARACTERS = {"×": r"\times", "÷": r"\div", "±": r"\pm", "≤": r"\leq", "≥": r"\geq", "≠": r"\neq", "≈": r"\approx", "∞": r"\infty", "π": r"\pi", "∑": r"\sum", "∫": r"\int", "√": r"\sqrt", "→": r"\to", "∈": r"\in", "∂": r"\partial"}
TAGS = {"sub": ("_{", "}"), "sup": ("^{", "}")}
_TOKEN = re.compile(r"\{\{|\}\}|</?su[bp]>|<nowiki>(=|\|+)</nowiki>", re.I)


class _Open:
    """Something that has been opened: its mark, and what is inside so far; ``cuts`` are the places of its own bars."""

    def __init__(self, mark: str) -> None:
        self.mark, self.parts, self.cuts = mark, [], []

    def add(self, text: str, own: bool) -> None:
        """own: text of this level, in which bars part the arguments."""
        pieces = text.split("|") if own and self.mark == "{{" else [text]
        for k, piece in enumerate(pieces):
            if k:
                self.cuts.append(len(self.parts))
            self.parts.append(piece)

    def arguments(self) -> list[str]:
        edges = [0, *self.cuts, len(self.parts)]
        return ["".join(self.parts[a:z]) for a, z in zip(edges, edges[1:])]


def _template(node: _Open) -> str:
    name, *args = node.arguments()
    key = " ".join(name.lower().split())
    if not args and key in SYMBOLS:
        return SYMBOLS[key]
    bare = [re.sub(r"^\s*[12]\s*=(?!=)", "", a) for a in args]
    if args and key in PLAIN:
        return "|".join(bare)
    if args and key in AROUND:
        start, end = AROUND[key]
        return start + "|".join(bare).strip() + end
    if args and key in FRACTIONS:
        over = [a.strip() for a in bare]
        if len(over) == 1:
            return rf"\frac{{1}}{{{over[0]}}}"
        return (over[0] if len(over) > 2 else "") + rf"\frac{{{over[-2]}}}{{{over[-1]}}}"
    return "{{" + "|".join([name, *args]) + "}}"


def to_tex(text: str) -> str:
    """Math templates, tags and characters as TeX; other templates stay, and so does what is never closed."""
    stack = [_Open("")]
    at = 0
    for m in _TOKEN.finditer(text):
        stack[-1].add(text[at : m.start()], True)
        at, mark = m.end(), m[0].lower()
        if m[1]:
            stack[-1].add(m[1], False)
        elif mark == "{{" or mark in ("<sub>", "<sup>"):
            stack.append(_Open(mark))
        else:
            opened = "{{" if mark == "}}" else "<" + mark[2:]
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].mark == opened), 0)
            if not depth:
                stack[-1].add(m[0], False)
                continue
            while len(stack) > depth + 1:  # opened inside and never closed
                _spill(stack)
            node = stack.pop()
            if opened == "{{":
                stack[-1].add(_template(node), False)
            else:
                start, end = TAGS[opened[1:-1]]
                stack[-1].add(start + "|".join(node.arguments()) + end, False)
    stack[-1].add(text[at:], True)
    while len(stack) > 1:
        _spill(stack)
    out = "|".join(stack[0].arguments())
    for symbol, macro in CHARACTERS.items():
        out = out.replace(symbol, macro + " ")
    return out.strip()


def _spill(stack: list[_Open]) -> None:
    node = stack.pop()
    stack[-1].add(node.mark + "|".join(node.arguments()), False)


_MATH = re.compile(r'<math(?: display="?(inline|block)"?)?>|(</math>)', re.I)


def math_tags(text: str) -> str:
    """<math> as $$...$$, and display=inline as $...$ with a space behind; a tag within another belongs to its text, and what is never closed stays."""
    out, at, opened = [], 0, []
    for m in _MATH.finditer(text):
        if not m[2]:
            opened.append(m)
        elif opened:
            first = opened.pop()
            if not opened:
                inline = (first[1] or "").lower() == "inline"
                out += [text[at : first.start()], "$" if inline else "$$", text[first.end() : m.start()], "$ " if inline else "$$"]
                at = m.end()
    return "".join(out) + text[at:]
