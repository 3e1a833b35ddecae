"""Standard column names, worked out from the schema alone."""

from __future__ import annotations

import re

from tidemark.functions.text import latin_ascii_name


def snake_words(name: str) -> list[str]:
    text = name.replace("'", "").replace('"', "")
    text = text.replace("%", " percent ").replace("#", " number ")
    text = latin_ascii_name(text)
    text = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", text)
    text = re.sub(r"(?<=[A-Z])(?=[A-Z][a-z])", " ", text)
    return [w.lower() for w in re.split(r"[^0-9A-Za-z]+", text) if w]


def _spell(words: list[str], case: str) -> str:
    if case == "snake":
        return "_".join(words)
    if case == "screaming_snake":
        return "_".join(words).upper()
    camel = "".join(w.capitalize() for w in words)
    if case == "upper_camel":
        return camel
    if case == "lower_camel":
        return camel[:1].lower() + camel[1:]
    raise ValueError(f"unknown case {case!r}")


def normalize_names(names: list[str], case: str = "snake") -> list[str]:
    """One clean, unique name per input name, in the same order."""
    taken: set[str] = set()
    result = []
    for name in names:
        base = _spell(snake_words(name), case) or "x"
        if base[0].isdigit():
            base = "x" + base
        unique, n = base, 1
        while unique in taken:
            n += 1
            unique = f"{base}_{n}"
        taken.add(unique)
        result.append(unique)
    return result
