"""Porter stemming with the customary extensions, for the ROUGE-L words.

Small rule tables and one function per step; words come lower-cased and ASCII.
"""

from __future__ import annotations

import re

# Irregular words and the rule tables of the published algorithm.
_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
_STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"),
    ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
]
_STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
]
_STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize",
]


def _shape(word: str) -> str:
    """'c' and 'v' per letter; y is a vowel after a consonant."""
    out: list[str] = []
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and bool(out) and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _short_end(word: str) -> bool:
    shape = _shape(word)
    if len(word) == 2:
        return shape == "vc"
    return shape.endswith("cvc") and word[-1] not in "wxy"


def _double_end(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    cut = 2 if word.endswith("ed") else 3 if word.endswith("ing") else 0
    stem = word[:-cut] if cut else word
    if not cut or "v" not in _shape(stem):
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double_end(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem


def _final_y(word: str) -> str:
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        return word[:-1] + "i"
    return word


def _first_rule(word: str, rules: list[tuple[str, str]]) -> str:
    for ending, new in rules:
        if word.endswith(ending):
            stem = word[: -len(ending)]
            return stem + new if _measure(stem) > 0 else word
    return word


def _double_suffix(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _double_suffix(word[:-2])
    if word.endswith("logi") and not any(word.endswith(e) for e, _ in _STEP2):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _first_rule(word, _STEP2)


def _long_suffix(word: str) -> str:
    for ending in _STEP4:
        if word.endswith(ending):
            stem = word[: -len(ending)]
            allowed = _measure(stem) > 1 and (ending != "ion" or stem[-1] in "st")
            return stem if allowed else word
    return word


def _final_e(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _short_end(stem)):
            word = stem
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def stem(word: str) -> str:
    if word in _IRREGULAR:
        return _IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _double_suffix):
        word = step(word)
    return _final_e(_long_suffix(_first_rule(word, _STEP3)))
