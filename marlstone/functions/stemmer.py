"""The English (Porter2) stemmer, from its published description, and a stop-word list."""

from __future__ import annotations

from functools import lru_cache

_VOWELS = "aeiouy"
_DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
_LI = "cdeghkmnrt"

# Words with a stem of their own.
_SPECIAL = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"}
_KEPT = frozenset("sky news howe atlas cosmos bias andes".split())
_KEPT_AFTER_1A = frozenset("inning outing canning herring earring proceed exceed succeed".split())

# Suffixes and what they become.
_STEP_2 = [("ization", "ize"), ("ational", "ate"), ("ousness", "ous"), ("iveness", "ive"), ("fulness", "ful"), ("tional", "tion"), ("lessli", "less"), ("biliti", "ble"), ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("fulli", "ful"), ("ousli", "ous"), ("iviti", "ive"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", "")]
_STEP_3 = [("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", "")]
_STEP_4 = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion", "al", "er", "ic"]

# English stop words.
STOP_WORDS = frozenset(
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs themselves what which who whom this that these those am is are was were be been being have has had having do does did doing a an the and but if or because as until while of at by for with about against between into through during before after above below to from up down in out on off over under again further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very s t can will just don should now".split()
)


def _regions(w: str) -> tuple[int, int]:
    def after(start: int) -> int:
        for i in range(start + 1, len(w)):
            if w[i] not in _VOWELS and w[i - 1] in _VOWELS:
                return i + 1
        return len(w)

    first = next((len(p) for p in ("gener", "commun", "arsen") if w.startswith(p)), None)
    r1 = first if first is not None else after(0)
    return r1, after(r1)


def _short_end(w: str) -> bool:
    if len(w) == 2:
        return w[0] in _VOWELS and w[1] not in _VOWELS
    return len(w) > 2 and w[-1] not in _VOWELS + "wxY" and w[-2] in _VOWELS and w[-3] not in _VOWELS


def _has_vowel(w: str) -> bool:
    return any(c in _VOWELS for c in w)


@lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    """The stem of a lower-case word."""
    if len(word) < 3:
        return word
    if word in _SPECIAL:
        return _SPECIAL[word]
    if word in _KEPT:
        return word
    w = word.lstrip("'") if word.startswith("'") else word
    w = "".join("Y" if c == "y" and (i == 0 or w[i - 1] in _VOWELS) else c for i, c in enumerate(w))
    r1, r2 = _regions(w)
    w = next((w[: -len(s)] for s in ("'s'", "'s", "'") if w.endswith(s)), w)
    # plurals
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and _has_vowel(w[:-2]):
        w = w[:-1]
    if w in _KEPT_AFTER_1A:
        return w
    # past tense and participles
    for s in ("eedly", "eed", "ingly", "edly", "ing", "ed"):
        if w.endswith(s):
            if s.startswith("eed"):
                w = w[: -len(s)] + "ee" if len(w) - len(s) >= r1 else w
            elif _has_vowel(w[: -len(s)]):
                w = w[: -len(s)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif w.endswith(_DOUBLES):
                    w = w[:-1]
                elif _short_end(w) and r1 >= len(w):
                    w += "e"
            break
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _VOWELS:
        w = w[:-1] + "i"
    for s, to in _STEP_2:
        if w.endswith(s):
            if len(w) - len(s) >= r1 and (s != "ogi" or w[-4:-3] == "l") and (s != "li" or w[-3:-2] in tuple(_LI)):
                w = w[: -len(s)] + to
            break
    for s, to in _STEP_3:
        if w.endswith(s):
            if len(w) - len(s) >= (r2 if s == "ative" else r1):
                w = w[: -len(s)] + to
            break
    for s in _STEP_4:
        if w.endswith(s):
            if len(w) - len(s) >= r2 and (s != "ion" or w[-4:-3] in ("s", "t")):
                w = w[: -len(s)]
            break
    if w.endswith("e") and (len(w) - 1 >= r2 or len(w) - 1 >= r1 and not _short_end(w[:-1])):
        w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.lower()
