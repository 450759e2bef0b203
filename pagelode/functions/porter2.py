"""Snowball English (Porter2) stem of one word: the small per-value helper behind the stem column.

Tables and lists below are fixed values of the published algorithm.
"""

VOWELS = set("aeiouy")
REGION_PREFIXES = ["gener", "commun", "arsen"]
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
FINISHED = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
DOUBLES = ["bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"]
STEP2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism",
    "ate", "iti", "ous", "ive", "ize", "ion",
]


def _next_region(word, start):
    i = start
    while i < len(word) and word[i] not in VOWELS:
        i += 1
    while i < len(word) and word[i] in VOWELS:
        i += 1
    return min(i + 1, len(word)) if i < len(word) else len(word)


def _short_end(word):
    if len(word) == 2:
        return word[0] in VOWELS and word[1] not in VOWELS
    if len(word) < 2:
        return False
    a, b, c = word[-3], word[-2], word[-1]
    return a not in VOWELS and b in VOWELS and c not in VOWELS and c not in "wxY"


def _longest(word, table):
    hits = [s for s in table if word.endswith(s)]
    return max(hits, key=len) if hits else None


def stem(word):
    if len(word) < 3:
        return word
    if word in EXCEPTIONS:
        return EXCEPTIONS[word]
    if word[0] == "'":
        word = word[1:]
    chars = list(word)
    for i, ch in enumerate(chars):
        if ch == "y" and (i == 0 or chars[i - 1] in VOWELS):
            chars[i] = "Y"
    word = "".join(chars)
    r1 = next((len(p) for p in REGION_PREFIXES if word.startswith(p)), None)
    if r1 is None:
        r1 = _next_region(word, 0)
    r2 = _next_region(word, r1)

    for s in ("'s'", "'s", "'"):
        if word.endswith(s):
            word = word[: -len(s)]
            break
    s = _longest(word, ["sses", "ied", "ies", "us", "ss", "s"])
    if s == "sses":
        word = word[:-2]
    elif s in ("ied", "ies"):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif s == "s" and any(ch in VOWELS for ch in word[:-2]):
        word = word[:-1]
    if word in FINISHED:
        return word.replace("Y", "y")

    s = _longest(word, ["eed", "eedly", "ed", "edly", "ing", "ingly"])
    if s in ("eed", "eedly"):
        if len(word) - len(s) >= r1:
            word = word[: -len(s)] + "ee"
    elif s:
        base = word[: -len(s)]
        if any(ch in VOWELS for ch in base):
            word = base
            if base.endswith(("at", "bl", "iz")):
                word += "e"
            elif base[-2:] in DOUBLES:
                word = base[:-1]
            elif len(base) == r1 and _short_end(base):
                word += "e"
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in VOWELS:
        word = word[:-1] + "i"

    s = _longest(word, STEP2)
    if s and len(word) - len(s) >= r1:
        base = word[: -len(s)]
        if not (s == "ogi" and not base.endswith("l")) and not (s == "li" and base[-1:] not in set("cdeghkmnrt")):
            word = base + STEP2[s]
    s = _longest(word, STEP3)
    if s and len(word) - len(s) >= (r2 if s == "ative" else r1):
        word = word[: -len(s)] + STEP3[s]
    s = _longest(word, STEP4)
    if s and len(word) - len(s) >= r2 and (s != "ion" or word[-4:-3] in set("st")):
        word = word[: -len(s)]
    if word.endswith("e"):
        base = word[:-1]
        if len(base) >= r2 or (len(base) >= r1 and not _short_end(base)):
            word = base
    elif word.endswith("ll") and len(word) - 1 >= r2:
        word = word[:-1]
    return word.replace("Y", "y")
